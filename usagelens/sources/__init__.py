"""Sources and sinks: declared schemas, readers, writers, test-table fixtures."""
