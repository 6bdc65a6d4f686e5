"""Plans: the SQL query library, report bundles, the batch pipeline and the
query catalogue exposed to the driver."""
