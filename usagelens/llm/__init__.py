"""Training-data operators: tokens, chat, language, duplicates, secrets, mixing.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own general interface; ``queries.py`` registers the
``opN_<name>`` queries over the given tables.
"""
