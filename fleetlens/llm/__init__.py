"""Training-data operators over documents, conversations and embeddings.

Each module holds one operator with its own interface; ``queries`` registers the thin
``opN_<name>`` queries over the given tables, with their SQL where SQL can express them.
Nothing outside this package imports it, except the guarded hook of ``__spark_entry__``.
"""
