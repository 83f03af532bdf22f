"""Operators of a training-data pipeline, one module each, over the tables
``documents``, ``embeddings`` and ``pages``. Nothing else in the library imports this
subpackage; ``queries.py`` holds the registered queries."""
