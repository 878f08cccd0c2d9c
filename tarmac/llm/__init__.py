"""Operators for preparing language-model training data at scale.

Each module holds one operator (general interface) and its registered query
(``opN_<name>``); ``registry`` gathers the queries and their DuckDB SQL. Nothing
outside this package imports it except ``__spark_entry__`` (guarded) and
``corpus_pipeline``.
"""
