"""Operators for preparing language-model training data at corpus scale.

One module per operator; ``queries`` holds the registered queries and their
SQL. Nothing outside this subpackage imports it, apart from the guarded
registration in ``__spark_entry__`` and ``corpus_pipeline``.
"""
