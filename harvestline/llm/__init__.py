"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` holds their registered queries and SQL.
Nothing outside this subpackage imports it, apart from the guarded import in
``__spark_entry__`` and the top-level ``corpus_pipeline``.
"""
