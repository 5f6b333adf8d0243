"""Operators for large-scale training-data pipelines.

Each module holds one operator with a general ``DataFrame -> DataFrame`` interface; ``registry`` binds them to
the thin ``opN_<name>`` queries.  Nothing outside this subpackage imports it.
"""
