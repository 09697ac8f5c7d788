"""Operators for large-scale training-data preparation.

One module per operator; :mod:`shoal.llm.catalog` registers one query per
operator and :mod:`shoal.llm.oracle` holds the SQL of those that SQL can
express.  Nothing outside this subpackage imports it.
"""
