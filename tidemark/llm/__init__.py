"""Operators for large training corpora: duplicates, tokens, filters, mixing, packing, search.

Nothing else in the library imports this subpackage. Every operator takes and returns
DataFrames; tables written on the way go below ``spark.checkpoint.dir``.
"""
