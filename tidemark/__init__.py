"""Data preparation and campaign analytics on PySpark.

Every operator is a plain function ``f(df, ..., **options) -> DataFrame`` that
builds a lazy plan, so it can be chained with ``DataFrame.transform``.
"""
