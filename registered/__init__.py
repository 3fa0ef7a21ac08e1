"""Queries over the supplied tables, each with the SQL that gives the same result.

A module's ``QUERIES`` maps a name to ``(query, sql)``; ``sql`` is None where SQL has
no counterpart. Timestamps are compared as text, counters as BIGINT.
"""

from . import aggregates, cleaning, files, joins, quality, relational, stages

MODULES = [relational, joins, aggregates, quality, cleaning, stages, files]
