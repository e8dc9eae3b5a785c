"""Registered queries: each pairs a Spark DataFrame job with (where SQL can say it) a DuckDB twin.

Importing this package registers every query module.
"""

from sparktab.catalog.registry import ORACLES, QUERIES, query  # noqa: F401
from sparktab.catalog import cleaning, encoding, evaluation, events, features, guards, io, modeling, profiling, retrieval, streams, text, textfeatures  # noqa: F401,E402
