"""One query per operator, over the given tables, each with SQL that gives the same rows."""

from telemill.acceptance import averaging, ingest, querying, ruling, storing, streams
from telemill.acceptance.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "averaging", "ingest", "querying", "ruling", "storing", "streams"]
