"""Registered queries over the driver tables and their SQL oracles."""

from daybook.queries.oracle import ORACLE_SQL  # noqa: F401
from daybook.queries.registry import QUERIES  # noqa: F401
