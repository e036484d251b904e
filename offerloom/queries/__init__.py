"""One query per operator over the star-schema tables, with its SQL twin where SQL can say it."""

from offerloom.queries import (  # noqa: F401
    aggregates, expressions, functions, inference, joins, learning, sampling, sources, streams, windows,
)
from offerloom.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
