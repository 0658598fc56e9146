"""The library's queries on the driver tables, each with its SQL counterpart."""

from . import cleaning, features, pages  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
