"""The registered queries: each runs an operator over the driver tables, with its SQL oracle beside it."""

from .registry import ORACLES, QUERIES
from . import errors, fields, projection, search, sources, streams, writes  # noqa: E402,F401  (they register)

__all__ = ["ORACLES", "QUERIES"]
