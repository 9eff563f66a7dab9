"""Queries over the driver tables, each beside the SQL it must agree with."""

from . import checks, columns, golden, landing, linking, places, timeline  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
