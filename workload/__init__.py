"""The library's operators as named queries over the given tables."""

from . import checks, clean, cross, files, marts, operators, questions  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
