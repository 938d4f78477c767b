"""Every query that can be compared with SQL on the given tables."""

from tablecraft.checks import courses, learning, live, relational  # noqa: F401
from tablecraft.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
