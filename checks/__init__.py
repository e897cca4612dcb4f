"""One query per operator over the given tables, each with the SQL it is checked against."""

from checks import changes, extraction, logs, rules, shaping, streams  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
