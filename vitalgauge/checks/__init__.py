"""Every operator and plan bound to the test tables, next to a DuckDB query that must agree."""

from vitalgauge.checks import composites, grouped, relational, scalars
from vitalgauge.checks.registry import CHECKS

__all__ = ["CHECKS", "composites", "grouped", "relational", "scalars"]
