"""Every operator as a query over the whole test tables, with the SQL that states its result."""

from silverlode.checks import changes, events, files, plans, quality, relational, shapes, streams  # noqa: F401
from silverlode.checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
