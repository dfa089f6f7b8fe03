"""treeshred: shred hierarchical capture documents into relational tables with Spark."""

from .session import build_session, configure

__all__ = ["build_session", "configure"]
