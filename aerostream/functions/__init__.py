"""Column-level building blocks (pure ``Column`` expressions)."""

from aerostream.functions import agg, flight, text

__all__ = ["agg", "flight", "text"]
