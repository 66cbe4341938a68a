"""Column expressions: cleaning casts, calendar attributes, decimal arithmetic."""

from starling.functions import arithmetic, calendar, cleaning

__all__ = ["arithmetic", "calendar", "cleaning"]
