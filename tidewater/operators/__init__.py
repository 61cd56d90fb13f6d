"""DataFrame operators: cleaning, analytics, nested data, key checks."""

from tidewater.operators import analytics, cleaning, nested, quality

__all__ = ["analytics", "cleaning", "nested", "quality"]
