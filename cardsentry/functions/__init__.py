"""Column-level functions (pure JVM expressions, codegen friendly)."""
from .geo import haversine_km
from .expr import count_if, money_sum, ratio, pct

__all__ = ["haversine_km", "count_if", "money_sum", "ratio", "pct"]
