"""Every operator as a query over the driver's tables, and the same result in SQL."""

from . import formats  # noqa: F401  (registers its queries)
from .core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
