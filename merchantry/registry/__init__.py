"""Every operator and query as a named callable over a data folder, with its SQL counterpart."""

from merchantry.registry.base import ORACLES, QUERIES
from merchantry.registry import (  # noqa: F401  (each module registers its entries)
    analytics, cached, dimensional, generated, nested, quality, records, tables,
)

__all__ = ["ORACLES", "QUERIES"]
