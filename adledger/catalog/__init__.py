"""Every query with its check, by name."""

from adledger.catalog import documents, hub, inspection, layout, listings, pages, sites, storage, validation  # noqa: F401
from adledger.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
