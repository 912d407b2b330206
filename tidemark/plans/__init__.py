"""The queries named in the driver contract."""

from . import batches, graphs, mappings, merges, reads, writes  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES
