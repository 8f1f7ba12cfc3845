"""The library's operators on the driver's tables."""

from . import cell_queries, io_queries, name_queries, pixel_queries
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "cell_queries", "io_queries", "name_queries", "pixel_queries"]
