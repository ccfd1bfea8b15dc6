"""Registered queries over the given tables."""

from samplelake.catalog import file_queries, image_queries, listing_queries  # noqa: F401
from samplelake.catalog.registering import QUERIES, SQL  # noqa: F401
