"""Every registered query."""
from . import overlay_queries, parcel_queries, raster_queries, registry_queries, text_queries, theme_queries  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
