"""All registered queries."""

from geoloom.plans import raster_queries, spatial_queries, table_queries  # noqa: F401
from geoloom.plans.registry import ORACLES, QUERIES  # noqa: F401
