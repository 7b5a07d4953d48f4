"""Results are only right with exactly these."""

from __future__ import annotations

# Event types, by family.
RIDE_EVENTS = ("ride_started", "ride_completed", "ride_cancelled")
DRIVER_EVENTS = ("driver_registered", "driver_activated", "driver_location_update")
CUSTOMER_EVENTS = ("customer_registered", "customer_ride_request")

# Customer segment: more requests than this, first match wins.
SEGMENT_ABOVE = (("frequent", 20), ("regular", 5))
SEGMENT_ELSE = "occasional"

# Retention: fewer days since the last ride than this, first match wins.
RETENTION_BELOW = (("active", 7), ("lapsing", 30))
RETENTION_ELSE = "churned"

# Driver status: fewer days since activation than this.
DRIVER_STATUS_BELOW = (("new", 30),)
DRIVER_STATUS_ELSE = "active"

# Decimals of a grid cell's coordinates.
GRID_DECIMALS = 2

# Columns a gold table is usually queried by.
GOLD_QUERY_COLUMNS = {
    "daily_ride_metrics": ("ride_date", "driver_id"),
    "driver_performance": ("driver_id",),
    "customer_segments": ("customer_segment",),
}

# Other names under which a gold table is known.
GOLD_ALIASES = {
    "ride_metrics": "daily_ride_metrics",
    "historical_ride_metrics": "daily_ride_metrics",
    "historical_driver_performance": "driver_performance",
}
