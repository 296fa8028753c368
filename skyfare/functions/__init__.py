from skyfare.functions.geo import geodesic_km
from skyfare.functions.dates import pickup_date, trip_duration_seconds, month_key, month_str
from skyfare.functions.numeric import try_double

__all__ = ["geodesic_km", "pickup_date", "trip_duration_seconds", "month_key", "month_str",
           "try_double"]
