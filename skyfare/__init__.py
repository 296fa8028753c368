"""skyfare: trip, zone and weather-station analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    readers and writers (trip CSV, zone table, weather JSON, lake tables, web pages)
functions  Column-expression helpers (geodesic distance, date parsing, numeric casts)
operators  table operators (cleaning, joins, nearest-station join, statistics, models)
plans      composed jobs (trip + weather merge, monthly ingest, fare models)
streaming  the incremental form of the trip enrichment
"""

__version__ = "0.1.0"
