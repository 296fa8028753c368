"""DuckDB SQL for each registered query (same column names as the Spark side)."""

from __future__ import annotations

from checks.sql_parts import LOCATED, NEAREST, STATIONS, TRIPS, ZONES, geodesic_sql, with_

MERGED_COLS = ("trip_id, date, PULocationID, DOLocationID, PU_lat, PU_lon, DO_lat, DO_lon, station, "
               "lat, lon, distance_km, tempMax, tempMin, tempAvg, tempDeparture, hdd, cdd, "
               "precipitation, newSnow, snowDepth, passenger_count, trip_distance, total_amount")

STATION_COLS = ("station, date, tempMax, tempMin, tempAvg, tempDeparture, hdd, cdd, precipitation, "
                "newSnow, snowDepth, lat, lon")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_trips"] = with_(TRIPS) + """
SELECT trip_id, lpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, trip_distance,
       fare_amount, total_amount, date FROM trips"""
    q["scan_zones"] = with_(ZONES) + " SELECT * FROM zones"
    q["station_rows"] = with_(STATIONS) + f" SELECT {STATION_COLS} FROM stations"
    q["filter_station"] = with_(STATIONS) + f" SELECT {STATION_COLS} FROM stations WHERE contains(station, 'NY')"
    q["pickup_date"] = with_(TRIPS) + " SELECT trip_id, date FROM trips"
    q["trip_duration"] = with_(TRIPS) + " SELECT trip_id, trip_duration FROM trips"
    q["geocode_lookup"] = with_(ZONES) + " SELECT LocationID, lat, lon FROM zone_pts"
    q["join_pickup_zone"] = with_(TRIPS, ZONES) + """
SELECT t.trip_id, t.PULocationID, z.LocationID AS PULocationIDAlias, z.lat AS PU_lat, z.lon AS PU_lon
FROM trips t JOIN zone_pts z ON t.PULocationID = z.LocationID"""
    q["join_dropoff_zone"] = with_(TRIPS, ZONES) + """
SELECT t.trip_id, t.DOLocationID, z.LocationID, z.lat AS DO_lat, z.lon AS DO_lon
FROM trips t JOIN zone_pts z ON t.DOLocationID = z.LocationID"""
    q["geodesic_km"] = with_(TRIPS, ZONES, LOCATED) + f"""
SELECT trip_id, round({geodesic_sql('PU_lat', 'PU_lon', 'DO_lat', 'DO_lon')}, 6) AS pu_do_km FROM located"""
    q["nearest_station_join"] = with_(TRIPS, ZONES, LOCATED, STATIONS, NEAREST) + f"""
SELECT {MERGED_COLS} FROM merged"""
    q.update(oracle_sql_more())
    q.update(oracle_sql_models())
    q["stream_enrich"] = q["nearest_station_join"]
    q["stream_late_weather"] = q["nearest_station_join"]
    q["scan_trip_csv"] = q["scan_trips"]
    q["monthly_ingest"] = with_(TRIPS, ZONES, LOCATED, STATIONS, NEAREST) + """
SELECT sha256(concat(length(CAST(trip_id AS VARCHAR)), ':', trip_id, length(CAST(date AS VARCHAR)), ':', CAST(date AS VARCHAR))) AS id, trip_id, date,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, PULocationID, DOLocationID,
       station, distance_km, tempAvg, coalesce(precipitation, 0) AS precipitation, total_amount
FROM merged
WHERE station IS NOT NULL AND date >= DATE '2024-01-01' AND date < DATE '2024-03-01'
  AND lpep_pickup_datetime IS NOT NULL AND total_amount IS NOT NULL"""
    q["ledger_ingest"] = q["monthly_ingest"]
    for kind in ("listed", "bucketed"):
        q[f"upsert_{kind}"], q[f"delete_{kind}"] = q["upsert_table"], q["delete_by_key"]
    q["raw_sql_window"] = """
WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 2) AS v
  FROM events GROUP BY user_id, CAST(ts AS DATE))
SELECT user_id, day, n, v,
       row_number() OVER (PARTITION BY user_id ORDER BY day) AS day_rank,
       CAST(sum(n) OVER (PARTITION BY user_id ORDER BY day
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_events
FROM daily"""
    q["raw_sql_semi"] = """
SELECT o_orderkey, o_orderdate FROM orders o
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 45.0)"""
    q["weather_files"] = q["station_rows"]
    return q


#: What the oracle takes for entities, anchors and their href, written independently of the package.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
ANCHOR = r"<[aA](?:[ \t\r\n\f][^>]*)?>"
HREF = r"""[ \t\r\n\f][hH][rR][eE][fF][ \t\r\n\f]*=[ \t\r\n\f]*(?:"([^"]*)"|'([^']*)'|([^ \t\r\n\f"'>]+))"""


def _unescape(expr: str) -> str:
    for ent, ch in ENTITIES:
        ch = ch.replace("'", "''")
        expr = f"replace({expr}, '{ent}', '{ch}')"
    return expr


def _sq(s: str) -> str:
    return s.replace("'", "''")


TRIP_TYPED_COLS = ("trip_id, lpep_pickup_datetime, PULocationID, DOLocationID, passenger_count, "
                   "trip_distance, fare_amount, total_amount, date")
EVENTS_UPSERTED = """
WITH u AS (
  SELECT event_id, ts, user_id, event_type, value, props, 0 AS b FROM events
  UNION ALL
  SELECT event_id, ts + INTERVAL 1 HOUR, user_id, event_type, value + 1.0, props, 1 FROM events
  WHERE event_type = 'click'
), r AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, b DESC) AS rn FROM u
)
SELECT event_id, ts, user_id, event_type, value, props FROM r WHERE rn = 1"""


def oracle_sql_more() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_(TRIPS, ZONES, LOCATED, STATIONS, NEAREST)
    q["rename_columns"] = base + " SELECT trip_id, date, station, tempAvg AS weather FROM merged"
    q["cast_features"] = base + """
SELECT trip_id, CAST(PULocationID AS DOUBLE) AS PULocationID, CAST(DOLocationID AS DOUBLE) AS DOLocationID,
       passenger_count, trip_distance, fare_amount, total_amount, tempAvg AS weather FROM merged"""
    q["fare_features"] = base + """
SELECT trip_id, trip_distance, CAST(passenger_count AS INTEGER) AS passenger_count, tempAvg AS weather,
       total_amount AS fare FROM merged"""
    numeric = [c.strip() for c in MERGED_COLS.split(",") if c.strip() not in ("date", "station")]
    filled = ", ".join(f"coalesce({c}, 0) AS {c}" for c in numeric)
    q["fill_zero"] = base + f" SELECT date, station, {filled} FROM merged"
    filled_no_snow = ", ".join(f"coalesce({c}, 0) AS {c}" for c in numeric if c != "newSnow")
    q["drop_incomplete"] = base + f" SELECT date, station, {filled_no_snow} FROM merged WHERE station IS NOT NULL"
    q["surrogate_id"] = with_(TRIPS) + """
SELECT trip_id, date, sha256(concat(length(CAST(trip_id AS VARCHAR)), ':', trip_id, length(CAST(date AS VARCHAR)), ':', CAST(date AS VARCHAR))) AS id FROM trips"""
    q["limit_rows"] = with_(TRIPS) + f" SELECT {TRIP_TYPED_COLS} FROM trips ORDER BY trip_id LIMIT 20"
    q["month_key"] = with_(TRIPS) + """
SELECT trip_id, strftime(date, '%Y_%m') AS month_key, lpad(CAST(month(date) AS VARCHAR), 2, '0') AS month
FROM trips"""
    q["month_station_grid"] = with_(STATIONS) + """
SELECT station, CAST(year(m) AS INTEGER) AS year, lpad(CAST(month(m) AS VARCHAR), 2, '0') AS month,
       strftime(m, '%Y_%m') AS month_key
FROM (SELECT DISTINCT station FROM station_rows)
CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2023-11-01', DATE '2024-02-01', INTERVAL 1 MONTH)) AS DATE) AS m)"""
    q["overlay_columns"] = with_(TRIPS, ZONES) + """
SELECT t.trip_id, t.PULocationID AS LocationID, z.lat, z.lon
FROM trips t LEFT JOIN zone_pts z ON t.PULocationID = z.LocationID"""
    q["increasing_id"] = "SELECT count(*) AS n, count(*) AS n_ids, true AS not_negative FROM trips"
    q["increasing_id"] = with_(TRIPS) + " " + q["increasing_id"]
    q["scan_month_files"] = with_(TRIPS) + """
SELECT trip_id, CASE WHEN trip_id % 2 = 1 THEN 'yellow' ELSE 'green' END AS trip_kind,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CASE WHEN trip_id % 2 = 1 THEN DATE '1970-01-01' ELSE date END AS date,
       CASE WHEN trip_id % 2 = 0 THEN PULocationID END AS PULocationID,
       CASE WHEN trip_id % 2 = 1 THEN DOLocationID END AS DOLocationID, total_amount
FROM trips WHERE date >= DATE '2024-01-01' AND date < DATE '2024-03-01'"""
    parts = ["m.lpep_pickup_datetime", "CAST(m.PULocationID AS VARCHAR)", "CAST(m.DOLocationID AS VARCHAR)",
             "CAST(m.trip_id AS VARCHAR)"]
    text = ", ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE concat(length({p}), ':', {p}) END" for p in parts)
    q["demo_job"] = base + f" SELECT sha256(concat({text})) AS id, {MERGED_COLS} FROM merged m"
    q["use_database"] = "SELECT * FROM events"
    q["read_table"] = "SELECT * FROM events"
    q["append_table"] = "SELECT * FROM events"
    q["raw_sql"] = """
SELECT event_type, count(*) AS n, max(value) AS max_value, min(ts) AS first_ts
FROM events WHERE value >= 10.0 GROUP BY event_type"""
    q["upsert_table"] = EVENTS_UPSERTED
    q["delete_by_key"] = """
SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')"""
    q["append_partitioned"] = with_(TRIPS) + f"""
SELECT {TRIP_TYPED_COLS}, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM trips"""
    q["scan_month_range"] = with_(TRIPS) + f"""
SELECT {TRIP_TYPED_COLS}, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM trips
WHERE date >= DATE '2024-01-01' AND date < DATE '2024-03-01'"""
    href = lambda i: f"regexp_extract(tag, '{_sq(HREF)}', {i})"
    link = _unescape(f"({href(1)} || {href(2)} || {href(3)})")
    q["extract_links"] = f"""
WITH t AS (SELECT page_id, regexp_extract_all(html, '{_sq(ANCHOR)}', 0) AS tags FROM pages),
x AS (SELECT page_id, CAST(unnest(range(0, len(tags))) AS INTEGER) AS link_pos, unnest(tags) AS tag FROM t),
l AS (SELECT page_id, link_pos, {link} AS link FROM x)
SELECT * FROM l WHERE link <> '' AND contains(link, '/') AND NOT contains(link, 'the')"""
    q["link_metadata"] = """
WITH l AS (SELECT page_id, url || '.csv' AS link FROM pages)
SELECT page_id, link, string_split(link, '/')[-1] AS file_name,
       CASE WHEN strpos(link, '.csv') > 7 THEN substring(link, strpos(link, '.csv') - 2, 2) END AS month,
       CASE WHEN strpos(link, '.csv') > 7 THEN substring(link, strpos(link, '.csv') - 7, 4) END AS year
FROM l"""
    from skyfare.sources.weather import WEATHER_FIELDS
    cells = ", ".join(
        f"trim({_unescape(f'regexp_replace(cells[{i + 1}], ' + chr(39) + '<[^>]*>' + chr(39) + ', ' + chr(39) + chr(39) + ', ' + chr(39) + 'g' + chr(39) + ')')}) AS {name}"
        for i, name in enumerate(WEATHER_FIELDS))
    q["html_rows"] = f"""
WITH r AS (SELECT page_id, regexp_extract_all(html, '(?is)<ul(?:\\s[^>]*)?>(.*?)</ul>', 1) AS rs FROM pages),
x AS (SELECT page_id, CAST(unnest(range(0, len(rs))) AS INTEGER) AS row_pos, unnest(rs) AS row_html FROM r),
c AS (SELECT page_id, row_pos, regexp_extract_all(row_html, '(?is)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS cells FROM x)
SELECT page_id, row_pos, {cells} FROM c"""
    return q


def _det(m: list[list[str]]) -> str:
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j in range(len(m)):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} ({m[0][j]}) * ({_det(minor)})")
    return "(" + " ".join(terms) + ")"


def ols_sql(subset: list[str], label: str = "total_amount") -> tuple[str, list[str]]:
    """(intercept expr, coefficient exprs) over a one-row CTE g of covariances and means."""
    a = [[f"g.c_{x}_{y}" for y in subset] for x in subset]
    r = [f"g.c_{x}_{label}" for x in subset]
    det = _det(a)
    coefs = []
    for i in range(len(subset)):
        ai = [[r[row] if col == i else a[row][col] for col in range(len(subset))] for row in range(len(subset))]
        coefs.append(f"({_det(ai)} / {det})")
    intercept = f"(g.m_{label} - (" + " + ".join(f"{c} * g.m_{x}" for c, x in zip(coefs, subset)) + "))"
    return intercept, coefs


def oracle_sql_models() -> dict[str, str]:
    from skyfare.operators.ml import FORWARD_SETS
    q: dict[str, str] = {}
    base = with_(TRIPS, ZONES, LOCATED, STATIONS, NEAREST) + """,
rows AS (
  SELECT trip_id, coalesce(trip_distance, 0) AS trip_distance, coalesce(passenger_count, 0) AS passenger_count,
         coalesce(tempAvg, 0) AS weather, coalesce(total_amount, 0) AS total_amount,
         coalesce(fare_amount, 0) AS fare_amount,
         ('0x' || substr(md5(CAST(trip_id AS VARCHAR)), 1, 8))::BIGINT % 10 AS bucket
  FROM merged
),
train AS (SELECT * FROM rows WHERE bucket < 8),
test AS (SELECT * FROM rows WHERE bucket >= 8)"""
    feats = ["trip_distance", "passenger_count", "weather"]
    q["correlation_matrix"] = base + " " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS r FROM rows"
        for a in feats for b in feats)
    q["residuals"] = base + """
SELECT trip_id, total_amount, fare_amount AS prediction, total_amount - fare_amount AS residual FROM rows"""
    q["rmse"] = base + " SELECT round(sqrt(avg((total_amount - fare_amount) ^ 2)), 6) AS rmse FROM rows"
    q["r2"] = base + """
SELECT round(1.0 - sum((total_amount - fare_amount) ^ 2) / (var_pop(total_amount) * count(*)), 9) AS r2 FROM rows"""
    q["prediction_bounds"] = base + """
SELECT least(min(total_amount), min(fare_amount)) AS low, greatest(max(total_amount), max(fare_amount)) AS high
FROM rows"""
    q["train_test_split"] = base + """
SELECT trip_id, CASE WHEN bucket < 8 THEN 'train' ELSE 'test' END AS split FROM rows"""
    q["assemble_features"] = base + """
SELECT trip_id, trip_distance AS f0, passenger_count AS f1, tempAvg AS f2 FROM merged
WHERE trip_distance IS NOT NULL AND passenger_count IS NOT NULL AND tempAvg IS NOT NULL"""
    lr = """,
fit AS (SELECT regr_intercept(total_amount, trip_distance) AS a, regr_slope(total_amount, trip_distance) AS b FROM train)"""
    q["actual_vs_predicted"] = base + lr + """
SELECT trip_id, total_amount AS actual, round(fit.a + fit.b * trip_distance, 2) AS predicted FROM test, fit"""
    cols = feats + ["total_amount"]
    gparts = [f"avg({c}) AS m_{c}" for c in cols]
    gparts += [f"covar_pop({x}, {y}) AS c_{x}_{y}" for x in cols for y in cols]
    g = ",\ng AS (SELECT " + ", ".join(gparts) + " FROM train)"
    icpt, coefs = ols_sql(list(feats))
    q["linear_regression"] = base + g + ",\nfit AS (SELECT " + f"{icpt} AS a, " + \
        ", ".join(f"{c} AS b_{f}" for c, f in zip(coefs, feats)) + " FROM g),\ne AS (SELECT fit.*, total_amount, total_amount - (a" + \
        "".join(f" + b_{f} * {f}" for f in feats) + """) AS err FROM test, fit)
SELECT round(any_value(a), 6) AS intercept, """ + ", ".join(f"round(any_value(b_{f}), 6) AS c_{f}" for f in feats) + """,
       count(*) AS n_test, round(sqrt(avg(err ^ 2)), 6) AS rmse,
       round(1.0 - sum(err ^ 2) / (var_pop(total_amount) * count(*)), 6) AS r2 FROM e"""
    q["saved_pipeline"] = base + g + ",\nfit AS (SELECT " + f"{icpt} AS a, " + \
        ", ".join(f"{c} AS b_{f}" for c, f in zip(coefs, feats)) + """ FROM g)
SELECT trip_id, total_amount AS actual, round(a""" + "".join(f" + b_{f} * {f}" for f in feats) + """, 2) AS predicted
FROM test, fit"""
    sels = []
    for subset in FORWARD_SETS:
        icpt, coefs = ols_sql(list(subset))
        pred = icpt + "".join(f" + {c} * t.{x}" for c, x in zip(coefs, subset))
        name = ",".join(subset)
        sels.append(f"""SELECT '{name}' AS predictors,
       round(sqrt(avg((t.total_amount - ({pred})) ^ 2)), 6) AS rmse,
       round(1.0 - sum((t.total_amount - ({pred})) ^ 2) / (var_pop(t.total_amount) * count(*)), 6) AS r2
FROM test t, g""")
    q["forward_selection"] = base + g + "\n" + "\nUNION ALL\n".join(sels)
    scaled = [f"""CASE WHEN s.hi_{c} = s.lo_{c} THEN 0.5 ELSE (r.{c} - s.lo_{c}) / (s.hi_{c} - s.lo_{c}) END AS {c}_scaled"""
              for c in feats]
    sc = base + ",\ns AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in feats) + \
        " FROM train)\nSELECT r.trip_id, CASE WHEN r.bucket < 8 THEN 'train' ELSE 'test' END AS split, " + \
        ", ".join(scaled) + ", r.total_amount AS fare FROM rows r, s"
    q["random_forest_fare"] = base + """
SELECT count(*) AS n_test, true AS all_predicted, true AS beats_mean FROM test"""
    q["mlp_regressor"] = q["random_forest_fare"]
    q["batch_predict"] = base + " SELECT trip_id, total_amount AS fare, true AS predicted FROM test"
    q["training_history"] = """
SELECT true AS every_epoch_once, true AS within_limit, true AS finite, true AS improves"""
    q["cv_grid_search"] = """
SELECT d AS "maxDepth", b AS "maxBins", n AS "numTrees", true AS beats_mean
FROM (VALUES (2), (5), (10), (20), (30)) t(d), (VALUES (10), (20), (40), (80), (100)) u(b),
     (VALUES (5), (20), (50), (100), (500)) v(n)"""
    q["scale_features"] = sc
    q["write_features"] = sc
    return q
