"""One callable per operator, over the stand-in tables: (spark, sf_dir) -> DataFrame.

These are the queries registered in ``__spark_entry__.queries()``.  Each reads
the driver's tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.dates import pickup_date as pickup_date_of
from skyfare.functions.dates import trip_duration_seconds
from skyfare.functions.geo import geodesic_km
from skyfare.operators import clean, enrich, forest, ml, stages, stats
from skyfare.operators import mlp as mlp_ops
from skyfare.plans import fare_models as FM
from skyfare.plans import merge
from skyfare.session import scratch_path, write_once
from skyfare.sources import lake, ledger, listed, proxies, web
from skyfare.sources import zones as zone_files
from skyfare.sources.trips import ID_COLUMNS, TRIP_KINDS, scan_month_range, type_trips
from skyfare.sources.trips import scan_trips as read_csv_trips
from skyfare.sources.weather import (NUMERIC_WEATHER_FIELDS, encode_weather_docs, filter_station, read_weather_files,
                                     type_station_rows)

MERGED_COLS = ["trip_id", "date", *ID_COLUMNS, "PU_lat", "PU_lon", "DO_lat", "DO_lon", "station", "lat", "lon",
               "distance_km", *NUMERIC_WEATHER_FIELDS, "passenger_count", "trip_distance", "total_amount"]


def _located(spark, sf):
    return merge.locate_trips(merge.proxy_trips(spark, sf), proxies.zones(spark, sf),
                              proxies.zone_geocodes(spark, sf))


def _stations(spark, sf, via_files=False):
    rows = merge.proxy_station_rows(spark, sf, via_files)
    return merge.locate_stations(rows, proxies.station_geocodes(spark))


# ---- scans and typing ----------------------------------------------------------------------

def scan_trips(spark: SparkSession, sf: str) -> DataFrame:
    return merge.proxy_trips(spark, sf).select(
        "trip_id", "lpep_pickup_datetime", "PULocationID", "DOLocationID", "passenger_count",
        "trip_distance", "fare_amount", "total_amount", "date")


def _zone_file(spark, sf):
    """The stand-in zones as a header CSV; returns its path."""
    path = scratch_path(spark, "zone-csv")
    proxies.zones(spark, sf).write.option("header", True).csv(path)
    return path


def scan_zones(spark, sf):
    return zone_files.scan_zones(spark, _zone_file(spark, sf))


def station_rows(spark, sf):
    return _stations(spark, sf, via_files=True)


def filter_station_q(spark, sf):
    return filter_station(_stations(spark, sf), "NY")


def pickup_date(spark, sf):
    return merge.proxy_trips(spark, sf).select("trip_id", "date")


def trip_duration(spark, sf):
    t = proxies.trip_text(spark, sf)
    return t.select(F.col("trip_id").cast("bigint").alias("trip_id"),
                    trip_duration_seconds("lpep_pickup_datetime", "lpep_dropoff_datetime")
                    .alias("trip_duration"))


# ---- joins ----------------------------------------------------------------------------------

def geocode_lookup(spark, sf):
    return enrich.zone_points(proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf))


def join_pickup_zone(spark, sf):
    points = enrich.zone_points(proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf))
    return enrich.join_pickup_zone(merge.proxy_trips(spark, sf), points).select(
        "trip_id", "PULocationID", "PULocationIDAlias", "PU_lat", "PU_lon")


def join_dropoff_zone(spark, sf):
    points = enrich.zone_points(proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf))
    return enrich.join_dropoff_zone(merge.proxy_trips(spark, sf), points).select(
        "trip_id", "DOLocationID", "LocationID", "DO_lat", "DO_lon")


def geodesic_q(spark, sf):
    return _located(spark, sf).select(
        "trip_id", F.round(geodesic_km("PU_lat", "PU_lon", "DO_lat", "DO_lon"), 6).alias("pu_do_km"))


def nearest_station_join(spark, sf):
    return _merged(spark, sf).select(*MERGED_COLS)


# ---- cleaning -------------------------------------------------------------------------------


MODEL_INPUTS = [*ID_COLUMNS, "passenger_count", "trip_distance", "fare_amount", "total_amount", "weather"]


def _merged(spark, sf):
    return merge.merge_trips_weather(
        merge.proxy_trips(spark, sf), proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf),
        merge.proxy_station_rows(spark, sf, via_files=False), proxies.station_geocodes(spark))


def rename_columns(spark, sf):
    return clean.rename_columns(_merged(spark, sf), {"tempAvg": "weather"}).select(
        "trip_id", "date", "station", "weather")


def cast_features(spark, sf):
    df = clean.rename_columns(_merged(spark, sf), {"tempAvg": "weather"})
    return clean.cast_features(df.select("trip_id", *MODEL_INPUTS), MODEL_INPUTS)


def fare_features(spark, sf):
    df = clean.rename_columns(_merged(spark, sf), {"tempAvg": "weather"})
    return clean.fare_features(df, keep=["trip_id"])


def fill_zero(spark, sf):
    return clean.fill_zero(_merged(spark, sf).select(*MERGED_COLS))


def drop_incomplete(spark, sf):
    filled = clean.fill_zero(_merged(spark, sf).select(*MERGED_COLS))
    return clean.drop_incomplete(filled.drop("newSnow"))


def surrogate_id(spark, sf):
    return clean.surrogate_id(merge.proxy_trips(spark, sf).select("trip_id", "date"),
                              ["trip_id", "date"])


def limit_rows(spark, sf):
    return clean.limit_rows(scan_trips(spark, sf), 20, ["trip_id"])


def month_key(spark, sf):
    from skyfare.functions.dates import month_key as mk, month_str
    t = merge.proxy_trips(spark, sf)
    return t.select("trip_id", mk("date").alias("month_key"), month_str(F.month("date")).alias("month"))


def month_station_grid(spark, sf):
    names = proxies.station_day_text(spark, sf).select("station")
    return clean.month_station_grid(names, "2023-11", "2024-02")


def overlay_columns(spark, sf):
    """Zone points laid over the trips' own lat and lon: the right side's columns win."""
    trips = merge.proxy_trips(spark, sf).select("trip_id", F.col("PULocationID").alias("LocationID"),
                                                F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"))
    points = enrich.zone_points(proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf))
    return clean.overlay_columns(trips, points, ["LocationID"])


# ---- lake -----------------------------------------------------------------------------------

def _events(spark, sf):
    return proxies.read(spark, sf, "events")


def use_database(spark, sf):
    previous = spark.catalog.currentDatabase()
    lake.use_database(spark, "skyfare_lake", scratch_path(spark, "db"))
    name = "events_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    lake.append_table(_events(spark, sf), name, as_table=True)
    out = lake.read_table(spark, f"skyfare_lake.{name}")
    spark.catalog.setCurrentDatabase(previous)
    return out


def read_table(spark, sf):
    previous = spark.catalog.currentDatabase()
    lake.use_database(spark, "skyfare_lake", scratch_path(spark, "db"))
    spark.catalog.setCurrentDatabase(previous)
    name = "skyfare_lake.events_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    lake.append_table(_events(spark, sf), name, as_table=True)
    return lake.read_table(spark, name)


def raw_sql(spark, sf):
    _events(spark, sf).createOrReplaceTempView("skyfare_events")
    return lake.raw_sql(spark, """
        SELECT event_type, count(*) AS n, max(value) AS max_value, min(ts) AS first_ts
        FROM skyfare_events WHERE value >= :min_value GROUP BY event_type""", {"min_value": 10.0})


def append_table(spark, sf):
    path = scratch_path(spark, "append")
    ev = _events(spark, sf)
    lake.append_table(ev.where(F.col("event_type").isin("click", "view")), path)
    lake.append_table(ev.where(~F.col("event_type").isin("click", "view")), path)
    return spark.read.parquet(path)


def _click_changes(ev):
    return (ev.where(F.col("event_type") == "click")
              .withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
              .withColumn("value", F.col("value") + F.lit(1.0)))


def upsert_table(spark, sf):
    base = scratch_path(spark, "upsert-base")
    ev = _events(spark, sf)
    lake.append_table(ev, base)
    return lake.upsert_table(spark, base, _click_changes(ev), ["event_id"], "ts",
                             scratch_path(spark, "upsert-out"))


def delete_by_key(spark, sf):
    base = scratch_path(spark, "delete-base")
    ev = _events(spark, sf)
    lake.append_table(ev, base)
    keys = ev.where(F.col("event_type") == "error")
    return lake.delete_by_key(spark, base, keys, ["event_id"], scratch_path(spark, "delete-out"))


def _listed_events(spark, sf):
    """The events as a listed table, its files ranged by event_id."""
    ev, path = _events(spark, sf), scratch_path(spark, "listed-events")
    listed.create_listed(spark, path, ev.repartitionByRange("event_id"))
    return ev, path


def upsert_listed(spark, sf):
    ev, path = _listed_events(spark, sf)
    listed.upsert_listed(spark, path, _click_changes(ev), ["event_id"], "ts")
    return listed.read_listed(spark, path)


def delete_listed(spark, sf):
    ev, path = _listed_events(spark, sf)
    listed.delete_listed(spark, path, ev.where(F.col("event_type") == "error"), ["event_id"])
    return listed.read_listed(spark, path)


def _buckets(spark):
    return max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _bucketed_events(spark, sf, job):
    """(events, name of their bucketed table, name and path of the result's)."""
    ev, path = _events(spark, sf), scratch_path(spark, f"bucketed-{job}")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    lake.write_bucketed(ev, name, ["event_id"], _buckets(spark), path)
    return ev, name, f"{name}_out", f"{path}-out"


def upsert_bucketed(spark, sf):
    ev, base, name, path = _bucketed_events(spark, sf, "upsert")
    return lake.upsert_bucketed(spark, base, _click_changes(ev), ["event_id"], "ts", name, _buckets(spark), path)


def delete_bucketed(spark, sf):
    ev, base, name, path = _bucketed_events(spark, sf, "delete")
    return lake.delete_bucketed(spark, base, ev.where(F.col("event_type") == "error"), ["event_id"], name, _buckets(spark),
                                path)


def append_partitioned(spark, sf):
    path = scratch_path(spark, "trips-by-month")
    t = scan_trips(spark, sf)
    lake.append_partitioned(t.withColumn("year", F.year("date")).withColumn("month", F.month("date")),
                            path, ["year", "month"])
    return spark.read.parquet(path)


def scan_month_range_q(spark, sf):
    path = scratch_path(spark, "trips-by-month")
    t = scan_trips(spark, sf)
    lake.append_partitioned(t.withColumn("year", F.year("date")).withColumn("month", F.month("date")),
                            path, ["year", "month"])
    return scan_month_range(spark, path, "2024-01", "2024-02", layout="hive", fmt="parquet")


# ---- web pages ------------------------------------------------------------------------------

def _pages(spark, sf):
    return proxies.read(spark, sf, "pages")


def extract_links(spark, sf):
    return web.extract_links(_pages(spark, sf), include=["/"], exclude=["the"])


def link_metadata(spark, sf):
    p = _pages(spark, sf).select("page_id", F.concat("url", F.lit(".csv")).alias("link"))
    return web.link_metadata(p)


def html_rows(spark, sf):
    return web.html_rows(_pages(spark, sf), row_tag="ul", cell_tag="li")


# ---- statistics and models ------------------------------------------------------------------


def _model_rows(spark, sf, fill=True):
    return FM.model_rows(_merged(spark, sf), fill)


def _written_rows(spark, sf):
    """Model rows for queries that read them in several passes."""
    return FM.written_rows(_merged(spark, sf))


def correlation_matrix(spark, sf):
    return stats.correlation_matrix(_model_rows(spark, sf), FM.FEATURES)


def residuals(spark, sf):
    rows = _model_rows(spark, sf).select("trip_id", "total_amount", F.col("fare_amount").alias("prediction"))
    return stats.residuals(rows, "total_amount", "prediction")


def rmse(spark, sf):
    return stats.rmse(_model_rows(spark, sf), "total_amount", "fare_amount").select(
        F.round("rmse", 6).alias("rmse"))


def r2(spark, sf):
    return stats.r2(_model_rows(spark, sf), "total_amount", "fare_amount").select(
        F.round("r2", 9).alias("r2"))


def prediction_bounds(spark, sf):
    return stats.prediction_bounds(_model_rows(spark, sf), "total_amount", "fare_amount")


def train_test_split(spark, sf):
    rows = _model_rows(spark, sf).select("trip_id")
    return rows.select("trip_id", F.when(ml.split_bucket(FM.KEY) < 8, "train").otherwise("test").alias("split"))


def assemble_features(spark, sf):
    rows = _model_rows(spark, sf, fill=False)
    vec = ml.assemble_features(rows, FM.FEATURES, label=FM.LABEL).select("trip_id", "features")
    return ml.vector_columns(vec, "features", ["f0", "f1", "f2"])


def linear_regression(spark, sf):
    train, test = FM.split(_written_rows(spark, sf))
    model = ml.linear_regression(train, FM.FEATURES, FM.LABEL)
    scored = ml.predict(model, test, FM.FEATURES)
    m = stats.regression_metrics(scored, FM.LABEL, "prediction")
    return m.select(F.lit(round(model.intercept, 6)).alias("intercept"),
                    *[F.lit(round(float(c), 6)).alias(f"c_{f}") for f, c in zip(FM.FEATURES, model.coefficients, strict=True)],
                    F.col("n").alias("n_test"), F.round("rmse", 6).alias("rmse"),
                    F.round("r2", 6).alias("r2"))


def actual_vs_predicted(spark, sf):
    train, test = FM.split(_written_rows(spark, sf))
    model = ml.linear_regression(train, ["trip_distance"], FM.LABEL)
    scored = ml.predict(model, test, ["trip_distance"])
    return scored.select("trip_id", F.col(FM.LABEL).alias("actual"),
                         F.round("prediction", 2).alias("predicted"))


def forward_selection(spark, sf):
    train, test = FM.split(_written_rows(spark, sf))
    out = ml.forward_selection(train, test, FM.LABEL)
    return out.select("predictors", F.round("rmse", 6).alias("rmse"), F.round("r2", 6).alias("r2"))


def _scaled(spark, sf):
    rows = _written_rows(spark, sf)
    bucket = ml.split_bucket(FM.KEY)
    train = rows.where(bucket < 8)
    fit = ml.scale_fit(train, FM.FEATURES)
    tagged = rows.withColumn("split", F.when(bucket < 8, "train").otherwise("test"))
    return ml.scale_apply(tagged, fit).select(
        "trip_id", "split", *[c + "_scaled" for c in FM.FEATURES], F.col(FM.LABEL).alias("fare"))


def scale_features(spark, sf):
    return _scaled(spark, sf)


def saved_pipeline(spark, sf):
    """Scaling and regression as one pipeline, fitted on train, saved, loaded, and applied to test."""
    train, test = FM.split(_written_rows(spark, sf))
    fitted = stages.feature_pipeline(FM.FEATURES, FM.LABEL, LinearRegression(labelCol=FM.LABEL, solver="normal")).fit(train)
    path = scratch_path(spark, "fare-pipeline")
    fitted.write().save(path)
    return PipelineModel.load(path).transform(test).select(
        "trip_id", F.col(FM.LABEL).alias("actual"), F.round("prediction", 2).alias("predicted"))


def write_features(spark, sf):
    path = scratch_path(spark, "features")
    lake.write_features(_scaled(spark, sf), path)
    return lake.read_features(spark, path)


def _forest_rows(spark, sf):
    """Rows with all of the forest's columns that the stand-in trips have."""
    df = clean.rename_columns(_merged(spark, sf), {"tempAvg": "weather"})
    feats = [c for c in ml.FOREST_COLUMNS if c in df.columns]
    rows = clean.fill_zero(clean.cast_features(df.select("trip_id", *feats, FM.LABEL), [*feats, FM.LABEL]))
    return write_once(rows, "forest-rows"), feats


def _against_mean(df, label):
    """One row: test rows, whether all are predicted, whether the error is finite and below the mean's."""
    err = F.col(label) - F.col("prediction")
    mse, var = F.avg(err * err), F.var_pop(label)
    return df.agg(F.count(F.lit(1)).alias("n_test"), (F.count("prediction") == F.count(F.lit(1))).alias("all_predicted"),
                  (~F.isnan(mse) & (mse < var)).alias("beats_mean"))


def random_forest_fare(spark, sf):
    rows, feats = _forest_rows(spark, sf)
    train, test = FM.split(rows)
    model = ml.random_forest(train, feats, FM.LABEL)
    return _against_mean(ml.predict(model, test, feats), FM.LABEL)


def cv_grid_search(spark, sf):
    """All 125 points of the grid with 5 folds, from one forest for each (bins, fold)."""
    rows, feats = _forest_rows(spark, sf)
    train, _ = FM.split(rows)
    out = forest.nested_grid(train, feats, FM.LABEL, FM.KEY, ml.GRID_DEPTHS, ml.GRID_BINS, ml.GRID_TREES, ml.GRID_FOLDS)
    if out is None:  # more rows than a task may hold: each point by itself, trees grown over the cluster
        out = ml.cv_grid_search(train, feats, FM.LABEL)
    sd = train.agg(F.stddev_pop(FM.LABEL)).first()[0]
    return out.select("maxDepth", "maxBins", "numTrees",
                      (~F.isnan("avg_rmse") & (F.col("avg_rmse") < F.lit(sd))).alias("beats_mean"))


def _mlp(spark, sf):
    scaled = write_once(_scaled(spark, sf), "mlp-scaled")
    feats = [c + "_scaled" for c in FM.FEATURES]
    train = scaled.where(F.col("split") == "train")
    ws, hist = mlp_ops.train_mlp(train, feats, "fare", FM.KEY)
    return scaled.where(F.col("split") == "test"), feats, ws, hist


def mlp_regressor(spark, sf):
    """The network on the test rows, from weights written as a table and loaded again."""
    test, feats, ws, _ = _mlp(spark, sf)
    path = scratch_path(spark, "mlp-weights")
    mlp_ops.save_weights(spark, ws, path)
    return _against_mean(mlp_ops.batch_predict(test, mlp_ops.load_weights(spark, path), feats), "fare")


def batch_predict(spark, sf):
    test, feats, ws, _ = _mlp(spark, sf)
    scored = mlp_ops.batch_predict(test, ws, feats)
    return scored.select("trip_id", "fare", F.col("prediction").isNotNull().alias("predicted"))


def training_history(spark, sf):
    """Facts of the history file: epochs from 0 without a gap, finite losses, a falling training loss."""
    _, _, _, hist = _mlp(spark, sf)
    path = scratch_path(spark, "train-history")
    mlp_ops.history_frame(spark, hist).write.option("header", True).csv(path)
    rows = spark.read.option("header", True).schema("epoch INT, loss DOUBLE, lr DOUBLE, val_loss DOUBLE").csv(path)
    return rows.agg(
        ((F.min("epoch") == 0) & (F.count_distinct("epoch") == F.max("epoch") + 1)
         & (F.count(F.lit(1)) == F.max("epoch") + 1)).alias("every_epoch_once"),
        (F.max("epoch") < mlp_ops.MAX_EPOCHS).alias("within_limit"),
        F.bool_and(~F.isnan("loss") & ~F.isnan("val_loss")).alias("finite"),
        (F.min_by("val_loss", "epoch") > F.min("val_loss")).alias("improves"))


# ---- streaming ------------------------------------------------------------------------------

def stream_enrich(spark, sf):
    from skyfare.streaming.enrich_stream import stream_enrich as run
    landing = scratch_path(spark, "trips-landing")
    merge.proxy_trips(spark, sf).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    out = scratch_path(spark, "trips-enriched")

    def side():
        return merge.prepare_static(proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf),
                                    merge.proxy_station_rows(spark, sf, via_files=False),
                                    proxies.station_geocodes(spark))

    q = run(spark, landing, schema, side, out, scratch_path(spark, "stream-ckpt"),
            max_files_per_trigger=max(2, spark.sparkContext.defaultParallelism // 2))
    q.awaitTermination()
    return spark.read.parquet(out).select(*MERGED_COLS)


def stream_late_weather(spark, sf):
    """Trips and weather as two streams, ten days of trips at a time, the weather a step behind; restarted after each step."""
    from skyfare.streaming import late_weather as late
    trips = write_once(merge.locate_trips(merge.proxy_trips(spark, sf), proxies.zones(spark, sf),
                                          proxies.zone_geocodes(spark, sf)).where(F.col("date").isNotNull()), "stream-trips")
    weather = write_once(merge.locate_stations(merge.proxy_station_rows(spark, sf, via_files=False),
                                               proxies.station_geocodes(spark)), "stream-weather")
    days = sorted(r["date"] for r in trips.select("date").distinct().collect())  # bounded by the calendar
    folder = scratch_path(spark, "late-weather")
    step, steps = F.lit(0), -(-len(days) // 10)
    for i in range(1, steps):
        step = F.when(F.col("date") >= F.lit(days[10 * i]), i).otherwise(step)
    for i in range(steps + 2):
        more = [(trips, "trips", i), (weather, "weather", i - 1)]
        for df, name, n in more:
            new = late.close_rows(df) if i == steps + 1 else df.where(step == n) if n >= 0 else df.limit(0)
            new.write.mode("append").parquet(f"{folder}/{name}")
        query = late.stream_late_weather(late.file_stream(spark, f"{folder}/trips"), late.file_stream(spark, f"{folder}/weather"),
                                         f"{folder}/out", f"{folder}/ckpt", wait="20 days")
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(*MERGED_COLS)


# ---- file round trips through the real readers ----------------------------------------------

def _trip_files(spark, sf):
    """The stand-in trips as header CSV files; returns their path."""
    path = scratch_path(spark, "trip-csv")
    proxies.trip_text(spark, sf).write.option("header", True).csv(path)
    return path


def scan_trip_csv(spark, sf):
    """Stand-in trips written as header CSV files, then read with ``scan_trips``."""
    return read_csv_trips(spark, _trip_files(spark, sf)).select(
        "trip_id", "lpep_pickup_datetime", "PULocationID", "DOLocationID", "passenger_count",
        "trip_distance", "fare_amount", "total_amount", "date")


def _weather_files(spark, sf):
    """Monthly weather files, one single-quoted object each; returns their glob."""
    path = scratch_path(spark, "weather-files")
    docs = encode_weather_docs(proxies.station_day_text(spark, sf), F.substring("date", 1, 7))
    docs.write.partitionBy("doc_key").text(path)
    return f"{path}/doc_key=*/*.txt"


def weather_files(spark, sf):
    """Monthly weather files (one single-quoted object per file) read with ``read_weather_files``."""
    rows = type_station_rows(read_weather_files(spark, _weather_files(spark, sf)))
    return merge.locate_stations(rows, proxies.station_geocodes(spark))


def scan_month_files(spark, sf):
    """Plain ``YYYY/MM`` folders with CSV files of both trip kinds, each with its own columns."""
    root = scratch_path(spark, "trip-months")
    t = proxies.trip_text(spark, sf).withColumn("_month", pickup_date_of("lpep_pickup_datetime"))
    t = write_once(t.withColumn("_month", F.date_format("_month", "yyyy/MM")), "trips-of-months")
    odd = F.col("trip_id").cast("bigint") % 2 == 1
    green = ["trip_id", "lpep_pickup_datetime", "PULocationID", "total_amount"]
    months = [r[0] for r in t.select("_month").distinct().orderBy("_month").collect()]  # one for each folder
    for month in months:
        own = t.where(F.col("_month") == month)
        _csv_file(spark, own.where(~odd).select(*green), f"{root}/{month}", "green")
        _csv_file(spark, own.where(odd).select(
            F.col("lpep_pickup_datetime").alias("tpep_pickup_datetime"), "total_amount", "trip_id", "DOLocationID"),
            f"{root}/{month}", "yellow")
    found = type_trips(scan_month_range(spark, root, "2024-01", "2024-02", kinds=TRIP_KINDS))
    return found.select("trip_id", "trip_kind", "year", "month", "date", "PULocationID", "DOLocationID", "total_amount")


def _csv_file(spark, df, folder, kind):
    """CSV files ``<kind>-...`` in ``folder``, which other kinds share."""
    draft = scratch_path(spark, f"csv-{kind}")
    df.write.option("header", True).csv(draft)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    for f in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{draft}/part-*.csv")):
        fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}-{f.getPath().getName()}"))


def demo_job(spark, sf):
    """The whole job from files: trip CSV + zone CSV + weather files -> merged rows with a key over all trip columns."""
    trips = read_csv_trips(spark, _trip_files(spark, sf))
    zones = zone_files.scan_zones(spark, _zone_file(spark, sf))
    stations = type_station_rows(read_weather_files(spark, _weather_files(spark, sf)))
    merged = merge.merge_trips_weather(trips, zones, proxies.zone_geocodes(spark, sf), stations,
                                       proxies.station_geocodes(spark))
    keyed = clean.surrogate_id(merged, ["lpep_pickup_datetime", "PULocationID", "DOLocationID", "trip_id"])
    return keyed.select("id", *MERGED_COLS)


# ---- raw increasing id; conformance queries through raw_sql ---------------------------------

def increasing_id(spark, sf):
    """Facts of Spark's increasing id over the typed trips: one row each, unique, not negative."""
    ids = clean.raw_increasing_id(merge.proxy_trips(spark, sf).select("trip_id", "date"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"),
                   (F.min("id") >= 0).alias("not_negative"))


def raw_sql_window(spark, sf):
    """Conformance: window functions reached through raw_sql (inherited from Spark SQL).

    Events are first reduced to one row per (user, day) with a partially aggregated
    GROUP BY, so each window group holds at most one row per calendar day however
    many events a user has.
    """
    _events(spark, sf).createOrReplaceTempView("skyfare_events")
    return lake.raw_sql(spark, """
        WITH daily AS (
          SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 2) AS v
          FROM skyfare_events GROUP BY user_id, CAST(ts AS DATE))
        SELECT user_id, day, n, v,
               row_number() OVER (PARTITION BY user_id ORDER BY day) AS day_rank,
               sum(n) OVER (PARTITION BY user_id ORDER BY day
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_events
        FROM daily""")


def raw_sql_semi(spark, sf):
    """Conformance: an EXISTS (semi) join with a parameter, through raw_sql."""
    proxies.read(spark, sf, "orders").createOrReplaceTempView("skyfare_orders")
    proxies.read(spark, sf, "lineitem").createOrReplaceTempView("skyfare_lineitem")
    return lake.raw_sql(spark, """
        SELECT o_orderkey, o_orderdate FROM skyfare_orders o
        WHERE EXISTS (SELECT 1 FROM skyfare_lineitem l
                      WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > :q)""", {"q": 45.0})


# ---- monthly ingest into the lake -----------------------------------------------------------

INGEST_COLS = ["id", "trip_id", "date", "year", "month", "PULocationID", "DOLocationID", "station",
               "distance_km", "tempAvg", "precipitation", "total_amount"]


def monthly_ingest(spark, sf):
    """Trips of 2024-01..2024-02 (partitioned files) + weather -> lake table; read back."""
    from skyfare.plans.ingest import ingest
    landing = scratch_path(spark, "trips-by-month")
    t = merge.proxy_trips(spark, sf)
    lake.append_partitioned(t.withColumns({"year": F.year("date"), "month": F.month("date")}),
                            landing, ["year", "month"])
    months = scan_month_range(spark, landing, "2024-01", "2024-02", layout="hive",
                              fmt="parquet").drop("year", "month")
    table = scratch_path(spark, "lake-trips-weather")
    ingest(months, proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf),
           merge.proxy_station_rows(spark, sf, via_files=False), proxies.station_geocodes(spark), table,
           key_cols=["trip_id", "date"])
    return spark.read.parquet(table).select(*INGEST_COLS)


def ledger_ingest(spark, sf):
    """The monthly ingest in three runs over growing folders, the last one over the same files; read back.

    A month comes with its files; a run loads those that the ledger does not have.
    """
    from skyfare.plans.ingest import prepare_ingest
    landing, table = scratch_path(spark, "landing-months"), scratch_path(spark, "listed-trips-weather")
    trips = write_once(merge.proxy_trips(spark, sf), "landing-trips")
    zones, geocodes = proxies.zones(spark, sf), proxies.zone_geocodes(spark, sf)
    stations = write_once(merge.proxy_station_rows(spark, sf, via_files=False), "landing-stations")

    def load(paths):
        months = spark.read.schema(trips.schema).parquet(*paths).select("*", ledger.source_of_row())
        return prepare_ingest(months, zones, geocodes, stations, proxies.station_geocodes(spark),
                              key_cols=["trip_id", "date"])

    for month in ("2024-01", "2024-02", None):
        if month:
            trips.where(F.date_format("date", "yyyy-MM") == month).write.parquet(f"{landing}/{month}")
        ledger.ingest_new(spark, table, ledger.find_files(spark, landing, "*.parquet"), load)
    return listed.read_listed(spark, table).select(*INGEST_COLS)
