import os

from pyspark.sql import functions as F

from skyfare.plans import merge
from skyfare.sources import proxies
from skyfare.streaming.enrich_stream import stream_enrich
from tests.conftest import SF_SMALL


def test_stream_equals_batch_merge(spark, tmp_dir):
    trips = merge.proxy_trips(spark, SF_SMALL)
    landing = os.path.join(tmp_dir, "landing")
    trips.repartition(3, "trip_id").write.parquet(landing)
    side = merge.prepare_static(proxies.zones(spark, SF_SMALL), proxies.zone_geocodes(spark, SF_SMALL),
                                merge.proxy_station_rows(spark, SF_SMALL, via_files=False),
                                proxies.station_geocodes(spark), write_nearest=True)
    out = os.path.join(tmp_dir, "out")
    q = stream_enrich(spark, landing, spark.read.parquet(landing).schema, side, out,
                      os.path.join(tmp_dir, "ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    assert len([d for d in os.listdir(out) if d.startswith("batch=")]) == 3
    cols = ["trip_id", "date", "station", "distance_km", "tempAvg"]
    streamed = spark.read.parquet(out).select(*cols)
    batch = merge.enrich_trips(trips, side).select(*cols)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    # some trips have no station that day and keep null readings
    assert streamed.where(F.col("station").isNull()).count() > 0


def test_merge_without_any_broadcast_equals_default(spark):
    # a 1-byte budget fails every size check: all joins are shuffled
    from skyfare.operators.sizing import BROADCAST_MAX_BYTES_CONF

    def run():
        side = merge.prepare_static(proxies.zones(spark, SF_SMALL), proxies.zone_geocodes(spark, SF_SMALL),
                                    merge.proxy_station_rows(spark, SF_SMALL, via_files=False),
                                    proxies.station_geocodes(spark))
        out = merge.enrich_trips(merge.proxy_trips(spark, SF_SMALL), side)
        return side, out.select("trip_id", "date", "station", "distance_km", "tempAvg")

    side, default = run()
    assert side.points_small and all(side.nearest.small.values())
    spark.conf.set(BROADCAST_MAX_BYTES_CONF, "1")
    try:
        side, shuffled = run()
        assert not side.points_small and not any(side.nearest.small.values())
        rows = sorted(map(tuple, shuffled.collect()), key=str)
    finally:
        spark.conf.unset(BROADCAST_MAX_BYTES_CONF)
    assert rows == sorted(map(tuple, default.collect()), key=str)


def test_weather_that_arrives_between_two_batches(spark, tmp_dir):
    trips = merge.proxy_trips(spark, SF_SMALL)
    cut = trips.select(F.min("trip_id")).first()[0]
    landing, weather = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "weather")
    rows = merge.proxy_station_rows(spark, SF_SMALL, via_files=False)
    rows.limit(0).write.parquet(weather)
    schema = trips.schema

    def side():
        return merge.prepare_static(proxies.zones(spark, SF_SMALL), proxies.zone_geocodes(spark, SF_SMALL),
                                    spark.read.schema(rows.schema).parquet(weather), proxies.station_geocodes(spark))

    def go():
        q = stream_enrich(spark, landing, schema, side, os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"))
        q.awaitTermination()

    trips.where(F.col("trip_id") % 2 == cut % 2).coalesce(1).write.mode("append").parquet(landing)
    go()
    rows.write.mode("append").parquet(weather)
    trips.where(F.col("trip_id") % 2 != cut % 2).coalesce(1).write.mode("append").parquet(landing)
    go()
    out = spark.read.parquet(os.path.join(tmp_dir, "out"))
    first, second = (out.where(F.col("trip_id") % 2 == (cut + i) % 2) for i in (0, 1))
    assert first.count() > 0 and first.where("station IS NOT NULL").count() == 0
    assert second.where("station IS NOT NULL").count() > 0
    before = out.count()
    go()                                                # nothing new: a restart adds no rows
    assert spark.read.parquet(os.path.join(tmp_dir, "out")).count() == before
