import datetime as dt

import pytest
from pyspark.sql import functions as F

from skyfare.sources.weather import (WEATHER_FIELDS, encode_weather_docs, filter_station,
                                     parse_weather_docs, read_weather_files, type_station_rows)


def _day(date, avg, **kw):
    d = {f: "0" for f in WEATHER_FIELDS}
    d.update(date=date, tempAvg=avg)
    d.update(kw)
    return d


def test_read_python_dict_file_keeps_all_stations(spark, tmp_dir):
    doc = {
        "CENTRAL PARK NY": [_day("2020-01-01", "40"), _day("2020-01-02", "M", precipitation="T")],
        "O'HARE NY": [_day("2020-01-01", "", snowDepth="M")],
    }
    path = f"{tmp_dir}/2020_01.txt"
    with open(path, "w") as fh:
        fh.write(str(doc))          # single quotes, and double quotes around the apostrophe
    rows = type_station_rows(read_weather_files(spark, path)).orderBy("station", "date").collect()
    assert [(r.station, r.date) for r in rows] == [
        ("CENTRAL PARK NY", dt.date(2020, 1, 1)), ("CENTRAL PARK NY", dt.date(2020, 1, 2)),
        ("O'HARE NY", dt.date(2020, 1, 1))]
    assert rows[0].tempAvg == 40.0
    assert rows[1].tempAvg is None and rows[1].precipitation is None
    assert rows[2].tempAvg is None and rows[2].snowDepth is None


def test_encode_parse_roundtrip(spark):
    rows = [("A NY", "2020-01-01", "1"), ("A NY", "2020-02-01", "2"), ("B NJ", "2020-01-03", "3")]
    df = spark.createDataFrame(rows, "station STRING, date STRING, tempAvg STRING")
    for f in WEATHER_FIELDS:
        if f not in df.columns:
            df = df.withColumn(f, F.lit("0"))
    docs = encode_weather_docs(df, F.substring("date", 1, 7))
    assert docs.count() == 2
    back = parse_weather_docs(docs, "value").select("station", "date", "tempAvg")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_filter_station(spark):
    df = spark.createDataFrame([("A NY",), ("B NJ",)], "station STRING")
    assert [r[0] for r in filter_station(df, "NY").collect()] == ["A NY"]


def test_bad_documents_fail_with_their_path_and_blank_ones_have_no_rows(spark, tmp_dir):
    import os
    for name, text in (("2020_01.txt", "{'A NY': []}"), ("2020_02.txt", "  ")):
        with open(os.path.join(tmp_dir, name), "w") as fh:
            fh.write(text)
    assert read_weather_files(spark, tmp_dir).count() == 0
    for bad in ("{'A NY': [{'date': '2020-01-01', 'tempMax", "{'A NY': None}"):
        with open(os.path.join(tmp_dir, "2020_03.txt"), "w") as fh:
            fh.write(bad)
        with pytest.raises(Exception, match="2020_03.txt"):
            read_weather_files(spark, tmp_dir).collect()


def test_names_with_quotes_survive_the_file_form(spark):
    names = ["O'HARE", 'THE "FIELD"', "BACK\\SLASH", "PLAIN"]
    rows = [(n, "2020-01-01", *["1"] * 9) for n in names]
    df = spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in ["station", *WEATHER_FIELDS]))
    docs = encode_weather_docs(df, F.lit("2020_01"))
    assert sorted(r.station for r in parse_weather_docs(docs).collect()) == sorted(names)
