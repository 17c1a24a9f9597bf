import json
import os

from pyspark.sql import types as T

from sluice.sources.columnar_json import columnar_schema, explode_columnar, read_columnar

SCHEMA = columnar_schema([T.StructField("latitude", T.DoubleType()), T.StructField("city", T.StringType())],
                         "time", [T.StructField("temp", T.DoubleType()), T.StructField("cloud", T.IntegerType())])


def test_explode_and_reject_short_arrays(spark, workdir):
    objs = [
        {"latitude": 55.7, "city": "x", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                                    "temp": [-3.5, None], "cloud": [10, 20]}},
        {"latitude": 43.6, "city": "y", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"],
                                                    "temp": [1.0], "cloud": [5, 6]}},
    ]
    with open(os.path.join(workdir, "a.json"), "w") as fh:
        fh.write("\n".join(json.dumps(o) for o in objs))
    rows, rejected = explode_columnar(read_columnar(spark, workdir, SCHEMA), "time", ["temp", "cloud"],
                                      ts_name="observed_at", date_name="observed_date")
    got = sorted((r["city"], str(r["observed_at"]), r["temp"], r["cloud"], str(r["observed_date"]))
                 for r in rows.collect())
    assert got == [("x", "2024-01-01 00:00:00", -3.5, 10, "2024-01-01"),
                   ("x", "2024-01-01 01:00:00", None, 20, "2024-01-01")]
    assert [r["city"] for r in rejected.collect()] == ["y"]


def test_every_object_is_expanded_or_rejected(spark, workdir):
    good = {"latitude": 1.0, "city": "g", "hourly": {"time": ["2024-01-01T00:00"], "temp": [1.0], "cloud": [1]}}
    lines = [json.dumps(good),
             json.dumps({"latitude": 1.0, "city": "no hourly"}),
             json.dumps({"latitude": 1.0, "city": "no cloud", "hourly": {"time": ["2024-01-01T00:00"], "temp": [1.0]}}),
             json.dumps(good)[:50]]
    with open(os.path.join(workdir, "a.json"), "w") as fh:
        fh.write("\n".join(lines))
    rows, rejected = explode_columnar(read_columnar(spark, workdir, SCHEMA), "time", ["temp", "cloud"])
    assert [r["city"] for r in rows.collect()] == ["g"]
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["array missing", "array missing", "object not parsed"]
    assert rows.count() == 1 and rejected.count() == 3


def test_write_and_read_back(spark, workdir):
    import datetime as dt

    from pyspark.sql import functions as F

    from sluice.sources.columnar_json import write_columnar
    rows = spark.range(5000).select(F.lit("hot").alias("k"),
                                    (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(secs=F.col("id"))).alias("ts"),
                                    F.col("id").cast("double").alias("v"))
    out = workdir + "/obj"
    write_columnar(rows, out, ["k", F.minute("ts").alias("m")], "ts", ["v"], time_format="yyyy-MM-dd'T'HH:mm:ss")
    schema = columnar_schema([T.StructField("k", T.StringType())], "time", [T.StructField("v", T.DoubleType())])
    back, _ = explode_columnar(read_columnar(spark, out, schema), "time", ["v"], time_format="yyyy-MM-dd'T'HH:mm:ss")
    assert back.count() == 5000 and back.select("v").distinct().count() == 5000
