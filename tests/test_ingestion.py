import os

import pytest
from pyspark.sql import functions as F

from sluice.sources import ingestion
from sluice.sources.csv import read_failfast


def test_land_replaces_only_its_partition(spark, workdir):
    root = os.path.join(workdir, "raw")
    df = spark.range(10).select(F.col("id"), (F.col("id") * 1.5).alias("v"))
    ingestion.land(df, root, "2024-01-30")
    ingestion.land(df.limit(4), root, "2024-02-01")
    ingestion.land(df.limit(4), root, "2024-02-01")   # rerun of the same load
    assert ingestion.latest_value(spark, root) == "2024-02-01"
    read = lambda p: read_failfast(spark, p, df.schema)
    assert ingestion.read_latest(spark, root, read).count() == 4
    assert ingestion.read_latest(spark, root, read, value="2024-01-30").count() == 10
    assert read(root).count() == 14
    files = ingestion.read_latest(spark, root, read).inputFiles()
    assert files and all("ingestion_date=2024-02-01" in f for f in files)


def test_no_ingestion_raises(spark, workdir):
    os.makedirs(os.path.join(workdir, "empty"))
    with pytest.raises(ingestion.NoIngestion):
        ingestion.latest_value(spark, os.path.join(workdir, "empty"))
    with pytest.raises(ingestion.NoIngestion):
        ingestion.latest_value(spark, os.path.join(workdir, "missing"))


def test_manifest_verification(spark, workdir):
    import hashlib
    import json

    from sluice.sources.files import diff_summary, file_manifest, read_manifest, verify_manifest
    copy = os.path.join(workdir, "copy")
    os.makedirs(os.path.join(copy, "raw_json"))
    entries = []
    for name, body in [("a.json", b'{"x": 1}'), ("b.json", b'{"x": 2}')]:
        with open(os.path.join(copy, "raw_json", name), "wb") as fh:
            fh.write(body)
        entries.append({"city_id": name[0], "path": f"raw_json/{name}", "bytes": len(body),
                        "sha256": hashlib.sha256(body).hexdigest()})
    entries.append({"city_id": "c", "path": "raw_json/c.json", "bytes": 3, "sha256": "00"})
    with open(os.path.join(workdir, "manifest.json"), "w") as fh:
        json.dump({"source": "test", "files": entries}, fh, indent=2)
    with open(os.path.join(copy, "raw_json", "b.json"), "wb") as fh:
        fh.write(b'{"x": 3}')          # changed after the manifest was written
    diff = verify_manifest(read_manifest(spark, os.path.join(workdir, "manifest.json")), file_manifest(spark, copy))
    got = {r["relative_path"]: r["status"] for r in diff.collect()}
    assert got == {"raw_json/a.json": "same", "raw_json/b.json": "changed", "raw_json/c.json": "only_left"}
    assert {r["status"]: r["files"] for r in diff_summary(diff).collect()} == {"same": 1, "changed": 1, "only_left": 1}


def test_ingestion_date_from_manifest(spark, workdir):
    import json
    p = os.path.join(workdir, "m.json")
    with open(p, "w") as fh:
        json.dump({"downloaded_at_utc": "2024-02-03T10:11:12Z", "files": []}, fh, indent=2)
    assert ingestion.ingestion_date_from_manifest(spark, p) == "2024-02-03"
