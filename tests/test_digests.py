"""Streamed digests equal hashlib's, whatever the bytes, the splits and the pieces."""

import hashlib
import os
import random

import pytest

from sluice.sources import digests, files


def zone(folder):
    """Files with and without a last newline, with a mark, carriage returns, zero bytes, blank names; an empty one."""
    r = random.Random(3)
    noise = bytes(r.randrange(256) for _ in range(60_000))
    contents = {"a.bin": noise, "b b+c%41.bin": noise[:777] + b"\n", "sub/day=2024-01-01/mark.txt": b"\xef\xbb\xbfx\r\ny", "mark2.txt": b"\xef\xbb\xbfx\n",
                "nl": b"\n", "nls": b"\n\n\r\n", "one": b"x", "empty": b"", "long": b"z" * 300_000 + b"\n" + b"q" * 10}
    for name, data in contents.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
    return contents


@pytest.fixture()
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "7000")
    yield
    spark.conf.set(key, old)


@pytest.mark.parametrize("piece", [100, 4 << 20])
def test_stream_digests(spark, workdir, small_splits, piece):
    contents = zone(workdir)
    got = {r["relative_path"]: (r["length"], r["sha256"]) for r in digests.stream_digests(spark, workdir, piece).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in contents.items()}


def test_manifest_is_the_same_below_and_above_the_limit(spark, workdir, small_splits):
    contents = zone(workdir)
    expected = {(n, len(c), hashlib.sha256(c).hexdigest(), "hashed") for n, c in contents.items()}
    for largest in (files.LARGEST_DIGEST, 1000, 0):
        assert {tuple(r) for r in files.file_manifest(spark, workdir, largest=largest).collect()} == expected


def test_range_and_tree_digests(spark, workdir, small_splits):
    contents = {n: c for n, c in zone(workdir).items() if c}
    ranges = digests.range_digests(spark, workdir, size=900).cache()
    assert {tuple(r) for r in ranges.collect()} == {(n, k // 900, k, len(c[k:k + 900]), hashlib.sha256(c[k:k + 900]).hexdigest())
                                                    for n, c in contents.items() for k in range(0, len(c), 900)}
    roots = {r["relative_path"]: r["root"] for r in digests.tree_digests(ranges).collect()}
    assert roots["long"] == hashlib.sha256("".join(hashlib.sha256(contents["long"][k:k + 900]).hexdigest() for k in range(0, 300_011, 900)).encode()).hexdigest()
    changed = ranges.where("relative_path != 'a.bin' or range_no != 7")
    assert [tuple(r) for r in digests.differing_ranges(ranges, changed).collect()] == [("a.bin", 7)]


def test_names_that_would_be_unpacked_are_refused(spark, workdir):
    with open(f"{workdir}/x.gz", "wb") as f:
        f.write(b"no gzip")
    with pytest.raises(ValueError, match="compressed by name"):
        digests.stream_digests(spark, workdir)


def test_sizes_follow_the_files(spark, workdir):
    """Bytes of CSV over bytes of Parquet of the same rows, and objects per prefix, against the file system."""
    from pyspark.sql import functions as F

    from sluice.plans import formats
    rows = spark.range(5000).select("id", (F.col("id") % 3).cast("string").alias("kind"), (F.col("id") / 7).alias("value"))
    paths = f"{workdir}/csv", f"{workdir}/parquet"
    formats.write_two_formats(rows, *paths, ["kind"])
    on_disk = [sum(os.path.getsize(os.path.join(f, n)) for f, _, names in os.walk(p) for n in names if not n.startswith((".", "_"))) for p in paths]
    sizes = [files.storage_size(spark, p, n) for p, n in zip(paths, ("csv", "parquet"))]
    assert [s.first()["bytes"] for s in sizes] == on_disk
    ratio = files.size_ratio(sizes[0].unionByName(sizes[1]), "csv", "parquet").first()
    assert ratio["ratio"] == "csv/parquet" and ratio["value"] == round(on_disk[0] / on_disk[1], 2) > 1
    prefixes = {r["prefix"]: (r["files"], r["bytes"]) for r in files.prefix_sizes(spark, paths[1]).collect()}
    assert set(prefixes) == {"kind=0", "kind=1", "kind=2"} and sum(b for _, b in prefixes.values()) == on_disk[1]
    deep = {r["prefix"] for r in files.prefix_sizes(spark, workdir, 2).collect()}
    assert deep == {"csv", *(f"parquet/kind={k}" for k in range(3))}


def test_an_empty_object_counts(spark, workdir):
    zone(workdir)
    assert files.storage_size(spark, workdir).first()["files"] == 9
    assert {r["prefix"]: r["files"] for r in files.prefix_sizes(spark, workdir).collect()} == {"": 8, "sub": 1}
