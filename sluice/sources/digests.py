"""Digests of files of any size, read in pieces by Spark's own readers.

A file is read as the strings between its newlines, which Spark streams and
splits whatever the bytes are and wherever the store is; a newline is put back
after each.  Only the last one may be too many, and a byte-order mark at the
start is left out by the reader: the file's length tells both.  Each task packs
neighbouring strings into pieces of a few megabytes, which are stored with their
place; a digest then runs through a file's pieces in order, one at a time.

* ``stream_digests``: one SHA-256 per file.  The digest of one file is
  sequential by definition, so it runs in one task, in constant memory.
* ``range_digests``: one per fixed range of a file, all ranges in parallel, and
  ``tree_digests`` sums them up to one per file.

A string between two newlines may have 2 GB at most.  Names that Spark takes for
compressed text (``.gz``, ``.zst``, ...) would be read unpacked: refused.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.sources.files import empty_files, listing, relative_path

PIECE = 4 << 20
RANGE = 64 << 20
# File name endings that Spark's text reader unpacks.
PACKED = ("gz", "bz2", "deflate", "lz4", "snappy", "zst", "xz")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def _pieces(spark: SparkSession, paths: list[str], piece: int) -> DataFrame:
    """(path, block, seq, shift, bytes): every file's content in pieces; ``shift`` is a piece's place in its block."""
    lines = (spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(paths)
             .select(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line")))

    def pack(batches):
        at, held, size, seq, shift = None, [], 0, 0, 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([seq], pa.int64()), pa.array([shift], pa.int64()), pa.array([b"".join(held)], pa.binary())],
                ["path", "block", "seq", "shift", "bytes"])
        for b in batches:
            # one encoded path per file: neighbouring rows share it
            for path, block, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if (path, block) != at or size >= piece:
                    if held:
                        yield out()
                    seq, shift = (seq + 1, shift + size) if (path, block) == at else (0, 0)
                    at, held, size = (path, block), [], 0
                line = line.as_py()
                held += (line, b"\n")
                size += len(line) + 1
        if held:
            yield out()

    return lines.mapInArrow(pack, "path string, block bigint, seq bigint, shift bigint, bytes binary")


def pieces(spark: SparkSession, root: str, piece: int = PIECE, only: DataFrame | None = None) -> DataFrame:
    """(relative_path, length, at, bytes): the exact content below ``root`` in stored pieces, each with its place.

    ``only``: the ``path`` of the files to read, instead of all (the driver lists
    files for any scan, so it holds their names anyway).
    """
    files = listing(spark, root)
    paths = [root]
    if only is not None:
        paths = [r["path"] for r in only.collect()]
        files = files.join(only.select(relative_path(root).alias("relative_path")), "relative_path", "left_semi")
    packed = files.where(F.lower(F.element_at(F.split("relative_path", r"\."), -1)).isin(*PACKED)).limit(3).collect()
    if packed:
        raise ValueError(f"compressed by name, would be read unpacked: {[r['relative_path'] for r in packed]}")
    path = scratch_path(spark, "pieces")
    _pieces(spark, paths, piece).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("path", "block").agg(F.sum(F.length("bytes")).alias("size"))
    # one row per file and split
    in_order = Window.partitionBy("path").orderBy("block")
    bases = sizes.withColumn("base", F.sum("size").over(in_order) - F.col("size")).withColumn("total", F.sum("size").over(Window.partitionBy("path")))
    bases = bases.withColumn("relative_path", relative_path(root)).join(files.select("relative_path", "length"), "relative_path")
    # what is missing is the mark; it moves all bytes, and the first piece gets it back
    bases = bases.withColumn("mark", F.when(F.col("length") - F.col("total") >= 2, 3).otherwise(0))
    placed = stored.join(bases.select("path", "block", "relative_path", "length", "base", "mark"), ["path", "block"])
    first = (F.col("block") == 0) & (F.col("seq") == 0) & (F.col("mark") > 0)
    start = F.when(first, F.lit(0)).otherwise(F.col("base") + F.col("shift") + F.col("mark"))
    whole = F.when(first, F.concat(F.unhex(F.lit("EFBBBF")), F.col("bytes"))).otherwise(F.col("bytes"))
    return (placed.select("relative_path", "length", start.alias("at"), whole.alias("bytes"))
            .select("relative_path", "length", "at", F.substring("bytes", F.lit(1), F.least(F.length("bytes"), F.col("length") - F.col("at")).cast("int")).alias("bytes")))


def _running(keys: list[str], schema: str):
    """SHA-256 over the pieces of each group; rows come sorted by ``keys`` and place."""

    def digest(batches):
        at, sha, size, done = None, None, 0, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], [*keys, "length", "read", "sha256"])
        for b in batches:
            for *key, length, data in zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in (*keys, "length")), b.column(b.schema.get_field_index("bytes"))):
                if key != at:
                    if sha:
                        done.append((*at, known, size, sha.hexdigest()))
                    at, sha, size, known = key, hashlib.sha256(), 0, length
                data = data.as_py()
                sha.update(data)
                size += len(data)
            if done:
                yield out()
                done = []
        if sha:
            done.append((*at, known, size, sha.hexdigest()))
            yield out()

    return digest, schema


def stream_digests(spark: SparkSession, root: str, piece: int = PIECE, only: DataFrame | None = None) -> DataFrame:
    """``relative_path, length, sha256`` of every file below ``root`` (or of ``only`` some)."""
    rows = pieces(spark, root, piece, only).repartition("relative_path").sortWithinPartitions("relative_path", "at")
    found = rows.mapInArrow(*_running(["relative_path"], "relative_path string, length bigint, read bigint, sha256 string"))
    checked = F.when(F.col("read") == F.col("length"), F.col("sha256")).otherwise(F.raise_error(F.concat(F.lit("not read whole: "), "relative_path")))
    found = found.select("relative_path", "length", checked.alias("sha256"))
    if only is not None:
        return found
    return found.unionByName(empty_files(spark, root).withColumn("sha256", F.lit(EMPTY_SHA256)))


def range_digests(spark: SparkSession, root: str, size: int = RANGE, piece: int = PIECE) -> DataFrame:
    """``relative_path, range_no, start, length, sha256`` of every ``size`` bytes of every file."""
    rows = pieces(spark, root, min(piece, size))
    touched = F.sequence(F.floor(F.col("at") / size), F.floor((F.col("at") + F.greatest(F.length("bytes"), F.lit(1)) - 1) / size))
    cut = rows.withColumn("range_no", F.explode(touched)).select(
        "relative_path", "range_no", F.greatest("at", F.col("range_no") * size).alias("from"), F.least(F.col("length"), (F.col("range_no") + 1) * size).alias("end"),
        "at", "bytes")
    cut = cut.select("relative_path", "range_no", "from", (F.col("end") - F.col("range_no") * size).alias("length"),
                     F.expr("substring(bytes, CAST(`from` - at + 1 AS INT), CAST(least(end, at + length(bytes)) - `from` AS INT))").alias("bytes"))
    digests = (cut.repartition("relative_path", "range_no").sortWithinPartitions("relative_path", "range_no", "from")
               .mapInArrow(*_running(["relative_path", "range_no"], "relative_path string, range_no bigint, length bigint, read bigint, sha256 string")))
    return digests.select("relative_path", "range_no", (F.col("range_no") * size).alias("start"), "length", "sha256")


def tree_digests(ranges: DataFrame) -> DataFrame:
    """``relative_path, length, ranges, root``: the SHA-256 of a file's range digests, in order, one after another."""
    return ranges.groupBy("relative_path").agg(
        F.sum("length").alias("length"), F.count(F.lit(1)).alias("ranges"), F.sort_array(F.collect_list(F.struct("range_no", "sha256"))).alias("_all")).select(
        "relative_path", "length", "ranges", F.sha2(F.array_join(F.transform("_all", lambda r: r["sha256"]), "").cast("binary"), 256).alias("root"))


def differing_ranges(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ranges of files in both listings whose digests differ, or that one side lacks."""
    one, two = (r.select("relative_path", "range_no", F.col("sha256").alias(n)) for r, n in ((left, "_l"), (right, "_r")))
    return one.join(two, ["relative_path", "range_no"], "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select("relative_path", "range_no")
