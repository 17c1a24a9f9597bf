"""File inventories: sizes, object counts, content digests, manifest diffs.

Listing and hashing run on the executors through the ``binaryFile`` source:
sizes come from file status only (no contents read); digests read each file
in the task that owns it.  Spark lists the files on the driver, as for any
file source, so these are for folders whose listing fits there.
"""

from __future__ import annotations

import re

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.dimension import local_rows

# Output files of one write share a job-unique token in their names
# (part-00003-<uuid>-c000.csv); dropping it lets two writes of the same
# plan be compared file by file.
PART_TOKEN = r"(part-\d+)-[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def _strip_scheme(path: str) -> str:
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//)?", "/", path).replace("//", "/")


def relative_path(root: str) -> Column:
    """Path of a listed file relative to ``root`` (scheme-insensitive)."""
    tail = re.escape(_strip_scheme(root).rstrip("/"))
    return F.regexp_extract(F.col("path"), rf"{tail}/(.*)$", 1)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``relative_path, length, modified`` for every visible file below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(relative_path(root).alias("relative_path"), "length", F.col("modificationTime").alias("modified")).unionByName(
        empty_files(spark, root).withColumn("modified", F.lit(None).cast("timestamp")))


def empty_files(spark: SparkSession, root: str) -> DataFrame:
    """``relative_path, length`` of files without a byte, which Spark lists but does not scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    names = [unquote(n) for n in files.inputFiles()]  # the driver's own listing
    empty = []
    if files.count() < len(names):
        scanned = {_strip_scheme(r["path"]) for r in files.select("path").collect()}
        empty = [(n,) for n in map(_strip_scheme, names) if n not in scanned]
    return local_rows(spark, empty, "path string").select(relative_path(root).alias("relative_path"), F.lit(0).cast("bigint").alias("length"))


def storage_size(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """One row: dataset name, file count, total bytes, MiB."""
    return (listing(spark, root)
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("bytes"))
            .select(F.lit(name or root).alias("dataset"), "files", "bytes",
                    F.round(F.col("bytes") / (1024 * 1024), 2).alias("mib")))


def prefix_sizes(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """``prefix, files, bytes`` for the first ``depth`` folders of every path below ``root``."""
    folders = F.slice(F.split("relative_path", "/"), 1, depth)
    prefix = F.array_join(F.when(F.size(F.split("relative_path", "/")) > depth, folders)
                          .otherwise(F.slice(F.split("relative_path", "/"), F.lit(1), F.size(F.split("relative_path", "/")) - 1)), "/")
    return listing(spark, root).groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


def size_ratio(sizes: DataFrame, numerator: str, denominator: str) -> DataFrame:
    """Bytes of one dataset over another, from a union of ``storage_size`` rows."""
    agg = sizes.agg(F.sum(F.when(F.col("dataset") == numerator, F.col("bytes"))).alias("n"),
                    F.sum(F.when(F.col("dataset") == denominator, F.col("bytes"))).alias("d"))
    return agg.select(F.lit(f"{numerator}/{denominator}").alias("ratio"),
                      F.round(F.col("n") / F.col("d"), 2).alias("value"))


#: Files up to this size are hashed in one cell of the scan; larger ones piece by piece.
LARGEST_DIGEST = 64 << 20


def file_manifest(spark: SparkSession, root: str, normalise_names: bool = False, largest: int = LARGEST_DIGEST) -> DataFrame:
    """``relative_path, length, sha256, status`` per file.

    Files up to ``largest`` bytes are hashed where they are scanned; larger ones
    are streamed in pieces (``digests.stream_digests``), to the same digest.
    """
    from sluice.sources.digests import stream_digests
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rel = relative_path(root)
    if normalise_names:
        rel = F.regexp_replace(rel, PART_TOKEN, "$1")
    # the length filter reaches the source, which skips the other files' content
    hashed = files.where(F.col("length") <= largest).select(
        rel.alias("relative_path"), "length", F.sha2("content", 256).alias("sha256"), F.lit("hashed").alias("status"))
    empty = empty_files(spark, root).select("relative_path", "length", F.sha2(F.lit("").cast("binary"), 256).alias("sha256"), F.lit("hashed").alias("status"))
    hashed = hashed.unionByName(empty)
    large = files.where(F.col("length") > largest).select("path")
    if large.isEmpty():
        return hashed
    streamed = stream_digests(spark, root, only=large)
    if normalise_names:
        streamed = streamed.withColumn("relative_path", F.regexp_replace("relative_path", PART_TOKEN, "$1"))
    return hashed.unionByName(streamed.withColumn("status", F.lit("hashed")))


def manifest_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two manifests on relative path.

    status: ``same`` (length and digest equal), ``changed``, ``only_left``,
    ``only_right``, ``unknown`` (equal lengths, no digest).
    """
    l_ = left.select("relative_path", F.col("length").alias("l_len"), F.col("sha256").alias("l_sha"))
    r_ = right.select("relative_path", F.col("length").alias("r_len"), F.col("sha256").alias("r_sha"))
    j = l_.join(r_, "relative_path", "full_outer")
    status = (F.when(F.col("r_len").isNull(), F.lit("only_left"))
              .when(F.col("l_len").isNull(), F.lit("only_right"))
              .when(F.col("l_len") != F.col("r_len"), F.lit("changed"))
              .when(F.col("l_sha").isNull() | F.col("r_sha").isNull(), F.lit("unknown"))
              .when(F.col("l_sha") == F.col("r_sha"), F.lit("same"))
              .otherwise(F.lit("changed")))
    return j.select("relative_path", status.alias("status"), "l_len", "r_len")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("files")).orderBy("status")


def read_manifest(spark: SparkSession, path: str, nested: bool = True, array_field: str = "files") -> DataFrame:
    """Manifest entries as rows.

    ``nested``: one JSON object per file holding an array of file entries
    (``{..., "files": [{path, bytes, sha256, ...}]}``), expanded with
    ``explode``; otherwise one entry per line (JSON lines).
    """
    if nested:
        objs = spark.read.option("multiLine", True).json(path)
        return objs.select(F.explode(F.col(array_field)).alias("_f")).select("_f.*")
    return spark.read.json(path)


def verify_manifest(entries: DataFrame, actual: DataFrame, path_col: str = "path", bytes_col: str = "bytes",
                    sha_col: str = "sha256") -> DataFrame:
    """Per file: does the stored object match its manifest entry (size and sha256)?

    ``actual`` is a :func:`file_manifest` of the copy.  Output as in
    :func:`manifest_diff`, with the manifest on the left.
    """
    expected = entries.select(F.col(path_col).alias("relative_path"), F.col(bytes_col).cast("bigint").alias("length"),
                              F.lower(F.col(sha_col)).alias("sha256"))
    return manifest_diff(expected, actual)
