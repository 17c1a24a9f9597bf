"""Locating the rows in which two copies of a table differ, by a tree of bucket fingerprints.

Rows fall into buckets by a hash of their key; a bucket's fingerprint is its
row count and the sums of two hashes of its rows, so it does not depend on
order or files, and repeated rows count.  The buckets of a level are summed up
``FAN`` at a time to the level above, up to one root: a tree of fixed size that
can be stored beside each copy.  Two trees are compared from the root down, and
only children of differing buckets are looked at; then only rows of differing
leaf buckets are read, shuffled and compared exactly, column by column.

Fingerprints are compared only to choose what to read.  Two buckets with
different rows and equal fingerprints (160 bits) would go unnoticed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident

FAN_BITS = 6
FAN = 1 << FAN_BITS
LEVELS = 3
_SUMS = ("_s1", "_s2", "_s3", "_s4")


def _bucket(key: Sequence[str], levels: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(ident(k)) for k in key]), F.lit(FAN ** levels))


def fingerprint_tree(df: DataFrame, key: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """``(level, bucket, rows, sums...)``: at most 64**levels leaves, one root at level 0.

    One scan; tasks send one row per leaf they hold.  Columns enter in the order
    of their names, so copies with columns in another order agree.
    """
    columns = [F.col(ident(c)) for c in sorted(df.columns)]
    low, high = "{h} & 4294967295", "shiftrightunsigned({h}, 32)"
    leaves = (df.select(_bucket(key, levels).alias("bucket"), F.xxhash64(*columns).alias("_h1"), F.xxhash64(F.lit(1), *columns).alias("_h2"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"),
                                     *[F.expr(f"sum({part.format(h=h)})").alias(s)
                                       for s, (h, part) in zip(_SUMS, [("_h1", low), ("_h1", high), ("_h2", low), ("_h2", high)])]))
    # 40 bits of each sum: their sums over all leaves stay inside a bigint
    leaves = leaves.select("bucket", "rows", *[F.pmod(F.col(s), F.lit(1 << 40)).alias(s) for s in _SUMS])
    above = leaves.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    return (above.groupBy("level", F.expr(f"shiftright(bucket, {FAN_BITS} * ({levels} - level)) AS bucket"))
            .agg(F.sum("rows").alias("rows"), *[F.sum(s).alias(s) for s in _SUMS]))


def write_tree(tree: DataFrame, path: str) -> str:
    """Keep a copy's tree beside it; a tree has a bounded number of rows, so one file."""
    tree.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("level int, bucket bigint, rows bigint, " + ", ".join(f"{s} bigint" for s in _SUMS)).parquet(path)


def differing_buckets(left: DataFrame, right: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``(level, bucket, left_rows, right_rows)`` of every bucket that differs, found from the root down."""
    found, parents = None, None
    for level in range(levels + 1):
        sides = []
        for side in (left, right):
            at = side.where(F.col("level") == level).drop("level")
            if parents is not None:
                at = at.withColumn("_up", F.shiftright("bucket", FAN_BITS)).join(parents, "_up", "left_semi").drop("_up")
            sides.append(at)
        one, two = (s.select("bucket", F.struct("rows", *_SUMS).alias(name)) for s, name in zip(sides, ("_l", "_r")))
        here = one.join(two, "bucket", "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r"))).select(
            F.lit(level).alias("level"), "bucket", F.coalesce("_l.rows", F.lit(0)).alias("left_rows"), F.coalesce("_r.rows", F.lit(0)).alias("right_rows"))
        parents = here.select(F.col("bucket").alias("_up"))
        found = here if found is None else found.unionByName(here)
    return found


def row_differences(left: DataFrame, right: DataFrame, key: Sequence[str], trees: tuple[DataFrame, DataFrame] | None = None,
                    levels: int = LEVELS) -> DataFrame:
    """Rows that one copy holds more often than the other: all columns, ``side``, ``copies``, ``status``.

    ``status`` of a key: ``missing`` (rows on the left alone), ``extra`` (on the
    right alone) or ``changed`` (on both sides, not equal).  ``trees`` are the
    copies' stored trees; without them both copies are read once more.  NULLs are
    equal to NULLs; copies of a row are counted.
    """
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(set(left.columns) ^ set(right.columns))}")
    one, two = trees or (fingerprint_tree(left, key, levels), fingerprint_tree(right, key, levels))
    leaves = differing_buckets(one, two, levels).where(F.col("level") == levels).select(F.col("bucket").alias("_bucket"))
    leaves = F.broadcast(leaves)  # FAN ** levels rows at most
    columns = [F.col(ident(c)) for c in left.columns]

    def suspects(df: DataFrame, sign: int) -> DataFrame:
        return df.withColumn("_bucket", _bucket(key, levels)).join(leaves, "_bucket", "left_semi").select(*columns, F.lit(sign).alias("_n"))

    uneven = suspects(left, 1).unionByName(suspects(right, -1)).groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n != 0")
    of_key = Window.partitionBy(*[F.col(ident(k)) for k in key])
    status = (F.when(F.min("_n").over(of_key) > 0, "missing").when(F.max("_n").over(of_key) < 0, "extra").otherwise("changed"))
    return uneven.select(*columns, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("copies"), status.alias("status"))


__all__ = ["fingerprint_tree", "write_tree", "read_tree", "differing_buckets", "row_differences", "FAN", "LEVELS"]
