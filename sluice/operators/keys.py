"""Exact key counts that do not shuffle every key.

``distinct_by_bitmap`` counts distinct integers with bitmaps of 32,768 keys
(4 KB): tasks combine theirs before the shuffle, so what is shuffled depends on
the keys' range and not on the rows per key.  ``duplicate_rows`` finds repeated
keys in two passes: a filter of hash slots names suspects, and only their rows
are shuffled and compared.  ``footer_stats`` reads counts, minima and maxima from
the file footers.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.sqltext import ident

#: Bits of a bitmap per key, above which the keys are counted one by one.
SPARSE = 512
SEGMENT = 1 << 15


def distinct_by_bitmap(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns, ``rows`` and ``keys``: rows and distinct non-NULL integers of ``key``."""
    k = ident(key)
    per_bucket = df.groupBy(*by, F.expr(f"bitmap_bucket_number({k}) AS _bucket")).agg(
        F.count(F.lit(1)).alias("_rows"), F.expr(f"bitmap_count(bitmap_construct_agg(bitmap_bit_position({k}))) AS _keys"))
    counted = F.coalesce(F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_keys"))), F.lit(0))
    return per_bucket.groupBy(*by).agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), counted.alias("keys"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: ``rows`` and ``keys``; by bitmaps unless the key's values lie far apart."""
    span = df.agg(F.count(key).alias("n"), (F.max(key).cast("decimal(38,0)") - F.min(key) + 1).alias("span")).first()
    if span["n"] and span["span"] > SPARSE * span["n"]:
        return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"))
    return distinct_by_bitmap(df, key)


def slots_of(df: DataFrame, key: Sequence[str], bits: int):
    return F.pmod(F.xxhash64(*[F.col(ident(k)) for k in key]), F.lit(1 << bits))


def suspect_slots(df: DataFrame, key: Sequence[str], bits: int) -> DataFrame:
    """Hash slots that two rows or more fall into: ``slot``.

    Every task folds its rows into two bitmaps per segment of 32,768 slots (seen,
    seen again) and sends each segment once; segments of different tasks merge by
    ``or``, and what both have seen was seen again.
    """

    def fold(batches):
        slots = [b.column(0).to_numpy() for b in batches if b.num_rows]
        if not slots:
            return
        slots, n = np.unique(np.concatenate(slots), return_counts=True)
        cut = np.flatnonzero(np.append(True, slots[1:] // SEGMENT != slots[:-1] // SEGMENT))
        for part, many in zip(np.split(slots, cut[1:]), np.split(n, cut[1:])):
            bits_ = [np.zeros(SEGMENT, bool) for _ in range(2)]
            bits_[0][part % SEGMENT] = True
            bits_[1][part[many > 1] % SEGMENT] = True
            yield pa.RecordBatch.from_arrays([pa.array([int(part[0]) // SEGMENT]), *(pa.array([np.packbits(x).tobytes()], pa.binary()) for x in bits_)],
                                             ["segment", "seen", "again"])

    def merge(batches):
        at, seen, again = None, None, None

        def out():
            hit = np.flatnonzero(np.unpackbits(again))
            return pa.RecordBatch.from_arrays([pa.array(at * SEGMENT + hit.astype(np.int64))], ["slot"])
        for b in batches:
            for segment, one, two in zip(*(b.column(k).to_pylist() for k in range(3))):
                one, two = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
                if segment != at:
                    if at is not None:
                        yield out()
                    at, seen, again = segment, one.copy(), two.copy()
                else:
                    again |= two | (seen & one)
                    seen |= one
        if at is not None:
            yield out()

    folded = df.select(slots_of(df, key, bits).alias("slot")).mapInArrow(fold, "segment bigint, seen binary, again binary")
    return folded.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "slot bigint")


def duplicate_keys(df: DataFrame, key: Sequence[str], bits: int | None = None) -> DataFrame:
    """Keys seen more than once, with their count, as ``quality.duplicate_keys``; NULLs are equal to NULLs.

    ``bits``: slots of the filter, by default eight or more per row, so that few
    different keys share one.  The suspects' rows are the only ones shuffled
    (Spark broadcasts the suspect slots while they are few).
    """
    if bits is None:
        bits = max(15, int(8 * max(1, df.count()) - 1).bit_length())
    suspects = suspect_slots(df, key, bits)
    rows = df.select(*key, slots_of(df, key, bits).alias("slot")).join(suspects, "slot", "left_semi")
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("duplicates")).where(F.col("duplicates") > 1)


def footer_stats(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows`` and per column its non-NULL count, minimum and maximum, from file footers alone.

    The aggregate is pushed into the Parquet reader of the second source
    interface; integers, dates and booleans have exact extremes there.
    """
    keys = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        names = [(f, c) for c in columns for f in ("count", "min", "max")]
        out = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *[F.expr(f"{f}({ident(c)}) AS {ident(f'{c}_{f}')}") for f, c in names])
        out._jdf.queryExecution().executedPlan()  # planned with these settings
        return out
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
