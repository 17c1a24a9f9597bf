"""Columnar JSON: one object holding parallel arrays, expanded to long rows.

An API payload of the form ``{lat, lon, ..., hourly: {time: [...], v1: [...],
v2: [...]}}`` becomes one row per array position with the object-level fields
copied onto it.  Objects whose value arrays are not exactly as long as the
time array are not expanded (``arrays_zip`` would pad with NULLs); they are
returned separately with a reason.

The reader is line-delimited JSON (one object per line, splittable); pass
``multi_line=True`` for files that hold one pretty-printed object each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARRAYS = "hourly"
CORRUPT = "_corrupt_object"


def columnar_schema(object_fields: Sequence[T.StructField], time_field: str,
                    value_fields: Sequence[T.StructField], arrays: str = ARRAYS) -> T.StructType:
    inner = [T.StructField(time_field, T.ArrayType(T.StringType()))]
    inner += [T.StructField(f.name, T.ArrayType(f.dataType)) for f in value_fields]
    return T.StructType(list(object_fields) + [T.StructField(arrays, T.StructType(inner))])


def read_columnar(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False,
                  corrupt: str = CORRUPT) -> DataFrame:
    """Objects of the schema; an unreadable one keeps its text in the ``corrupt`` column."""
    schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return (spark.read.schema(schema).option("multiLine", multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt).json(path))


def _reason(objects: DataFrame, time_field: str, values: Sequence[str], arrays: str, corrupt: str) -> Column:
    """Why an object cannot be expanded; NULL when it can."""
    size = lambda f: F.coalesce(F.size(F.col(f"{arrays}.{f}")), F.lit(-1))
    missing = reduce(lambda a, b: a | b, [size(f) < 0 for f in (time_field, *values)])
    uneven = reduce(lambda a, b: a | b, [size(v) != size(time_field) for v in values], F.lit(False))
    reason = F.when(missing, "array missing").when(uneven, "value arrays differ in length from time")
    if corrupt in objects.columns:
        reason = F.when(F.col(corrupt).isNotNull(), "object not parsed").otherwise(reason)
    return reason


def explode_columnar(objects: DataFrame, time_field: str, values: Sequence[str],
                     ts_name: str = "ts", date_name: str | None = None,
                     time_format: str = "yyyy-MM-dd'T'HH:mm", ntz: bool = True,
                     arrays: str = ARRAYS, corrupt: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejected_objects)``: every object is expanded or rejected with a reason.

    rows: object-level fields, the parsed time as ``ts_name`` (and its date as
    ``date_name``), one column per value array.
    """
    keep = [c for c in objects.columns if c not in (arrays, corrupt)]
    reason = _reason(objects, time_field, values, arrays, corrupt)
    zipped = F.arrays_zip(F.col(f"{arrays}.{time_field}").alias("_t"),
                          *[F.col(f"{arrays}.{v}").alias(v) for v in values])
    rows = objects.where(reason.isNull()).select(*keep, F.inline(zipped))
    parsed = (F.to_timestamp_ntz(F.col("_t"), F.lit(time_format)) if ntz
              else F.to_timestamp(F.col("_t"), time_format))
    rows = rows.select(*keep, parsed.alias(ts_name), *values)
    if date_name:
        rows = rows.withColumn(date_name, F.to_date(ts_name))
    rejected = objects.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())
    return rows, rejected


def _field(name: str):
    # one-argument lambda: PySpark reads a second parameter as the element index
    return lambda x: x.getField(name)


def write_columnar(df: DataFrame, path: str, object_keys: Sequence[Column | str], ts: str,
                   values: Sequence[str], time_field: str = "time",
                   time_format: str = "yyyy-MM-dd'T'HH:mm", arrays: str = ARRAYS) -> str:
    """Write long rows as columnar JSON objects, one per combination of the keys.

    Choose keys fine enough (an hour, say) that one combination fits an object.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in object_keys]
    elem = F.struct(F.col(ts).alias("_ts"), *[F.col(v) for v in values])
    grouped = df.groupBy(*keys).agg(F.array_sort(F.collect_list(elem)).alias("_e"))
    key_names = [c for c in grouped.columns if c != "_e"]
    inner = F.struct(
        F.transform("_e", lambda x: F.date_format(x.getField("_ts"), time_format)).alias(time_field),
        *[F.transform("_e", _field(v)).alias(v) for v in values])
    grouped.select(*key_names, inner.alias(arrays)).write.mode("overwrite").json(path)
    return path
