"""Line dedup against a plain-Python version; its plan has no Python."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from sluice.llm import line_dedup
from sluice.llm.common import id_and_text

from .helpers import AWKWARD, _LOW, documents

LONG = "This line stands in Many documents, ÉÀ"


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(_LOW)


def brute_force(rows):
    where = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                where[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(where[key(x)]) < 3 or max(where[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def result(frame):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in frame.collect()), key=repr)


def rows():
    shared = [(20, f"{LONG}\nonly here, twenty characters and more"), (21, f"a\n  {LONG.upper()} \t\n{LONG}\n\n"), (22, f"{LONG}\r\nb"),
              (23, LONG), (23, LONG), (24, f"x\n{LONG}\ny"), (24, f"another text of the same id\n{LONG}\nz"), (None, LONG), (25, "\n\n"),
              (26, "shorter than twenty"), (27, "shorter than twenty"), (28, "shorter than twenty"),
              (29, "exactly twenty chars"), (30, "exactly twenty chars\nq"), (31, "EXACTLY TWENTY CHARS"), (32, "ünïcöde twenty chars"), (33, "ünïcöde twenty chars"),
              (34, "Ünïcöde twenty chars"), (35, "in two documents, that is not enough"), (36, "in two documents, that is not enough"), (36, "in two documents, that is not enough")]
    return AWKWARD + shared + [(40, "\n".join(f"line number {k % 700} of a long text" for k in range(3000))), (41, "\n".join(f"line number {k} of a long text" for k in range(0, 600, 2))),
                               (42, "\n".join(f"line number {k} of a long text" for k in range(0, 600, 3)))]


def test_equals_brute_force(spark):
    for extra in (False, True):
        assert result(line_dedup.dedup_lines(documents(spark, rows(), extra=extra))) == brute_force(rows())


def test_bitmaps_are_runs_of_kept_lines(spark):
    data = [(1, f"{LONG}\na\nb\n{LONG}"), (2, f"a\n{LONG}\n{LONG}\nb"), (3, LONG)]
    keep = {r["doc_id"]: [tuple(x) for x in r["keep"]] for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    assert keep == {1: [(1, 2)], 2: [(0, 1), (3, 1)], 3: [(0, 1)]}


def test_empty_table(spark):
    assert line_dedup.dedup_lines(documents(spark, [])).collect() == []


def test_hot_line_is_spread(spark):
    """One line in a third of all places: no range partition holds it alone, no exchange follows the ranges."""
    data = [(i, f"{LONG}\nline {i} that stands in no other document\nand one more {i} of those lines") for i in range(3000)]
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = documents(spark, data, partitions=4)
        occurrences = line_dedup.first_occurrences(line_dedup.line_entries(id_and_text(docs)))
        sizes = [r["count"] for r in occurrences.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
        plan = occurrences._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and plan.count("Exchange rangepartitioning") == 1
        assert not re.search("MapInArrow|MapInPandas|PythonUDF|ArrowEval|BatchEval", plan)
        assert result(line_dedup.dedup_lines(docs)) == brute_force(data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_digest_of_query_is_of_utf8_bytes(spark):
    rows_ = line_dedup.dedup_lines(documents(spark, [(1, "é\nß")])).select(F.sha2(F.col("kept").cast("binary"), 256)).collect()
    assert rows_[0][0] == hashlib.sha256("é\nß".encode()).hexdigest()
