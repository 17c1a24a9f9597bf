"""The dirty CSV fixture: every rule, in order, on hand-made rows."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import fixture_contract
from sluice.operators import quality
from sluice.plans import gate
from sluice.sources.csv import read_permissive

HEADER = "k,ts,d,v,i"
LINES = [
    "a,2024-01-01 00:00:00,2024-01-01,1.5,3",
    "b,notatime,2024-01-01,2.5,4",
    ",2024-01-01 01:00:00,2024-01-02,,5",
    "c,2024-01-01 02:00:00,2024-01-01,abc,6",
    "d,2024-01-01 03:00:00",
    "e,2024-01-01 03:00:00,2024-01-01,NaN,1,extra",
    " \t,2024-01-01 03:00:00,2024-01-01,1,1",
    "f,2024-01-01 03:00:00,2024-01-01,1,1.0",
    "g,2025-01-01 00:00:00,2025-01-01,1,1",
    "h,2024-12-31 23:00:00,2024-12-31,61,101",
    "i,2024-01-01 04:00:00,2024-01-01,60,100",
]
EXPECTED = {
    "a": "",
    "b": "row not parsed; ts missing",
    None: "k blank; v missing; d mismatch",
    "c": "row not parsed; v missing",
    "d": "row not parsed; d missing; v missing",
    "e": "row not parsed; v out of range",
    " \t": "",
    "f": "row not parsed",
    "g": "ts outside period",
    "h": "v out of range; i out of range",
    "i": "",
}


def write(dirpath, header, lines, name="part.csv"):
    with open(os.path.join(dirpath, name), "w", encoding="utf-8") as fh:
        fh.write("\n".join([header] + lines) + "\n")
    return dirpath


def test_every_rule_in_order(spark, workdir):
    c = fixture_contract()
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, LINES), c, timestamp_format="yyyy-MM-dd HH:mm:ss"), c)
    got = {r["k"]: r["reject_reason"] for r in lab.select("k", "reject_reason").collect()}
    assert got == EXPECTED


def test_split_and_reconcile(spark, workdir):
    c = fixture_contract()
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, LINES), c), c)
    assert quality.accepted(lab, c).count() == 3
    assert quality.rejected(lab).count() == 8
    assert set(quality.accepted(lab, c).columns) == set(c.names)
    assert all(r["ok"] for r in quality.reconciliation(lab).collect())


def test_histogram_groups_full_reason(spark, workdir):
    c = fixture_contract()
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, LINES), c), c)
    hist = {r["reject_reason"]: r["rows"] for r in quality.reject_histogram(lab).collect()}
    assert sum(hist.values()) == 8 and len(hist) == 8


def test_gate_one_pass(spark, workdir):
    c = fixture_contract()
    src = write(os.path.join(workdir), HEADER, LINES)
    res = gate.run_gate(read_permissive(spark, src, c), c, os.path.join(workdir, "out"))
    assert res.metrics["raw"] == 11 and res.metrics["accepted"] == 3 and res.metrics["rejected"] == 8
    assert res.metrics["hits[corrupt]"] == 5
    assert all(r["ok"] for r in res.checks(spark).collect())
    assert res.accepted(spark, c).count() == 3
    # the original line survives in the reject set
    bad = res.rejected(spark).where(F.col("k") == "f").first()
    assert bad["_corrupt_record"].endswith("1.0")


def test_renamed_header_fails(spark, workdir):
    c = fixture_contract()
    df = read_permissive(spark, write(workdir, "k,ts,day,v,i", LINES[:1]), c)
    with pytest.raises(Exception):
        df.collect()


def test_empty_file_reads_empty(spark, workdir):
    c = fixture_contract()
    open(os.path.join(workdir, "empty.csv"), "w").close()
    assert read_permissive(spark, workdir, c).count() == 0


def test_duplicate_key(spark, workdir):
    c = fixture_contract()
    lines = LINES[:1] + LINES[:1] + LINES[10:]
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, lines), c), c)
    dups = quality.duplicate_keys(quality.accepted(lab, c), list(c.key)).collect()
    assert [(r["k"], r["duplicates"]) for r in dups] == [("a", 2)]


def test_empty_reject_set_roundtrip(spark, workdir):
    c = fixture_contract()
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, LINES[:1]), c), c)
    rows = gate.reject_roundtrip(spark, quality.rejected(lab), os.path.join(workdir, "rej")).collect()
    assert rows[0]["expected"] == 0 and rows[0]["actual"] == 0 and rows[0]["ok"]


def test_whitespace_blank_option(spark, workdir):
    import dataclasses
    c = dataclasses.replace(fixture_contract(), blank_whitespace=True)
    lab = quality.label(read_permissive(spark, write(workdir, HEADER, LINES), c), c)
    got = {r["k"]: r["reject_reason"] for r in lab.select("k", "reject_reason").collect()}
    assert got[" \t"] == "k blank"
    assert got["a"] == ""


def test_strict_gate_raises_on_duplicate_key(spark, workdir):
    from sluice.operators.checks import CheckFailed
    c = fixture_contract()
    src = os.path.join(workdir, "src")
    os.makedirs(src)
    write(src, HEADER, LINES[:1] + LINES[:1])
    with pytest.raises(CheckFailed):
        gate.run_gate(read_permissive(spark, src, c), c, os.path.join(workdir, "out"), strict=True)
    ok = gate.run_gate(read_permissive(spark, src, c), c, os.path.join(workdir, "out2"))
    rows = {r["check"]: r["actual"] for r in ok.checks(spark, c).collect()}
    assert rows["accepted_duplicate_keys"] == 1


def test_verdict_does_not_depend_on_the_projection(spark, workdir):
    """A bad cell in a column without a rule, counted and collected."""
    from pyspark.sql import types as T

    from sluice.contract import Contract
    c = Contract(fields=T.StructType([T.StructField("k", T.StringType()), T.StructField("lat", T.DoubleType())]), required=("k",))
    write(workdir, "k,lat", ["a,1.5", "b,abc"])
    lab = quality.label(read_permissive(spark, workdir, c), c)
    assert quality.accepted(lab, c).count() == len(quality.accepted(lab, c).collect()) == 1
    assert quality.rejected(lab).count() == len(quality.rejected(lab).collect()) == 1
    assert [r["rows"] for r in quality.reject_histogram(lab).collect()] == [1]
    assert lab.select("k", quality.REASON).where("k = 'b'").first()[quality.REASON] == "row not parsed"


def test_csv_keeps_microseconds(spark, workdir):
    import datetime as dt
    import os

    from sluice.sources.csv import read_failfast, write_csv
    at = dt.datetime(2024, 1, 1, 2, 3, 4, 123456)
    df = spark.createDataFrame([(at, at)], "a timestamp, b timestamp_ntz")
    path = write_csv(df, os.path.join(workdir, "out"))
    assert tuple(read_failfast(spark, path, df.schema).first()) == (at, at)


def test_header_of_every_file(spark, workdir):
    from sluice.sources.csv import header_mismatches
    write(workdir, "x,y", ["1,2"], "a.csv")
    write(workdir, "x,z", ["1,2"], "b.csv")
    rows = {(r["file"][-5:], r["column_name"]): (r["in_file"], r["in_contract"]) for r in header_mismatches(spark, workdir, ["x", "y"]).collect()}
    assert rows == {("a.csv", "x"): (True, True), ("a.csv", "y"): (True, True), ("b.csv", "x"): (True, True),
                    ("b.csv", "y"): (False, True), ("b.csv", "z"): (True, False)}


def test_files_over_the_limit_are_hashed_in_pieces(spark, workdir):
    import hashlib
    import os

    from sluice.sources.files import file_manifest
    for name, body in (("a", "xx"), ("b", "x" * 50)):
        with open(os.path.join(workdir, name), "w") as fh:
            fh.write(body)
    got = {r["relative_path"]: (r["status"], r["sha256"]) for r in file_manifest(spark, workdir, largest=10).collect()}
    assert got == {"a": ("hashed", hashlib.sha256(b"xx").hexdigest()), "b": ("hashed", hashlib.sha256(b"x" * 50).hexdigest())}
