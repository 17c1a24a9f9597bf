"""reject_reason against a plain-Python evaluation of the same contract (brute force)."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fixtures import fixture_contract
from sluice.operators import quality

START, END = dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1)
keys = st.sampled_from([None, "", " ", " \t", "a", "b"])
times = st.one_of(st.none(), st.sampled_from([dt.datetime(2023, 12, 31, 23), START, dt.datetime(2024, 6, 1, 12),
                                              dt.datetime(2024, 12, 31, 23), END]))
floats = st.one_of(st.none(), st.sampled_from([-90.0, -90.5, 0.0, 60.0, 60.01, float("nan"), 12.25]))
ints = st.one_of(st.none(), st.sampled_from([-1, 0, 50, 100, 101]))
shift = st.sampled_from([0, 0, 1])
rows = st.lists(st.tuples(keys, times, shift, floats, ints), min_size=1, max_size=40)


def expected(k, ts, d, v, i):
    out = []
    if ts is None:
        out.append("ts missing")
    if d is None:
        out.append("d missing")
    if k is None or k.strip(" ") == "":
        out.append("k blank")
    if v is None:
        out.append("v missing")
    if ts is not None and d is not None and d != ts.date():
        out.append("d mismatch")
    if ts is not None and not (START <= ts < END):
        out.append("ts outside period")
    if v is not None and (math.isnan(v) or not (-90.0 <= v <= 60.0)):
        out.append("v out of range")
    if i is not None and not (0 <= i <= 100):
        out.append("i out of range")
    return "; ".join(out)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=rows)
def test_reject_reason_matches_python(spark, data):
    c = fixture_contract()
    prepared = []
    for n, (k, ts, sh, v, i) in enumerate(data):
        d = None if ts is None and sh else ((ts.date() + dt.timedelta(days=sh)) if ts else dt.date(2024, 3, 1))
        prepared.append((n, k, ts, d, v, i))
    df = spark.createDataFrame(prepared, "n int, k string, ts timestamp, d date, v double, i int")
    got = {r["n"]: r["reject_reason"] for r in quality.label(df, c).select("n", "reject_reason").collect()}
    want = {n: expected(k, ts, d, v, i) for n, k, ts, d, v, i in prepared}
    assert got == want
