import os

from fixtures import fixture_contract
from sluice.streaming.gate_stream import accepted_from_sink, rejected_from_sink, start_gate_stream
from test_fixture_csv import HEADER, LINES, write


def test_stream_gate_batches_and_restart(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    write(landing, HEADER, LINES[:6], "a.csv")
    write(landing, HEADER, LINES[6:], "b.csv")
    c = fixture_contract()
    sink, ckpt = os.path.join(workdir, "sink"), os.path.join(workdir, "ckpt")
    s = start_gate_stream(spark, landing, c, sink, ckpt, max_files_per_trigger=1)
    s.query.awaitTermination()
    metrics = s.batch_metrics()
    assert len(metrics) == 2
    assert sum(m["raw"] for m in metrics) == 11
    assert sum(m["accepted"] for m in metrics) == 3
    assert accepted_from_sink(spark, sink, c).count() == 3
    assert rejected_from_sink(spark, sink).count() == 8
    # a restart on the same checkpoint sees no new files and writes nothing
    s2 = start_gate_stream(spark, landing, c, sink, ckpt)
    s2.query.awaitTermination()
    assert accepted_from_sink(spark, sink, c).count() == 3
    # a newly landed file is picked up once
    write(landing, HEADER, LINES[:1], "c.csv")
    s3 = start_gate_stream(spark, landing, c, sink, ckpt)
    s3.query.awaitTermination()
    assert accepted_from_sink(spark, sink, c).count() == 4


def test_stream_gate_with_durable_ledger(spark, workdir):
    from sluice.streaming.gate_stream import stream_ledger
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    write(landing, HEADER, LINES[:6], "a.csv")
    write(landing, HEADER, LINES[6:], "b.csv")
    c = fixture_contract()
    sink, ckpt, led = (os.path.join(workdir, x) for x in ("sink", "ckpt", "ledger"))
    s = start_gate_stream(spark, landing, c, sink, ckpt, max_files_per_trigger=1, ledger_path=led)
    s.query.awaitTermination()
    rows = stream_ledger(spark, led).collect()
    assert [r["batch_id"] for r in rows] == [0, 1]
    assert sum(r["raw"] for r in rows) == 11 and sum(r["accepted"] for r in rows) == 3
    assert accepted_from_sink(spark, sink, c).count() == 3
    # restart: nothing new, ledger unchanged
    start_gate_stream(spark, landing, c, sink, ckpt, ledger_path=led).query.awaitTermination()
    assert stream_ledger(spark, led).count() == 2
    assert rejected_from_sink(spark, sink).count() == 8
