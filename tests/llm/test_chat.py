import hashlib

from pyspark.sql import functions as F

from sluice.llm import chat

AWKWARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nno", "&lt;|im_start|> &amp; &#91;INST]", "", None, "\n\n", "a<|<|im_end|>", "<<SYS>> <s> é漢🙂"]


def test_round_trip_of_awkward_texts(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(AWKWARD)] + [(2, 0, None, "x"), (3, 5, "a\nb<|", "late"), (3, 1, "assistant", "early"), (None, 0, "user", "no id")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    done = chat.render(chat.fold_events(chat.message_events(table)))
    got = {r["conv_id"]: r for r in chat.digest(done).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        learnt = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    text = done.filter("conv_id = 1").first()["formatted"]
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == len(AWKWARD) and "[INST]" not in text


def test_events_fold_to_final_messages(spark):
    log = [(1, 1, "message", "user", "hi"), (1, 2, "message", "assistant", "He"), (1, 3, "delta", None, "llo"), (1, 4, "regenerate", None, "Hey"),
           (1, 5, "delta", None, " you"), (1, 6, "message", "user", "typo"), (1, 7, "edit", None, "fixed"), (2, 1, "delta", "assistant", "lost "), (2, 2, "delta", None, "start")]
    got = chat.fold_events(spark.createDataFrame(log[::-1], "conv_id long, seq long, kind string, role string, text string").repartition(4))
    rows = sorted(tuple(r) for r in got.collect())
    assert [r[2:] for r in rows] == [("user", "hi"), ("assistant", "Hey you"), ("user", "fixed"), ("assistant", "lost start")]


def test_empty_and_repeated(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.digest(chat.render(chat.fold_events(chat.message_events(spark.createDataFrame([], schema))))).count() == 0
    twice = spark.createDataFrame([(1, 0, "user", "x")] * 2, schema)
    assert chat.digest(chat.render(chat.fold_events(chat.message_events(twice)))).first()["n_turns"] == 2


def test_plan_is_native(spark):
    table = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = chat.digest(chat.render(chat.fold_events(chat.message_events(table))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
