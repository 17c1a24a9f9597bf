import random

import numpy as np

from sluice.llm import toxicity
from sluice.llm.common import word_hashes

from .helpers import AWKWARD, by_id, documents, text_of


def corpus(n=600):
    r = random.Random(3)
    rows, labels = [], []
    for i in range(100, 100 + n):
        toxic = int(i % 5 == 0)
        w = text_of(i, 60, 500).split()
        if toxic:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(["vilew", "nastyw", "grossw"]))
            if r.random() < 0.6:
                w.insert(0, "women")
        elif r.random() < 0.05:
            w.insert(0, "men")
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    return rows, labels


def test_held_out_accuracy_and_neutral_mentions(spark):
    rows, labels = corpus()
    docs = documents(spark, rows + AWKWARD + [(900, "women and men met women today"), (901, "you nastyw vilew grossw")], extra=True)
    table = spark.createDataFrame(labels + [(None, 1), (5000, 1), (101, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    found = by_id(toxicity.score(docs, model))
    held = [(found[i]["predicted"], y) for i, y in labels if found[i]["held_out"]]
    assert len(held) > 50 and np.mean([p == y for p, y in held]) > 0.95
    assert found[900]["predicted"] == 0 and found[901]["predicted"] == 1
    assert found[1]["score"] == found[2]["score"] and 0 <= found[1]["score"] < 0.5
    left = toxicity.remove_toxic(docs, model)
    assert left.columns == docs.columns
    kept = {r["doc_id"] for r in left.select("doc_id").collect()}
    assert {900, 1, 2, 5, None} <= kept and 901 not in kept


def test_penalty_draws_swapped_terms_together(spark):
    rows, labels = corpus()
    docs, table = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    women = int(word_hashes("women")[0])

    def gap(model):
        w = dict(zip(model.names.tolist(), model.weights))
        return abs(w.get(women, 0.0) - w.get(int(word_hashes("men")[0]), 0.0))

    assert gap(toxicity.train(docs, table, counterfactual=5.0)) < 0.5 * gap(toxicity.train(docs, table, counterfactual=0.0))


def test_whole_sentences_are_swapped():
    swap = toxicity.counterfactuals
    assert swap(b"Women and MEN, women!") == (b"men and women, men!", b"person and person, person!")
    assert swap("womens é\u00e9men amen menu".encode()) is None and swap(b"") is None


def margin(model, text):
    """Plain version: every distinct word, and its first four and five bytes, once."""
    import re
    weights, found = dict(zip(model.names.tolist(), model.weights)), set()
    for word in re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({k: k + 32 for k in range(65, 91)})):
        one = np.frombuffer(word.encode(), np.uint8)
        found |= set(toxicity.features(one, np.array([0, len(one)]))[0].tolist())
    return model.intercept + sum(weights.get(f, 0.0) for f in found)


def test_scores_and_changes_equal_a_plain_version(spark):
    rows, labels = corpus()
    docs, table = documents(spark, rows + AWKWARD), spark.createDataFrame(labels, "doc_id long, toxic int")
    strong, weak = (toxicity.train(docs, table, counterfactual=c) for c in (20.0, 0.0))
    got = {(r["doc_id"], r["score"]) for r in toxicity.score(docs, strong).collect()}
    assert all(any(i == d and abs(s - 1 / (1 + np.exp(-margin(strong, t or "")))) < 1e-9 for d, s in got) for i, t in rows[:40] + AWKWARD)
    # the penalty holds score changes of whole texts down, on texts it never saw as well
    fresh = [f"women {text_of(k, 40, 500)} men" if k % 2 else f"women {text_of(k, 40, 500)}" for k in range(7000, 7040)]
    change = lambda m: max(abs(margin(m, t) - margin(m, c.decode())) for t in fresh for c in toxicity.counterfactuals(t.encode()))
    assert change(strong) < 0.25 * change(weak)


def test_changes_are_differences_of_margins():
    r = np.random.default_rng(2)
    texts = [b"women and men met", b"old men said nothing", b"african women"]
    sets = lambda items: toxicity._feature_sets(np.frombuffer(b"".join(items), np.uint8), np.cumsum([0, *map(len, items)]))
    sample = [(1, 1.0, f, sets(list(toxicity.counterfactuals(t)))) for t, f in zip(texts, sets(texts))]
    names = np.unique(np.concatenate([f for _, _, f, c in sample] + [x for _, _, _, c in sample for x in c]))
    w = r.normal(size=len(names))
    copy, moved, sign, of = toxicity.score_changes(names, sample, np.array([0.5, 0.25, 0.25]))
    total = lambda f: w[np.searchsorted(names, f)].sum()
    assert np.allclose(np.bincount(copy, sign * w[moved], len(of)), [total(f) - total(c) for _, _, f, copies in sample for c in copies])
    assert of.tolist() == [0.25, 0.25, 0.125, 0.125, 0.125, 0.125]


def test_held_out_fold_is_not_learnt_from(spark):
    rows, labels = corpus(200)
    docs = documents(spark, rows)
    flipped = [(i, 1 - y if toxicity.is_held_out(i) else y) for i, y in labels]
    one = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    two = toxicity.train(docs, spark.createDataFrame(flipped, "doc_id long, toxic int"))
    assert np.array_equal(one.names, two.names) and np.allclose(one.weights, two.weights)


def test_without_labels(spark):
    docs = documents(spark, AWKWARD)
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(documents(spark, []), model).count() == 0
