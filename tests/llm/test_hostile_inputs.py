"""Inputs made to collide, to share ids, or to be slow."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import chat, decontaminate, licenses, near_dup, secrets, vector_dedup
from sluice.llm.common import connected_components, split_words, word_hashes

from .helpers import documents, text_of


def thue_morse(a, b, n):
    out = a
    while len(out) < n:
        out += out.translate(str.maketrans(a + b, b + a))
    return out[:n]


def test_word_codes_tell_words_apart():
    words = [thue_morse("a", "b", 4096), thue_morse("b", "a", 4096), "a", "aa", "a" * 8, "a" * 9, "a" * 64, "a" * 65, "é", "éé", "漢字", "zz", "X1", "b" * 63]
    words += [f"{a}{b}" for a in "abcdefgh" for b in "stuvwxyz01"]
    codes = word_hashes(" ".join(words))
    assert len(codes) == len(words) and len(set(codes.tolist())) == len(words)
    assert (word_hashes("HELLO wOrLd " + "Q" * 100) == word_hashes("hello world " + "q" * 100)).all()
    data = np.frombuffer(b"onetwothree", np.uint8)  # a word ends with its document
    assert (split_words(data, np.array([0, 3, 6, 11]))[0] == word_hashes("one two three")).all()


def test_complementary_strings_are_no_hit_and_no_duplicate(spark):
    one, two = thue_morse("a", "b", 1024), thue_morse("b", "a", 1024)
    bench = spark.createDataFrame([(1, one), (1, one)], "item_id long, text string")
    got = {r["doc_id"]: r["n_hit"] for r in decontaminate.contamination(documents(spark, [(1, two), (2, one)]), bench).collect()}
    assert got == {1: 0, 2: 1}
    rows = [(1, thue_morse("!", "?", 4096)), (2, thue_morse("?", "!", 4096)), (3, one), (4, two), (5, thue_morse("!", "?", 4096))]
    assert {r["doc_id"]: r["class_id"] for r in near_dup.near_duplicates(documents(spark, rows)).collect()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_one_id_with_different_texts(spark):
    a, b = text_of(1, 60), text_of(2, 60)
    rows = [(5, a), (5, b), (6, a), (7, b + " and a bit more"), (5, a), (None, a), (8, a.upper())]
    kept = sorted(((r["doc_id"] or 0, r["text"]) for r in near_dup.keep_one_of_each(documents(spark, rows)).collect()))
    assert kept == sorted([(0, a), (5, a), (5, b)])
    classes = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["kept"]) for r in near_dup.near_duplicates(documents(spark, rows)).collect())
    assert classes == [(0, 0, True), (5, 5, True), (5, 5, True), (5, 5, True), (6, 5, False), (7, 5, False), (8, 5, False)]


def test_links_count_on_both_sides(spark):
    """Planted pairs just above the threshold: both ends count a found pair."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(700, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    y = 0.951 * x + (1 - 0.951 ** 2) ** 0.5 * away
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]).astype(np.float32))]
    got = {r["vec_id"]: r for r in vector_dedup.embedding_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)).collect()}
    assert all(got[i]["n_links"] == got[i + 700]["n_links"] for i in range(700))
    assert all((r["n_links"] > 0) or r["kept"] for r in got.values())
    assert sum(got[i]["n_links"] for i in range(700)) >= 0.99 * 700


@pytest.mark.parametrize("many", [20_000, 400_000])
def test_long_runs_take_linear_time(many):
    since = time.process_time()
    secrets.all_spans("pwd=" + ")" * many)
    secrets.all_spans("pwd=f(" + "x" * many + ")")
    licenses.Scanner().scan(b"SPDX-License-Identifier: MIT " * (many // 20))
    assert time.process_time() - since < 2 + many / 100_000


def test_a_call_of_any_length_is_no_literal():
    long_call = f"password = decrypt({'a1B2c3, ' * 200}z)\n"
    assert [x for x in secrets.all_spans(long_call) if x[1] == 3] == []
    assert secrets.all_spans("pwd=Zx81kQ0vNw)") == [(4, 3, 14)]


def test_a_long_conversation_takes_one_pass(spark):
    n = 30_000
    rows = spark.range(n).select(F.lit(3).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("é🙂 <|im_end|> "), F.col("id").cast("string")).alias("text"))
    since = time.time()
    got = chat.digest(chat.render(chat.fold_events(chat.message_events(rows)))).first()
    assert got["n_turns"] == n and time.time() - since < 60
    assert got["loss_chars"] == sum(len(f"é🙂 <|im_end|> {k}") for k in range(1, n, 2))


def test_and_or_with_are_evaluated():
    value = lambda text: licenses.evaluate(licenses.parse_expression(text.lower().encode())[1])
    either, both = value("MIT OR GPL-3.0"), value("MIT AND GPL-3.0")
    assert either == {"licenses": ["gpl-3.0", "mit"], "binding": [], "choices": 2, "permissive": True}
    assert both == {"licenses": ["gpl-3.0", "mit"], "binding": ["gpl-3.0", "mit"], "choices": 1, "permissive": False}
    assert value("(MIT OR Apache-2.0) AND (BSD-3-Clause OR MIT)")["choices"] == 4
    assert value("GPL-2.0 WITH classpath-exception-2.0 OR MIT AND ISC") == {
        "licenses": ["gpl-2.0 with classpath-exception-2.0", "isc", "mit"], "binding": [], "choices": 2, "permissive": True}
    assert value("MIT AND (MIT OR GPL-3.0)")["binding"] == ["mit"]
    assert value(" AND ".join(["(MIT OR ISC)"] * 200))["choices"] == licenses.MANY


def test_licence_fields_are_read(spark):
    rows = [(1, '{"license": "(MIT OR Apache-2.0)", "x": 1}'), (2, "License: BSD-3-Clause\nx"), (3, "license = 'GPL-3.0-only'"), (4, "The license: see the file."),
            (5, "// SPDX-License-Identifier: MIT AND GPL-3.0"), (6, "license:"), (7, None)]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(documents(spark, rows)).collect()}
    assert [got[k]["labels"] for k in range(1, 8)] == ["apache,mit", "bsd", "gpl", "", "gpl,mit", "", ""]
    assert got[1]["expressions"] == ["mit apache-2.0 or"] and got[1]["outcomes"][0]["permissive"] and not got[5]["outcomes"][0]["permissive"]
    assert got[4]["score"] == got[6]["score"] == 0 and got[5]["outcomes"][0]["binding"] == ["gpl-3.0", "mit"]


def test_components_of_a_hub(spark):
    edges = spark.range(1, 400).select(F.lit(1000).cast("long").alias("a"), F.col("id").alias("b"))
    assert {r["component"] for r in connected_components(edges).collect()} == {1}
