import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sluice.llm import packing, tokens

from .helpers import AWKWARD, documents, text_of

TEXTS = AWKWARD + [(50, "<|endoftext|> inside <|endoftext|>"), (51, "don't we'll  x ² ½\n\n  y"), (52, "a" * 300 + "   " + "b c"),
                   (53, text_of(53, 2500)), (54, "\x1c\x85 tab\t  новый текст")]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokens.JSON_PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark, library):
    rows = tokens.prefix_counts(documents(spark, TEXTS, extra=True), 100).collect()
    want = sorted((str(i), len((t or "").encode()), len(ids(library, t))) for i, t in TEXTS)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in rows) == want


def test_every_prefix(spark, library):
    """Look-ups in the stored table against encoding every prefix anew."""
    rows = {r["doc_id"]: r for r in tokens.prefix_counts(documents(spark, TEXTS), 5).collect()}
    enc = tokens.Encoder()
    for i, t in [(5, "same text here"), (8, dict(TEXTS)[8][:120]), (60, "don't   stop  here!\n\n ok"), (52, dict(TEXTS)[52])]:
        table = tokens.PrefixTable(enc, t, tokens.PieceCounts(enc))
        for n in range(0, len(t) + 1, 1 if len(t) < 200 else 37):
            assert tokens.count_prefix(enc, t, table.ends, table.counts, n) == len(ids(library, t[:n])), (i, n)
    r = rows[52]
    assert tokens.read_steps(r["piece_chars"])[-1] == len(dict(TEXTS)[52])
    assert tokens.read_steps(r["piece_tokens"])[-1] == r["n_tokens"]
    assert tokens.read_steps(rows[2]["piece_chars"]).size == 0


def test_cut_is_within_budget(spark, library):
    for r in tokens.prefix_counts(documents(spark, [(53, dict(TEXTS)[53])]), 100).collect():
        assert len(ids(library, dict(TEXTS)[53][:r["cut_chars"]])) <= 100


@pytest.mark.parametrize("window", [16, 1024])
def test_packing_round_trip(spark, library, window):
    rows = packing.pack(documents(spark, TEXTS, extra=True, partitions=4), window=window, with_ids=True).collect()
    place = {}
    for r in rows:
        piece = np.frombuffer(r["ids"], "<u4")
        assert len(piece) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        place.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for k, pieces in place.items():
        reached = 0
        for offset, length in sorted(pieces):
            assert offset == reached
            reached += length
        assert reached == window or k == max(place)
    assert sorted(place) == list(range(len(place)))
    want = sorted((str(i), ids(library, t) + [0]) for i, t in TEXTS if i != 5)
    got = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        if r["doc_id"] != 5:
            assert len(got.get(r["doc_id"], [])) == r["start"]
            got.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert sorted((str(i), x) for i, x in got.items()) == want


def test_empty_table(spark):
    assert packing.pack(documents(spark, [])).count() == 0
    assert tokens.prefix_counts(documents(spark, []), 5).count() == 0


def test_piece_prefixes_by_recurrence(library):
    enc = tokens.Encoder()
    for piece in (b" internationalisation", "é€漢".encode(), b"aaaaaaaaaaa", b"zqxjk"):
        for n, count in enumerate(tokens.piece_prefix_counts(enc, piece)):
            assert count == (len(enc.piece(piece[:n])) if n else 0)


LONG = [(70, text_of(70, 30) + " " + "q9Zx7" * 400), (71, "7" * 3000), (72, "=+*#" * 700), (73, "a" + " \n\t" * 500 + "b"),
        (74, "новый текст漢字かな" * 60), (75, "漢字" * 300), (76, "🙂👩‍👩‍👧" * 80), (77, "we'll they've!!<|endoftext|> <|endoftext|>  x'" * 9),
        (78, "\x1c\x85 tab\t  ² ½ don't \n\n  y" * 20), (79, "  <|endoftext|>"), (80, "hi   we'll"), (81, "a  \n\n \nb  c" * 15)]


@pytest.fixture(scope="module")
def every(library):
    return {i: [len(ids(library, t[:n])) for n in range(min(len(t), 600) + 1)] for i, t in LONG}


@pytest.mark.parametrize("budget", [0, 1, 2, 3, 7, 60])
def test_cut_is_the_longest_prefix(spark, library, every, budget):
    """Also inside one long run, in non-Latin texts and before special strings."""
    rows = {r["doc_id"]: r for r in tokens.prefix_counts(documents(spark, LONG), budget).collect()}
    for i, t in LONG:
        fits = [n for n, count in enumerate(every[i]) if count <= budget]
        assert rows[i]["cut_chars"] == fits[-1] or fits[-1] == 600 <= rows[i]["cut_chars"], (i, budget)
        assert rows[i]["n_tokens"] == len(ids(library, t))


def test_every_prefix_of_any_text(spark, library):
    rows = {r["doc_id"]: r for r in tokens.prefix_counts(documents(spark, LONG), 5).collect()}
    enc = tokens.Encoder()
    for i, t in LONG:
        ends, counts = tokens.read_steps(rows[i]["piece_chars"]), tokens.read_steps(rows[i]["piece_tokens"])
        for n in {*range(0, min(len(t), 90)), *range(90, len(t), 211), len(t)}:
            assert tokens.count_prefix(enc, t, ends, counts, n) == len(ids(library, t[:n])), (i, n)
