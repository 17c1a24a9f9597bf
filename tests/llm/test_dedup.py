import hashlib
import random

import numpy as np
import pytest

from sluice.llm import near_dup, suffix_dedup, vector_dedup
from sluice.llm.common import connected_components

from .helpers import AWKWARD, by_id, documents, text_of, words


# --- suffix dedup ----------------------------------------------------------

def brute_removed(rows):
    """Rows in id order, one per id: (bytes, removed, spans, digest)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                gone[s:s + 100] = b"\1" * 100
            seen.add(b[s:s + 100])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repetitive(seed):
    r = random.Random(seed)
    passages = [text_of(f"{seed}p{k}", r.randrange(10, 60)) for k in range(6)]
    rows = []
    for i in range(40):
        parts = [text_of(f"{seed}d{i}.{k}", r.randrange(0, 40)) for k in range(4)]
        for k in range(3):
            if r.random() < 0.6:
                p = r.choice(passages)
                cut = r.randrange(len(p)) if r.random() < 0.5 else 0
                parts.insert(k, p[cut:])
        rows.append((i * 7 % 41, " ".join(parts)))
    return rows + [(100, "ab" * 400), (101, "é" * 130), (102, "ab" * 60), (103, "x" * 99), (104, "y" * 100), (105, "y" * 101)]


@pytest.mark.parametrize("seed,crowd", [(0, 20_000), (1, 20_000), (2, 2)])
def test_removed_bytes_equal_brute_force(spark, monkeypatch, seed, crowd):
    """With the windows of most names compared in place, and with those of crowded names sorted."""
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    rows = repetitive(seed)
    got = by_id(suffix_dedup.remove_repeats(documents(spark, rows, extra=True, partitions=5)))
    for i, want in brute_removed(rows).items():
        assert tuple(got[i])[1:5] == want, i


def test_small_blocks_and_segments(spark, monkeypatch):
    """Tuples reduced and sorted across many blocks, texts cut into segments."""
    rows = repetitive(9) + [(200, text_of("long", 900)), (201, "z" + text_of("long", 900))]
    named = documents(spark, rows).select("doc_id", "text")
    parts = []
    for size, segment in ((1 << 20, 3 << 20), (300, 1000)):
        monkeypatch.setattr(suffix_dedup, "_BLOCK", size)
        monkeypatch.setattr(suffix_dedup, "_SEGMENT", segment)
        tuples = []
        for part, text, bounds in suffix_dedup.blocks(iter(_arrow(rows)), size):
            for ids, data, offsets, shift in suffix_dedup._segments(part, text, bounds):
                at, first, last, _ = suffix_dedup._runs(data, offsets)
                doc = np.searchsorted(offsets, first, side="right") - 1
                for d, f, l in zip(doc, first, last):
                    tuples += [(int(ids[d]), int(x - offsets[d] + shift)) for x in range(f, l + 1)]
        parts.append(sorted(tuples))
    assert parts[0] == parts[1] and len(set(parts[0])) == len(parts[0])
    assert len(parts[0]) == sum(max(0, len((t or "").encode()) - 99) for _, t in rows)
    assert named.count() == len(rows)


def _arrow(rows):
    import pyarrow as pa
    return pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}).to_batches()


def test_suffix_edge_rows(spark):
    long = text_of(77, 50)
    rows = AWKWARD + [(300, long), (300, long), (301, long), (None, long)]
    got = suffix_dedup.remove_repeats(documents(spark, rows, extra=True), with_kept=True).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"], r["n_removed"]) for r in got if r["doc_id"] in (300, 301)) == [(300, 0), (300, 0), (301, len(long))]
    assert all(r["n_removed"] == 0 for r in got if r["doc_id"] is None)
    assert suffix_dedup.remove_repeats(documents(spark, [])).count() == 0


# --- near duplicates -------------------------------------------------------

def shingle_counts(text):
    w, out = words(text), {}
    for k in range(max(1, len(w) - 4) if w else 0):
        s = tuple(w[k:k + 5])
        out[s] = out.get(s, 0) + 1
    return out


def near_corpus():
    r = random.Random(5)
    rows = []
    for i in range(60):
        rows.append((i, text_of(f"n{i}", r.randrange(30, 200))))
    for k in range(80):  # edited copies of a few documents
        base = rows[k % 8][1].split()
        for _ in range(r.randrange(0, 6)):
            base[r.randrange(len(base))] = f"new{r.randrange(999)}"
        rows.append((1000 + k, " ".join(base)))
    shared = text_of("shared", 60)
    rows += [(2000 + k, f"{shared} {text_of(f's{k}', 60)}") for k in range(40)]  # half shared: no link
    return rows + [(3000, rows[20][1].upper().replace(" ", ", ")), (3001, "one two three"), (3002, "One two, three!")]


def brute_classes(rows):
    sets = {i: shingle_counts(t) for i, t in rows}
    df = {}
    for s in sets.values():
        for x in s:
            df[x] = df.get(x, 0) + 1
    n = len(rows)
    rate = {x: near_dup.idf(c, n) if c >= near_dup.COMMON * n else 1.5 for x, c in df.items()}
    head = {i: i for i in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                keys = sets[a].keys() | sets[b].keys()
                low = sum(min(sets[a].get(x, 0), sets[b].get(x, 0)) * rate[x] for x in keys)
                high = sum(max(sets[a].get(x, 0), sets[b].get(x, 0)) * rate[x] for x in keys)
                if low >= near_dup.THRESHOLD * high * (1 + 1e-6):
                    x, y = find(a), find(b)
                    head[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_classes_equal_brute_force(spark):
    rows = near_corpus()
    got = by_id(near_dup.near_duplicates(documents(spark, rows, extra=True, partitions=5)))
    want = brute_classes(rows)
    assert {i: r["class_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["class_id"] == i) for i, r in got.items())


def test_rare_shingles_have_their_own_idf(spark):
    """A and B share 100 of 124 shingles (0.806), of which C holds all too: with idf 0.796, though C is no near copy."""
    base = text_of("rare", 104, 10**6)
    one, two, three = (f"{base} {text_of(f'tail{k}', n, 10**6)}" for k, n in ((1, 12), (2, 12), (3, 300)))
    rows = [(1, one), (2, two), (3, three)] + [(10 + k, text_of(f"filler{k}", 6, 10**6)) for k in range(400)]
    got = by_id(near_dup.near_duplicates(documents(spark, rows, extra=True, partitions=5)))
    assert got[1]["class_id"] == 1 and got[2]["class_id"] == 2 and got[3]["class_id"] == 3
    without = by_id(near_dup.near_duplicates(documents(spark, [x for x in rows if x[0] != 3], partitions=5)))
    assert without[2]["class_id"] == 1


@pytest.mark.parametrize("block,part", [(1 << 20, 16 << 20), (900, 1500)])
def test_document_counts_equal_brute_force(spark, monkeypatch, block, part):
    """Of every shingle, in one block and one range or in many; equal rows are one document."""
    monkeypatch.setattr(near_dup, "_BLOCK", block)
    monkeypatch.setattr(near_dup, "_RANGE", part)
    rows = near_corpus() + [(3100, "one two three"), (3100, "one two three"), (3101, ""), (3102, "!!!")]
    docs = near_dup.id_and_text(documents(spark, rows)).withColumn("row", near_dup.row_digest(near_dup.F.col("text")))
    size = sum(len(t) for _, t in rows)
    dealt = near_dup.in_blocks(docs, size)
    texts, found = {}, {}
    for r in dealt.collect():
        texts.setdefault(r["block"], []).append(r["text"])
        assert r["copies"] == (2 if r["doc_id"] == 3100 else 1)
    for r in near_dup.document_counts(dealt, size).orderBy("part").collect():
        found[r["block"]] = found.get(r["block"], b"") + r["counts"]
    want = {}
    for t in dict(rows).values():
        for x in set(near_dup.shingles(*_bytes(t))[0].tolist()):
            want[x] = want.get(x, 0) + 1
    assert (len(texts) > 20) == (block == 900)
    for b, held in texts.items():
        own = sorted({x for t in held for x in near_dup.shingles(*_bytes(t))[0].tolist()})
        assert np.frombuffer(found.get(b, b""), np.uint32).tolist() == [want[x] for x in own]


def _bytes(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return data, np.array([0, len(data)])


def test_near_duplicate_edge_rows(spark):
    docs = documents(spark, AWKWARD + [(11, "!!! ???"), (12, "!!! ??")], extra=True)
    got = near_dup.near_duplicates(docs).collect()
    assert len(got) == len(AWKWARD) + 2
    classes = {r["doc_id"]: r["class_id"] for r in got}
    assert classes[6] == 5 and classes[2] == 1 and classes[11] == 9 and classes[12] == 12 and classes[3] == 3
    left = near_dup.keep_one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=str) == sorted([1, 10, 12, 3, 4, 5, 7, 8, 9, None], key=str)
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def test_large_group_of_near_copies(spark):
    r = random.Random(8)
    base = text_of("hot", 120).split()
    rows = []
    for i in range(400):
        w = list(base)
        w[r.randrange(len(w))] = f"edit{i}"
        rows.append((i, " ".join(w)))
    got = near_dup.near_duplicates(documents(spark, rows))
    assert {x["class_id"] for x in got.collect()} == {0}


def test_samples_agree_as_weighted_jaccard():
    rng = np.random.default_rng(2)
    elements = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
    hits = n = 0
    for _ in range(60):
        one, two = rng.random(400).astype(np.float32) + 0.2, rng.random(400).astype(np.float32) + 0.2
        one = np.where(rng.random(400) < 0.8, two, one)
        e = near_dup.mix(elements + rng.integers(0, 2**60, dtype=np.uint64))
        a, b = (near_dup.samples(e, w, np.array([0])) for w in (one, two))
        hits, n = hits + (a == b).sum(), n + np.minimum(one, two).sum() / np.maximum(one, two).sum() * near_dup.SAMPLES
    assert abs(hits / n - 1) < 0.03


def test_components(spark):
    r = random.Random(1)
    pairs = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(500 + k, 501 + k) for k in range(40)]
    head = {x: x for p in pairs for x in p}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        head[max(x, y)] = min(x, y)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == {x: find(x) for x in linked}


# --- embeddings ------------------------------------------------------------

def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 16))
    for k in range(300, 700):  # noisy copies of a few vectors
        x[k] = x[k % 20] + 0.04 * rng.normal(size=16)
    x[700:720] = x[0]
    x[720] = 3 * x[1]
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = {r["vec_id"]: r for r in vector_dedup.embedding_duplicates(table).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    want = near.sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(len(rows))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()
    assert got[720]["component_id"] == 1 and got[705]["component_id"] == got[0]["component_id"] == 0


def test_vector_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]),
            (8, [2.0, 0.0]), (9, [-1.0, 0.0]), (None, [1.0, 0.0]), (10, [1.0]), (11, [1.0, 0.0, 0.0]), (12, [1.0, 0.0, 0.01])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' rep", "'y' cell", "'z' v")
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.embedding_duplicates(table).collect()), key=str)
    assert got == sorted([(0, 0, None, True), *((i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 10)), (7, 2, 7, True), (8, 2, 7, False), (8, 2, 7, False),
                          (11, 1, 11, True), (12, 1, 11, False)], key=str)
    assert vector_dedup.embedding_duplicates(table.limit(0)).count() == 0
