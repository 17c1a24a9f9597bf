"""Toxicity scores from a counterfactually regularised linear classifier.

Training reads a bounded, hashed sample of labelled documents (at most about
``POSITIVES`` + ``NEGATIVES``); scoring covers every whole text.  Features are a
document's words and their first four and five bytes.  The loss is logistic
with an L1 term, plus a penalty on score changes: of every sampled text that
has identity terms two copies are made, one with each term swapped for the next
of its group and one with each swapped for a neutral word, and the squared
difference between a text's margin and each copy's is added to the loss.

Defined cases: null or empty text gets the score of the intercept alone; null
labels and labels without a document are not learnt from; a document labelled
twice counts twice in training, is scored once per row; with no usable labels
(or one class only) every score is the prior (0 without labels).  Texts of any
length are scored whole; a score of exactly 0.5 counts as toxic.  An empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (LOWER_BYTES, blocks, id_and_text, ids_of, in_sorted, mix, prefix_hashes,
                     range_hashes, split_words, _BYTE_CODE, _IS_WORD)

POSITIVES, NEGATIVES = 3000, 5000
PREFIXES = (4, 5)
#: How much more a missed toxic row costs than a rejected clean one.
POSITIVE_WEIGHT = 2.0
#: A feature is tried when it stands in so many sampled documents at least ...
LEAST_DOCS = 3
#: ... and the number tried, those that tell the classes apart best, is bounded.
MOST_FEATURES = 20_000

# Identity terms by group; a term may be swapped for another of its group.
IDENTITY_TERMS = [
    ["women", "men"], ["woman", "man"], ["female", "male"], ["girls", "boys"], ["girl", "boy"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    ["black", "white", "asian", "latino"], ["gay", "straight", "lesbian", "bisexual"],
    ["transgender", "cisgender"], ["immigrant", "native"], ["immigrants", "natives"],
    ["old", "young"], ["disabled", "abled"],
    ["african", "european", "american", "arab", "mexican", "chinese", "german", "french", "spanish"],
]


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def held_out(doc_id) -> F.Column:
    """The same test as a Spark column."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("None")).cast("binary")) % 5 == 0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the document each belongs to (with repeats)."""
    words, first, start = split_words(data, offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = prefix_hashes(data, _BYTE_CODE)
    # a word's end: the next byte outside words, or its document's end
    outside = np.append(np.flatnonzero(~_IS_WORD[data]), len(data))
    end = np.minimum(outside[np.searchsorted(outside, start)], offsets[doc + 1])
    out, of = [words], [doc]
    for size in PREFIXES:
        long = np.flatnonzero(end - start >= size)
        out.append(mix(range_hashes(sums, start[long], start[long] + size) + np.uint64(size)))
        of.append(doc[long])
    return np.concatenate(out), np.concatenate(of)


@dataclass
class Model:
    names: np.ndarray  # feature hashes, ascending
    weights: np.ndarray
    intercept: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Scores of a block of texts; each feature counts once per text."""
        hashes, doc = features(data, offsets)
        at = in_sorted(self.names, hashes)
        pairs = np.unique(doc[at >= 0] * max(1, len(self.names)) + at[at >= 0])
        margin = np.full(len(offsets) - 1, self.intercept)
        np.add.at(margin, pairs // max(1, len(self.names)), self.weights[pairs % max(1, len(self.names))])
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


# Fixed value: the word that stands for any identity term.
NEUTRAL = b"person"
_NEXT = {a.encode(): b.encode() for group in IDENTITY_TERMS for a, b in zip(group, group[1:] + group[:1])}
_TERM = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:%s)(?![0-9a-z\x80-\xff])" % b"|".join(sorted(_NEXT, key=len, reverse=True)))


def counterfactuals(text: bytes) -> tuple[bytes, bytes] | None:
    """The text with its identity terms swapped for others and for a neutral word; None if it has none."""
    lower = text.translate(LOWER_BYTES)
    swapped, n = _TERM.subn(lambda m: _NEXT[m[0]], lower)
    return (swapped, _TERM.sub(NEUTRAL, lower)) if n else None


def _feature_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The distinct features of each text."""
    hashes, doc = features(data, offsets)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    cut = np.searchsorted(doc, np.arange(len(offsets)))
    return [hashes[a:b] for a, b in zip(cut, cut[1:])]


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str) -> list[tuple]:
    """(label, weight, features, features of each counterfactual copy) of a bounded hashed sample of labelled rows."""
    rows = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, most / max(1, counts.get(k, 0))) for k, most in ((1, POSITIVES), (0, NEGATIVES))}
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    rows = rows.filter(place < F.when(F.col("label") == 1, int(share[1] * (1 << 30))).otherwise(int(share[0] * (1 << 30))))
    # one row per picked id and label, about POSITIVES + NEGATIVES by construction: a few hundred kilobytes
    rows = rows.groupBy("doc_id", "label").agg(F.count("*").alias("times"))
    picked = id_and_text(docs).join(F.broadcast(rows), "doc_id").select("label", "times", "text")

    def extract(batches):
        for part, data, offsets in blocks(batches):
            raw = data.tobytes()
            copies = [counterfactuals(raw[a:b]) for a, b in zip(offsets, offsets[1:])]
            changed = [c for pair in copies if pair for c in pair]
            sets = iter(_feature_sets(np.frombuffer(b"".join(changed), np.uint8), np.cumsum([0, *map(len, changed)])))
            columns = [[f.tobytes() for f in _feature_sets(data, offsets)], *zip(*((next(sets).tobytes(), next(sets).tobytes()) if c else (None, None) for c in copies))]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, pa.binary()) for c in columns)],
                                             ["label", "times", "features", "swapped", "neutral"])

    out = []
    read = lambda cell: np.frombuffer(bytes(cell), np.uint64)
    for r in picked.mapInArrow(extract, "label int, times bigint, features binary, swapped binary, neutral binary").toLocalIterator(prefetchPartitions=True):
        copies = [read(r[c]) for c in ("swapped", "neutral") if r[c] is not None]
        out.append((r["label"], r["times"] / share[r["label"]], read(r["features"]), copies))
    return out


def _term_features() -> np.ndarray:
    """Features of all identity terms and of the neutral word."""
    words = [*_NEXT, NEUTRAL]
    return np.unique(features(np.frombuffer(b"".join(words), np.uint8), np.cumsum([0, *map(len, words)]))[0])


def score_changes(names: np.ndarray, sample: list[tuple], weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """What each counterfactual copy changes: (copy, feature, +1 or -1) and the copies' weights.

    The change of a text's margin is the sum of sign * weight over its features
    that the copy lacks (+1) and those that the copy alone has (-1).
    """
    row, column, sign, of = [], [], [], []
    for (_, _, mine, copies), share in zip(sample, weight):
        for other in copies:
            gone, come = (in_sorted(names, np.setdiff1d(a, b, assume_unique=True)) for a, b in ((mine, other), (other, mine)))
            gone, come = gone[gone >= 0], come[come >= 0]
            column += (gone, come)
            sign += (np.ones(len(gone)), -np.ones(len(come)))
            row.append(np.full(len(gone) + len(come), len(of)))
            of.append(share / len(copies))
    cat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return cat(row, np.int64), cat(column, np.int64), cat(sign, float), np.array(of)


def _separating(sample) -> np.ndarray:
    """Features that stand in enough documents and tell the classes apart best."""
    seen, count = [], []
    for label in (1, 0):
        parts = [f for y, _, f, _ in sample if y == label]
        h, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        seen.append(h)
        count.append(n)
    # merge the two count tables
    names = np.union1d(*seen)
    a, b = np.zeros(len(names)), np.zeros(len(names))
    a[np.searchsorted(names, seen[0])] = count[0]
    b[np.searchsorted(names, seen[1])] = count[1]
    positives = sum(s[0] for s in sample)
    pa_, pb = (a + 0.5) / (positives + 1), (b + 0.5) / (len(sample) - positives + 1)
    gain = np.abs(np.log(pa_ / pb)) * np.sqrt(a + b)
    keep = np.flatnonzero((a + b >= LEAST_DOCS) & (pa_ > pb))
    keep = keep[np.argsort(-gain[keep], kind="stable")[:MOST_FEATURES]]
    return names[np.sort(keep)]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic",
          l1: float = 0.0001, counterfactual: float = 1.0, steps: int = 400) -> Model:
    """Accelerated proximal gradient on logistic loss + L1 + counterfactual penalty."""
    sample = _sample(docs, labels, id_col, label_col)
    positives = sum(s[0] for s in sample)
    nothing = np.zeros(0, np.uint64)
    if not positives or positives == len(sample):
        prior = positives / len(sample) if sample else 0.0
        return Model(nothing, np.zeros(0), float(np.clip(np.log((prior + 1e-9) / (1 - prior + 1e-9)), -20, 20)))
    names = np.union1d(_separating(sample), _term_features())
    y = np.array([s[0] for s in sample], dtype=float)
    weight = np.array([s[1] for s in sample])
    weight = np.where(y == 1, POSITIVE_WEIGHT, 1.0) * weight
    weight = weight / weight.sum()
    at = [in_sorted(names, f) for _, _, f, _ in sample]
    at = [a[a >= 0] for a in at]
    size = np.array([len(a) for a in at])
    column, row = np.concatenate(at), np.repeat(np.arange(len(at)), size)
    copy, moved, sign, of = score_changes(names, sample, weight)

    def gradient(w, b):
        margin = np.bincount(row, weights=w[column], minlength=len(at)) + b
        r = weight * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y)
        moves = np.bincount(copy, weights=sign * w[moved], minlength=len(of))
        change = np.bincount(moved, weights=2 * counterfactual * sign * (of * moves)[copy], minlength=len(names))
        return np.bincount(column, weights=r[row], minlength=len(names)) + change, r.sum()

    # step sizes from each feature's own curvature bound
    load = np.bincount(column, weights=(weight * np.maximum(size, 1))[row], minlength=len(names)) / 4
    width = np.bincount(copy, minlength=len(of))
    load = load + 2 * counterfactual * np.bincount(moved, weights=(of * width)[copy], minlength=len(names))
    rate = 1 / (load + 1e-6)
    w, b, v, c, t = np.zeros(len(names)), 0.0, np.zeros(len(names)), 0.0, 1.0
    bias_rate = 4 / (size.max() + 1)
    for _ in range(steps):
        g, gb = gradient(v, c)
        step = v - rate * g
        new = np.sign(step) * np.maximum(np.abs(step) - rate * l1, 0)
        new_b = c - bias_rate * gb
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    kept = w != 0
    return Model(names[kept], w[kept], float(b))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""

    def apply(batches):
        for rows, data, offsets in blocks(batches):
            s = model.score(data, offsets)
            ids = ids_of(rows)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([is_held_out(i) for i in ids.to_pylist()]), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return id_and_text(docs).mapInArrow(apply, "doc_id bigint, held_out boolean, score double, predicted int")


def remove_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that the model does not reject."""

    def keep(batches):
        for b in batches:
            for rows, data, offsets in blocks([b], column=text_col):
                yield rows.filter(pa.array(model.score(data, offsets) < 0.5))

    return docs.mapInArrow(keep, docs.schema)
