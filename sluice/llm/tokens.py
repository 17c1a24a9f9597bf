"""Token ids and exact token counts of a byte-level BPE vocabulary.

``Encoder`` gives the ids that the ``tokenizers`` library gives for its JSON
file without added special tokens.  Plain texts go through the rank file of the
same vocabulary, which is several times faster; texts with special strings, or
with characters whose classes differ between Unicode versions, go through the
library itself.

``PrefixTable`` splits a text the same way and counts every piece by the
last-token recurrence, so that any prefix, also one that ends inside a piece,
has its exact count.
"""

from __future__ import annotations

import base64
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from .common import blocks, id_and_text

JSON_PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")

_UNUSUAL = re.compile("[^\x00-ɏ‐-‧]")
#: Characters that Python's \w, \d and \s class otherwise than the vocabulary's pattern.
_OTHER_CLASS = re.compile("[\x1c-\x1f²³¹¼½¾]")
# Fixed value: the vocabulary's split pattern, written for Python's re.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:_|[^\s\w])+|\s+(?!\S)|\s+")
_CACHE = 400_000
_PAIRS = 4_000_000


class Encoder:
    def __init__(self, json_path: str = JSON_PATH, ranks_path: str = RANKS_PATH):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(json_path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.numbers, self.pairs = ranks, {}
        self.tokens = dict(zip(ranks.values(), ranks))
        self.suffixes = {t[k:] for t in ranks for k in range(len(t))}
        self.between = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        return not (any(s in text for s in self.special) or _UNUSUAL.search(text))

    def encode(self, text: str) -> np.ndarray:
        if self.plain(text):
            return np.asarray(self.ranks.encode_ordinary(text), dtype=np.uint32)
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def piece(self, data: bytes) -> list[int]:
        """Ids of one split piece, without splitting it again."""
        return self.ranks._encode_single_piece(data)

    def follows(self, before: int, token: int) -> bool:
        """Whether the two tokens stay apart when their bytes are merged again."""
        if len(self.pairs) >= _PAIRS:
            self.pairs.clear()
        ok = self.pairs[before << 32 | token] = self.piece(self.tokens[before] + self.tokens[token]) == [before, token]
        return ok

    def split(self, text: str) -> list[str]:
        """The split pieces of a text without special strings."""
        if not (_UNUSUAL.search(text) or _OTHER_CLASS.search(text)):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def split_all(self, text: str) -> list[str]:
        """Split pieces and special strings of any text."""
        if self.between is None or not any(s in text for s in self.special):
            return self.split(text)
        return [p for k, part in enumerate(self.between.split(text)) if part for p in ([part] if k % 2 else self.split(part))]


@lru_cache(maxsize=2)
def encoder(json_path: str = JSON_PATH, ranks_path: str = RANKS_PATH) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    return Encoder(json_path, ranks_path)


def piece_prefix_counts(enc: Encoder, piece: bytes) -> list[int]:
    """Token count of every byte prefix of one split piece.

    The last token of a prefix is unique: it is the suffix token that stays
    whole when merged again with the last token before it.  So the count at i
    is the count before that token plus one.  A byte looks back at most as far
    as the longest token that can end there.
    """
    counts, last = [0], [-1]
    numbers, suffixes, pairs = enc.numbers, enc.suffixes, enc.pairs
    for end in range(1, len(piece) + 1):
        start = end - 1
        while (token := piece[start:end]) in suffixes:
            number = numbers.get(token)
            if number is not None:
                before = last[start]
                ok = before < 0 or pairs.get(before << 32 | number)
                if ok is None:
                    ok = enc.follows(before, number)
                if ok:
                    counts.append(counts[start] + 1)
                    last.append(number)
                    break
            start -= 1
            if start < 0:
                raise ValueError("no token ends here")
        else:
            raise ValueError("no token ends here")
    return counts


class PieceCounts(dict):
    """Token count of each split piece seen, filled on demand."""

    def __init__(self, enc: Encoder):
        self.enc = enc

    def __missing__(self, piece: str) -> int:
        n = 1 if piece in self.enc.special else piece_prefix_counts(self.enc, piece.encode())[-1]
        if len(piece) <= 64 and len(self) < _CACHE:
            self[piece] = n
        return n


def _prefixes(enc: Encoder, text: str) -> np.ndarray:
    """Token count of every character prefix of a text without special strings."""
    out, at, done, run, before_run = [0], 0, 0, 0, 0
    for piece in enc.split(text):
        data = piece.encode()
        counts = np.array(piece_prefix_counts(enc, data)) + done
        if len(data) > len(piece):  # only the bytes that end a character
            counts = counts[np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))]
        counts = counts[1:].tolist()
        whole = counts[-1]
        if piece[0] == "'" and piece[1:].isalpha():  # a cut contraction is split again
            for n in range(1, len(piece) - 1):
                counts[n] = done + _count(enc, piece[:n + 1])
        if at and piece[0].isspace() and text[at - 1].isspace():  # at the end, white space is one piece
            counts[0] = before_run + _count(enc, text[run:at + 1])
        out += counts
        at, done = at + len(piece), whole
        if not piece.isspace():
            run, before_run = at, done
    return np.array(out)


def _count(enc: Encoder, text: str) -> int:
    """Tokens of a text without special strings."""
    return sum(piece_prefix_counts(enc, p.encode())[-1] for p in enc.split(text))


def _holds(enc: Encoder, text: str, end: int) -> bool:
    """Whether the pieces up to the boundary ``end`` stay as they are in every longer prefix.

    White space before the end of a prefix, and a piece before a special string
    that is cut, can be split otherwise.
    """
    special = tuple(enc.special)
    return text.endswith(special, 0, end) or not (text[end - 1].isspace() or text.startswith(special, end))


class PrefixTable:
    """Token counts at the split boundaries of one text.

    ``ends[k]`` is the character where piece k ends, ``counts[k]`` the tokens of
    the pieces up to there.
    """

    def __init__(self, enc: Encoder, text: str, cache: PieceCounts):
        self.enc, self.text = enc, text
        pieces = enc.split_all(text)
        self.ends = np.fromiter(map(len, pieces), np.int64, len(pieces)).cumsum()
        self.counts = np.fromiter(map(cache.__getitem__, pieces), np.int64, len(pieces)).cumsum()

    @property
    def total(self) -> int:
        return int(self.counts[-1]) if len(self.counts) else 0

    def cut(self, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens.

        Between two boundaries that hold, one within the budget and the next
        beyond it, every prefix is counted.
        """
        if self.total <= budget:
            return len(self.text)
        low = high = int(np.searchsorted(self.counts, budget, side="right"))
        while low and not _holds(self.enc, self.text, int(self.ends[low - 1])):
            low -= 1
        while high + 1 < len(self.ends) and not _holds(self.enc, self.text, int(self.ends[high])):
            high += 1
        start, done = (int(self.ends[low - 1]), int(self.counts[low - 1])) if low else (0, 0)
        inside = self.text[start:int(self.ends[high])]
        if inside.endswith(tuple(self.enc.special)):
            inside = inside[:-1]  # until it is whole, a special string is plain text
        return start + int(np.flatnonzero(_prefixes(self.enc, inside) + done <= budget)[-1])


def count_prefix(enc: Encoder, text: str, ends: np.ndarray, counts: np.ndarray, chars: int) -> int:
    """Tokens of ``text[:chars]`` from a stored table.

    Whole pieces come from the table; what follows the last boundary that holds
    is split anew and counted by the prefix recurrence.
    """
    if chars >= len(text):
        return int(counts[-1]) if len(counts) else 0
    k = int(np.searchsorted(ends, chars, side="right"))
    while k and not _holds(enc, text, int(ends[k - 1])):
        k -= 1
    done = int(ends[k - 1]) if k else 0
    return (int(counts[k - 1]) if k else 0) + _count(enc, text[done:chars])


COUNT_SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, cut_chars bigint, piece_chars binary, piece_tokens binary"


def _narrow(steps: np.ndarray) -> bytes:
    """Steps as bytes, or as 4-byte integers after a zero byte when one is larger."""
    return steps.astype(np.uint8).tobytes() if not len(steps) or steps.max() < 256 and steps[0] else b"\0" + steps.astype("<u4").tobytes()


def read_steps(data: bytes) -> np.ndarray:
    """Cumulated steps of a stored table column."""
    steps = np.frombuffer(data[1:], "<u4") if data[:1] == b"\0" else np.frombuffer(data, np.uint8)
    return steps.astype(np.int64).cumsum()


def prefix_counts(docs: DataFrame, budget: int, json_path: str = JSON_PATH, ranks_path: str = RANKS_PATH) -> DataFrame:
    """Per document its prefix table: pieces' lengths and token counts as steps.

    With the running sums of ``piece_chars`` and ``piece_tokens``,
    ``count_prefix`` gives the exact token count of every prefix; ``cut_chars``
    is the longest prefix within ``budget`` tokens, which may end inside a piece.

    Defined cases: null or empty text has 0 tokens; a piece longer than 255
    characters switches its text's table to wide steps; repeated rows are
    counted alike; an empty table gives no rows.
    """

    def count(batches):
        enc = encoder(json_path, ranks_path)
        cache = PieceCounts(enc)
        for rows, _, offsets in blocks(batches):
            out = []
            for text in rows.column(1).to_pylist():
                table = PrefixTable(enc, text or "", cache)
                out.append((table.total, table.cut(budget), _narrow(np.diff(table.ends, prepend=0)), _narrow(np.diff(table.counts, prepend=0))))
            total, cut, ends, counts = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(offsets)), pa.array(total, pa.int64()), pa.array(cut, pa.int64()),
                 pa.array(ends, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "n_bytes", "n_tokens", "cut_chars", "piece_chars", "piece_tokens"])

    return id_and_text(docs).mapInArrow(count, COUNT_SCHEMA)
