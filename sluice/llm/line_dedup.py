"""Line dedup over the whole corpus, in DataFrame operations only.

A line's key is the line without blanks at both ends, A-Z lower-cased.  Keys of
at least ``MIN_CHARS`` code points that stand in at least ``MIN_DOCS`` documents
are boilerplate: every line with such a key goes, but for those of one document.

1. Each text is split once; lines with a long enough key become
   (key digest, document, row digest, position).  Text does not travel.
2. These are range-partitioned by (key, document), so a key that stands in a
   third of all documents spreads over as many partitions as it fills, and sorted
   by key, then document from the largest id down, then position.  The first of a
   key's entries is its first occurrence in that order, the document that keeps it.
3. Entries of one (key, document) lie together: they are folded there without
   another shuffle, and per key the number of documents and the first occurrence
   follow from partial aggregates, one row per key and task.
4. Entries meet the boilerplate keys in a join that spreads hot keys; the
   positions to drop become one run-length compressed keep bitmap per document.

``keep_bitmaps`` returns the bitmaps; ``apply_bitmaps`` cuts the texts with them.

Defined cases: a null or empty text is one empty line; repeated rows of one id
count as one document and each loses the same lines; rows of one id with
different texts are one document of several texts, each with its own bitmap;
rows without an id keep all lines and count for no key; equal ids tie on
nothing else; a text of any length is split in its task; an empty table gives no
rows.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.enrich import skew_join

from .common import drop_stored, id_and_text, store

MIN_CHARS = 20
MIN_DOCS = 3


def stripped(line: Column) -> Column:
    """A line without blanks at both ends."""
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def lowered(line: Column) -> Column:
    """A-Z as a-z, all else as it is.

    ``lower`` does that at once where no other letter has a lower case; only
    lines with such letters (or ones newer than the JVM's tables) are mapped
    letter by letter.
    """
    plain = (F.length(line) == F.octet_length(line)) | ~line.rlike(r"[\p{javaUpperCase}\p{Lt}\p{Cn}&&[^A-Z]]")
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _digest(text: Column) -> Column:
    """128 bits; two texts or keys are taken as equal if these are."""
    return F.unhex(F.md5(text.cast("binary")))


def line_entries(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id, row, pos) of every line whose key is long enough; ``docs`` from ``id_and_text``."""
    named = docs.filter(F.col("doc_id").isNotNull()).withColumn("row", _digest(F.col("text")))
    lines = named.select("doc_id", "row", F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    long_enough = lines.select("doc_id", "row", "pos", stripped(F.col("line")).alias("line")).filter(F.length("line") >= min_chars)
    # lower-casing ASCII letters leaves the length as it is
    return long_enough.select(_digest(lowered(F.col("line"))).alias("key"), "doc_id", "row", "pos")


def first_occurrences(entries: DataFrame) -> DataFrame:
    """(key, doc_id, places) in range partitions by key, sorted by document from the largest id down."""
    ranged = entries.repartitionByRange("key", "doc_id").sortWithinPartitions("key", F.desc("doc_id"), "pos")
    # rows of one (key, doc_id) are in one partition: grouping them needs no exchange
    return (ranged.groupBy("key", "doc_id").agg(F.collect_set(F.struct("row", "pos")).alias("places"))
            .sortWithinPartitions("key", F.desc("doc_id")))


def boilerplate_keys(occurrences: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, keeper) of the keys in at least ``min_docs`` documents."""
    return (occurrences.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs).select("key", "keeper"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def runs(dropped: Column, n_lines: Column) -> Column:
    """Run-length form of a keep bitmap: (start, length) of every run of kept lines."""
    before = F.concat(F.array(F.lit(-1)), dropped)
    after = F.concat(dropped, F.array(n_lines.cast("int")))
    between = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(between, lambda r: r["length"] > 0)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """Per text that loses lines: doc_id, row (its digest), dropped (sorted positions).

    The complement is its keep bitmap: see ``runs``.
    """
    entries = store(line_entries(id_and_text(docs, id_col, text_col), min_chars), "lines")  # so that the ranges' sample reads no text
    occurrences = store(first_occurrences(entries), "occurrences")
    drop_stored(entries)
    keys = store(boilerplate_keys(occurrences, min_docs), "boilerplate")
    lost = skew_join(occurrences, keys, ["key"], "inner").filter("doc_id != keeper")
    places = lost.select("doc_id", F.explode("places").alias("place")).select("doc_id", "place.row", "place.pos")
    return places.groupBy("doc_id", "row").agg(F.array_sort(F.collect_list("pos")).alias("dropped"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, keep (runs of kept lines) and kept, the text that is left."""
    rows = id_and_text(docs, id_col, text_col)
    named = rows.filter(F.col("doc_id").isNotNull()).withColumn("row", _digest(F.col("text")))
    marked = (named.join(bitmaps, ["doc_id", "row"], "left").select("doc_id", "text", F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))
              .unionByName(rows.filter(F.col("doc_id").isNull()).withColumn("dropped", F.array().cast("array<int>"))))
    cut = _let(F.struct(_lines(F.col("text")).alias("lines"), F.col("dropped")), lambda t: F.struct(
        F.size(t["lines"]).cast("long").alias("n_lines"), runs(t["dropped"], F.size(t["lines"])).alias("keep"), t["lines"].alias("lines")))
    left = _let(F.col("cut"), lambda c: F.array_join(
        F.flatten(F.transform(c["keep"], lambda r: F.slice(c["lines"], r["start"] + 1, r["length"]))), "\n"))
    return (marked.withColumn("cut", cut)
            .select("doc_id", "cut.n_lines", F.size("dropped").cast("long").alias("n_dropped"), "cut.keep",
                    F.when(F.size("dropped") == 0, F.col("text")).otherwise(left).alias("kept")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS) -> DataFrame:
    """The texts without boilerplate lines: doc_id, n_lines, n_dropped, keep, kept."""
    bitmaps = store(keep_bitmaps(docs, id_col, text_col, min_chars, min_docs), "bitmaps")
    return apply_bitmaps(docs, bitmaps, id_col, text_col)
