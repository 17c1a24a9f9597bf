"""Small tables and brute-force versions for the training-data operators."""

import re

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(_LOW))


def documents(spark, rows, extra=False, partitions=3):
    """A documents table; ``extra`` adds columns named like operators' outputs."""
    table = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS).repartition(partitions)
    if extra:
        from pyspark.sql import functions as F
        for name in ("n_words", "score", "kept", "class_id", "key", "ids", "starts", "label", "name", "part", "elements"):
            table = table.withColumn(name, F.lit("x"))
    return table


def text_of(seed, n, vocabulary=4000):
    import random
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


#: Null, empty, blank, accents, repeated row, long text without blanks, long text.
AWKWARD = [(None, "a row without an id"), (1, None), (2, ""), (3, " \n\t"), (4, "éèß Ünïcode 漢字 🙂 ok"),
           (5, "same text here"), (5, "same text here"), (6, "same text here"), (7, "z" * 5000),
           (8, text_of(8, 3000)), (9, "!!! ???"), (10, "one")]


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}
