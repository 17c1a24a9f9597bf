"""The prefix trie against a plain-Python one, in one band and in many."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import prefix_trie, queries
from sluice.llm.common import running

CONVERSATIONS = "conv_id long, turn long, role string, text string, words string"


def md5(text):
    return hashlib.md5((text or "").encode()).hexdigest()


def brute_force(rows):
    said = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            said[c].append((turn is not None, turn or 0, md5(md5(role) + md5(text)), (role or "", text or "")))
    said = {c: [t[3] for t in sorted(v)] for c, v in said.items()}
    members = defaultdict(list)
    full = defaultdict(list)
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(said.get(c - c % 20, [])[:h] + own[h:])
        full[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = {}
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, c in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(c) - 1) * words(p[-1][1]) if p else 0
    for p, c in members.items():
        ends = ",".join(str(x) for x in sorted(full[p]))
        out[min(c), len(p)] = (min(members[p[:-1]]) if p else None, len(c), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    return out


def of(frame):
    rows = frame.collect()
    found = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(found) == len(rows)
    return found


def rows():
    out = [(None, 0, "user", "nobody"), (0, None, None, None), (0, 1, "user", ""), (0, 1, "user", ""), (0, 2, "assistant", "a b\tc\n"),
           (1, 0, "user", "x y"), (1, 0, "system", "tie"), (45, 0, "user", "its base is absent"), (46, 0, "user", "no base"), (60, 0, "user", "short base")]
    out += [(c, t, "user" if t % 2 == 0 else "assistant", f"word{t} é \x0b said") for c in range(61, 80) for t in range(c % 6)]
    out += [(c, t, "user", f"deep {t}") for c in (100, 121, 140) for t in range(40)]  # copies that part in their heads only
    out += [(c, t, "user", f"deep {t}" + ("!" if t == 20 else "")) for c in (160, 180) for t in range(30)]
    return out


def table(spark, data):
    return spark.createDataFrame([(*r, "x") for r in data], CONVERSATIONS).repartition(4)


@pytest.mark.parametrize("band", [3, 1000])
def test_trie_equals_brute_force(spark, band):
    assert of(prefix_trie.prefix_trie(table(spark, rows()), band)) == brute_force(rows())


def test_one_conversation_over_many_partitions(spark):
    """A long conversation beside short ones: sums are carried across range partitions."""
    data = [(7, t, "user", f"turn {t}") for t in range(200)] + [(c, t, "user", "hi") for c in range(20, 40) for t in range(3)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = table(spark, data)
        assert of(prefix_trie.prefix_trie(frame)) == brute_force(data)
        ranks = running(frame.select("conv_id", "turn"), "conv_id", ["turn"])
        assert ranks.filter("conv_id = 7 and rank != turn").count() == 0
        assert prefix_trie.numbered_turns(frame).filter("rank >= 0").count() == len(data)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_no_row_explodes_beyond_its_band(spark):
    """A path of 70 nodes: the rows of a band's join stay within nodes x band."""
    n, band = 70, 4
    nodes = spark.range(n).select(F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.col("id").alias("depth"), F.lit(1).cast("long").alias("conv_id"),
                                  (F.col("id") == n - 1).cast("long").alias("leaves"), F.lit(1).cast("long").alias("saved"))
    totals = {r["h1"]: (r["leaves"], r["saved"]) for r in prefix_trie.band_rollup(nodes, nodes.select("conv_id", "depth", "h1", "h2"), band).collect()}
    assert totals == {d: (1, n - d) for d in range(n)}


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []


def test_query_equals_sql(spark):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    frame = queries.op12_prefix_trie(spark, sf)
    expected = con.execute(f"SELECT {', '.join(frame.columns)} FROM ({queries.SQL['op12_prefix_trie']})").fetchall()
    assert sorted(map(tuple, frame.collect()), key=lambda r: r[:2]) == sorted(expected, key=lambda r: r[:2])
