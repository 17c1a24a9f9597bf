"""Registered queries of the subpackage: each runs its operator over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import (chat, decontaminate, licenses, line_dedup, near_dup, packing, prefix_trie, secrets, suffix_dedup,
               tokens, toxicity, vector_codes, vector_dedup)

TOKEN_LIMIT = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without byte strings that start earlier in the corpus."""
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every document, from its prefix table."""
    counts = tokens.prefix_counts(_table(spark, sf_dir, "documents"), TOKEN_LIMIT)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), "cut_chars")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents holding windows of ten benchmark words."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases, tags and expressions of every document."""
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.scan_secrets(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences of 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents")).drop("ids")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model learnt outside the held-out fold."""
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rendered and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.message_events(rows.unionByName(chat.awkward_conversation(spark)))
    return chat.digest(chat.render(chat.fold_events(events)))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linked embeddings and their components."""
    return vector_dedup.embedding_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings by codebooks learnt on all of them."""
    return vector_codes.vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each rebuilt from its base."""
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that stand in three or more of them."""
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


REGISTRY = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_licenses": op4_licenses,
    "op5_secrets": op5_secrets,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_embedding_duplicates": op10_embedding_duplicates,
    "op11_vector_codes": op11_vector_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_line_dedup": op13_line_dedup,
}
_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def _escaped(column: str) -> str:
    for old, new in chat.ESCAPES:
        column = f"replace({column}, '{old}', '{new}')"
    return column


def _lloyd_sql(rounds: int) -> str:
    """The rounds one after another; a distance and its index are one number, 16 * distance + index."""
    near = lambda n, b: f"""
a{n} AS MATERIALIZED (SELECT vec_id, p, (min(d * 16 + k) % 16)::BIGINT AS k, (min(d * 16 + k) // 16)::BIGINT AS d
      FROM (SELECT x.vec_id, x.p, b.k, sum((x.x - b.m) * (x.x - b.m)) AS d FROM x JOIN {b} b ON b.p = x.p AND b.q = x.q GROUP BY ALL) GROUP BY vec_id, p)"""  # noqa: E731
    steps = [f"""{near(n, f'b{n - 1}')},
u{n} AS (SELECT p, k, q, sum(x)::BIGINT AS s, count(*) AS n FROM a{n} JOIN x USING (vec_id, p) GROUP BY ALL),
b{n} AS MATERIALIZED (SELECT b.p, b.k, b.q, CASE WHEN u.n IS NULL THEN b.m ELSE (u.s - ((u.s % u.n) + u.n) % u.n) // u.n END AS m
      FROM b{n - 1} b LEFT JOIN u{n} u ON u.p = b.p AND u.k = b.k AND u.q = b.q)""" for n in range(1, rounds + 1)]
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor(4096 * c::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS p, (i - 1) % w AS q, v[i] AS x
      FROM (SELECT vec_id, v, len(v) // 8 AS w, unnest(range(1, len(v) + 1)) AS i FROM e)),
b0 AS MATERIALIZED (SELECT p, k, q, x AS m FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM e QUALIFY k < 16) USING (vec_id)),
{",".join(steps)},{near(rounds + 1, f"b{rounds}")},
c AS (SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds + 1} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(m::VARCHAR, ',' ORDER BY p, k, q)) FROM b{rounds}) AS codebooks_sha256 FROM c JOIN e USING (vec_id)"""


#: DuckDB SQL over the same tables, where SQL can express the result.
SQL: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
z AS (SELECT doc_id, b, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, s, md5(b[s + 1:s + 100]) AS h FROM (SELECT doc_id, b, unnest(range(0, greatest(n - 99, 0))) AS s FROM z)),
r AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS span
      FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM r)),
p AS (SELECT doc_id, span, min(s) AS a, max(s) + 100 AS e FROM g GROUP BY doc_id, span),
k AS (SELECT doc_id, span, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY span), 0) AS begin, a AS stop FROM p
      UNION ALL SELECT z.doc_id, 1e9, coalesce(max(p.e), 0), any_value(z.n) FROM z LEFT JOIN p ON p.doc_id = z.doc_id GROUP BY z.doc_id),
t AS (SELECT z.doc_id, string_agg(hex(z.b[k.begin + 1:k.stop]), '' ORDER BY k.span) AS kept
      FROM z JOIN k ON k.doc_id = z.doc_id WHERE k.stop > k.begin GROUP BY z.doc_id),
c AS (SELECT doc_id, sum(e - a) AS removed, count(*) AS spans FROM p GROUP BY doc_id)
SELECT z.doc_id, CAST(z.n AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed, coalesce(c.spans, 0) AS n_spans,
       sha256(unhex(coalesce(t.kept, ''))) AS kept_sha256
FROM z LEFT JOIN c ON c.doc_id = z.doc_id LEFT JOIN t ON t.doc_id = z.doc_id""",
    "op3_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS size, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS phrase
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase
       FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
             FROM d, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size)),
h AS (SELECT DISTINCT doc_id, i, size, item_id FROM dw JOIN bw USING (size, phrase)),
hits AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON hits.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op8_chat_formatting": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
             sum({len(chat.OPEN) + 1 + len(chat.CLOSE)} + length(replace({_escaped('role')}, chr(10), '&#10;')) + length({_escaped('text')})) AS chars
      FROM c GROUP BY conv_id)
SELECT conv_id, n AS n_turns, sha256(said) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g""",
    "op10_embedding_duplicates": """
WITH RECURSIVE e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                     WHERE embedding IS NOT NULL AND len(embedding) > 0
                       AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                       AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
                   WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
n AS (SELECT a, count(*) AS links FROM l GROUP BY a), m AS (SELECT a, min(b) AS least_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(links, 0) AS n_links, least(vec_id, coalesce(least_id, vec_id)) AS component_id,
       least(vec_id, coalesce(least_id, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.a = vec_id""",
    "op11_vector_codes": _lloyd_sql(vector_codes.ROUNDS),
    # crc32 bit by bit: divide by x eight times a byte, modulo the reflected polynomial 0xEDB88320
    "op12_prefix_trie": r"""
WITH t AS (SELECT conv_id, k, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) - 1 AS i
           FROM (SELECT conv_id, turn, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k,
                        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT DISTINCT conv_id AS c, conv_id - conv_id % 20 AS base,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295) % 4 AS h FROM t),
r AS (SELECT c, i, k, w FROM c JOIN t ON conv_id = base WHERE i < h UNION ALL SELECT c, i, k, w FROM c JOIN t ON conv_id = c WHERE i >= h),
p AS (SELECT c, w, row_number() OVER (PARTITION BY c ORDER BY i) AS d, string_agg(k, '') OVER (PARTITION BY c ORDER BY i) AS path FROM r
      UNION ALL SELECT c, 0, 0, '' FROM c),
s AS (SELECT c, max(d) AS size FROM p GROUP BY c),
n AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(w) AS own,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = size), '') AS ends FROM p JOIN s USING (c) GROUP BY path, d),
k AS (SELECT left(path, 32 * (d::INT - 1)) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
g AS (SELECT left(path, 32 * lvl::INT) AS path, sum(own) AS saved, count_if(leaf) AS leaves
      FROM (SELECT n.path, own, k.path IS NULL AS leaf, unnest(range(0, d + 1)) AS lvl FROM n LEFT JOIN k ON k.path = n.path) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, g.leaves::BIGINT AS n_leaves,
       g.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN g ON g.path = n.path LEFT JOIN k ON k.path = n.path LEFT JOIN n AS up ON n.d > 0 AND up.path = left(n.path, 32 * (n.d::INT - 1))""",
    "op13_line_dedup": """
WITH l AS (SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
b AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT doc_id, i, line, keeper IS NULL OR keeper = doc_id AS stays FROM k LEFT JOIN b USING (key))
SELECT doc_id, count(*) AS n_lines, count_if(NOT stays)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256 FROM m GROUP BY doc_id""",
}
