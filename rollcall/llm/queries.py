"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    chat_format, decontaminate, exact_dedup, knn, mixing, near_dedup, periodic_runs, quality, secrets_scan,
    source_divergence, substring_dedup, toxicity, warc,
)
from rollcall.llm.common import stash, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # parameter of the chat formatter


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to sharded archives and read back."""
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       "refers_to")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector, exactly."""
    return knn.top_k(table(spark, sf_dir, "embeddings"), k=20, query_mod=20)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 or more words that documents share, and copies."""
    return substring_dedup.passages(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations (and conversation -7, which imitates control strings)
    packed as a prefix tree and read back from it."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"),
                                  F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    packed = stash(chat_format.pack(turns.unionByName(extra), VOCABULARY), "packs")
    return chat_format.read_back(packed, VOCABULARY)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark windows hit."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"),
                        "contaminated")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes from every document."""
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    return secrets_scan.scan(table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their terms."""
    return source_divergence.divergence(table(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose texts are equal but for blanks."""
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, one in ten of which is given
    a repeated tail."""
    found = periodic_runs.runs_of(table(spark, sf_dir, "documents"), change=periodic_runs.repeat_tail)
    return periodic_runs.report(found)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline's stages one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_warc, op2_topk, op3_quality, op4_substring_dedup, op5_chat_format, op6_decontaminate, op7_mixing,
           op8_toxicity, op9_secrets, op10_near_dedup, op11_source_divergence,
           op12_exact_dedup, op13_periodic_runs, pipeline)
    return {f.__name__: f for f in own}


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS6 = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS10 = rf"regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+')"

ORACLES = {
    "op1_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
           FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS f FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> f THEN f END AS refers_to
FROM m""",
    "op2_topk": """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op5_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|><|text|><|end|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
           + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id""",
    "op6_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS6} AS w FROM documents),
i AS (SELECT item_id, {_WORDS6} AS w FROM benchmark),
g AS (SELECT item_id, least(10, len(w)) AS m, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
      FROM i WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS gram FROM g),
lens AS (SELECT DISTINCT m FROM b),
dp AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
dg AS (SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS gram FROM dp, lens WHERE p + m - 1 <= len(w)),
h AS (SELECT dg.doc_id, dg.p, dg.m, b.item_id FROM dg JOIN b USING (m, gram)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + m)) AS x FROM h)
      GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op10_near_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS10} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p + 4], ' ') END AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id
      GROUP BY ALL),
e AS (SELECT a, b FROM k JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(seen) AS c FROM r GROUP BY node) m ON m.node = d.doc_id""",
    "op11_source_divergence": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS cl FROM t GROUP BY ALL HAVING count(DISTINCT rid) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
a AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, k.cl FROM g JOIN k USING (lang)
      LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, (1 + (1000000000::HUGEINT * (c + 5)) // (sum(c) OVER s + 5 * count(*) OVER s))::BIGINT AS p,
             (1 + (1000000000::HUGEINT * (cl + 5)) // (sum(cl) OVER s + 5 * count(*) OVER s))::BIGINT AS q
      FROM a WINDOW s AS (PARTITION BY lang, source)),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
          LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 50""",
    "op12_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS c,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY c DESC, doc_id NULLS LAST)""",
    "op13_periodic_runs": r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT *, len(w) AS n, xor(4294967295, list_reduce(flatten(list_prepend([4294967295::BIGINT],
        [[ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(doc_id::VARCHAR, '')])),
        lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END)) AS h
      FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
x AS (SELECT rid, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS w
      FROM (SELECT *, unnest(range(n)) AS i FROM (SELECT rid, n, w, coalesce(a, n) AS a, coalesce(p, 1) AS p FROM p))),
e AS (SELECT x.rid, y.i - x.i AS q, x.i FROM x JOIN x y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i
      AND 3 * (y.i - x.i) <= x.n),
g AS (SELECT rid, q, min(i) AS s, count(*) AS m
      FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM e) GROUP BY rid, q, g
      HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT rid, s, m + q AS len, min(q) AS q FROM (SELECT rid, s, q, m FROM g) GROUP BY rid, s, m + q),
b AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY len::DOUBLE / q DESC, s, q) = 1),
l AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines
      FROM r GROUP BY rid),
k AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS kept FROM x
      WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = x.rid AND x.i >= r.s + r.q AND x.i < r.s + r.len) GROUP BY rid)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       1000 * b.len // b.q AS exponent_milli, sha256(coalesce(l.lines, '')) AS runs_sha256,
       sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM d LEFT JOIN l USING (rid) LEFT JOIN b USING (rid) LEFT JOIN k USING (rid)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
