"""The named queries of the operators, and their SQL where SQL can state them."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import alignment, decontaminate, mixing, neardup, periodic, pii, quality, rules, scoring, suffixarray, suffixtrees, topk, warc
from pairloom.llm.common import table
from pairloom.session import scratch_path

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    page = F.regexp_extract(F.col("metadata.fields"), "page-id: (-?[0-9]+)", 1)
    first = F.regexp_extract(F.col("original.metadata.fields"), "page-id: (-?[0-9]+)", 1)
    length = F.regexp_extract(F.col("capture.http"), "Content-Length: ([0-9]+)", 1)
    return warc.transactions(warc.read_records(spark, path)).select(
        F.nullif(page, F.lit("")).cast("bigint").alias("page_id"),
        F.coalesce(F.col("original.capture.bytes").cast("bigint"), length.cast("bigint")).alias("payload_bytes"),
        F.substring_index("capture.digest", ":", -1).alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        F.nullif(first, F.lit("")).cast("bigint").alias("refers_to"),
    )


ORACLE["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS newest FROM p),
d AS (SELECT *, list_transform(range(8), lambda g: CAST('0x' || substr(h, CAST(1 + 5 * g AS BIGINT), 5) AS BIGINT)) AS v FROM m)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((x >> s) & 31) AS BIGINT), 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM d
"""


@query
def op4_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 100 = 0"))


@query
def op8_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixtrees.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixarray.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "failed_rules", "kept"
    )


def _rules_sql() -> str:
    """The rules as SQL: counts, buckets of ratios, quartiles by group, limits, verdicts."""
    ratios = {
        "mean_chars": "1000 * word_chars // greatest(n_words, 1)", "symbols": "1000 * n_symbols // greatest(n_words, 1)",
        "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)", "repeats": "1000 * n_repeat_words // greatest(n_words, 1)",
        "marks": "1000 * n_marks // greatest(word_chars, 1)", "capitals": "1000 * n_capitals // greatest(word_chars, 1)",
    }
    sub = rules.SUB
    shift = f"greatest(length(bin(v)) - {sub + 1}, 0)"
    slack = " ".join(f"WHEN '{m}' THEN {v}" for m, v in rules.SLACK.items())

    def quartiles(name, by):
        group = ", ".join([*by, "m"])
        ranks = ", ".join(f"min(CASE WHEN upto >= greatest((total * {q} + 999) // 1000, 1) THEN b END) AS {c}" for c, q in (("b1", 250), ("b3", 750)))
        value = lambda b: f"(({b} - greatest({b} // {1 << sub} - 1, 0) * {1 << sub}) << greatest({b} // {1 << sub} - 1, 0)) + ((1::BIGINT << greatest({b} // {1 << sub} - 1, 0)) >> 1)"
        return f"""{name} AS (SELECT {group}, total, {value("b1")} AS q1, {value("b3")} AS q3 FROM (
          SELECT {group}, max(total) AS total, {ranks} FROM (
            SELECT *, sum(n) OVER (PARTITION BY {group}) AS total, sum(n) OVER (PARTITION BY {group} ORDER BY b) AS upto
            FROM (SELECT {group}, b, sum(n)::BIGINT AS n FROM sketch GROUP BY {group}, b)) GROUP BY {group}))"""

    named = ", ".join(f"{c} AS {m}" for m, c in ratios.items())
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, {", ".join(f"lead(word, {k}) OVER o AS w{k}" for k in range(rules.WINDOW))} FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w0, w1, w2, w3, w4) AS n FROM g WHERE w4 IS NOT NULL) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM r, range({rules.WINDOW}) AS x(k) GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
counts AS MATERIALIZED (SELECT d.rid, doc_id, lang, source, t, len(ws)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
  length(regexp_replace(t, '[^!-/:-@\\[-`{{-~]', '', 'g'))::BIGINT AS n_marks,
  length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_capitals
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN c USING (rid)),
judged AS MATERIALIZED (SELECT *, n_words < {rules.FEWEST_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed, {named} FROM counts),
once AS (SELECT DISTINCT lang, source, t, {", ".join(ratios)} FROM judged WHERE NOT base_failed),
long AS ({" UNION ALL ".join(f"SELECT lang, source, '{m}' AS m, ({m})::BIGINT AS v FROM once" for m in ratios)}),
sketch AS MATERIALIZED (SELECT lang, source, m, {shift} * {1 << sub} + (v >> {shift}) AS b, count(*) AS n FROM long GROUP BY ALL),
{quartiles("own", ["lang", "source"])}, {quartiles("spoken", ["lang"])}, {quartiles("every", [])},
q AS (SELECT o.lang, o.source, o.m,
  CASE WHEN o.total >= {rules.FEWEST} THEN o.q1 WHEN s.total >= {rules.FEWEST} THEN s.q1 ELSE e.q1 END AS q1,
  CASE WHEN o.total >= {rules.FEWEST} THEN o.q3 WHEN s.total >= {rules.FEWEST} THEN s.q3 ELSE e.q3 END AS q3
  FROM own o JOIN spoken s ON o.lang IS NOT DISTINCT FROM s.lang AND o.m = s.m JOIN every e ON o.m = e.m),
edges AS (SELECT *, greatest({rules.SPREAD} * (q3 - q1), CASE m {slack} END) AS reach FROM q),
fails AS (SELECT rid, string_agg(m, ',' ORDER BY k) AS failed FROM (
  SELECT j.rid, e.m, e.k FROM (
    {" UNION ALL ".join(f"SELECT rid, lang, source, '{m}' AS m, {i} AS k, ({m})::BIGINT AS v FROM judged" for i, m in enumerate(ratios))}) j
  JOIN (SELECT *, CASE m {" ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(ratios))} END AS k FROM edges) e
  ON j.lang IS NOT DISTINCT FROM e.lang AND j.source IS NOT DISTINCT FROM e.source AND j.m = e.m
  WHERE j.v > e.q3 + e.reach OR (e.m IN ({", ".join(repr(m) for m in rules.LOWER)}) AND j.v < e.q1 - e.reach)) x(rid, m, k) GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  coalesce(failed, '') AS failed_rules, NOT base_failed AND failed IS NULL AS kept
FROM judged LEFT JOIN fails USING (rid)
"""


ORACLE["op11_rules"] = _rules_sql()


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a repetition planted in a tenth of the texts, as the crc of the id has it."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@query
def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse(table(spark, sf_dir, "documents"), planted).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "n_dropped", "runs_sha256", "collapsed_sha256"
    )


ORACLE["op7_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
