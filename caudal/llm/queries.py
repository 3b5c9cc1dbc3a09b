"""Queries over the documents, pages and vectors, and the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import audit, blocks, containment, language, lines, listjoin, mixture, packing, runs, simhash, tokens, topk, windows
from caudal.llm.common import hex64, ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(function):
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@_query("op1_crf_language")
def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1: language of every document by a chain learned from those that are not held out."""
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    docs = table(spark, sf_dir, "documents")
    known = docs.where(F.col("lang").isNotNull() & ~F.coalesce(held_out, F.lit(False)))
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return language.identify(rows, language.fit(known)).select("doc_id", "held_out", "lang_pred", "score")


@_query("op2_text_blocks")
def op2_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2: main text of every page."""
    return blocks.extract(table(spark, sf_dir, "pages"))


@_query("op3_power_packing")
def op3_power_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3: documents packed into power-of-two pieces."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), 1024, kept=1_000_000)


def _op4_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Captures, and the entries at their instant.

    The tables hold no list: each event about a page (``user_id`` names it) is a dated entry for the page's site,
    and a page was fetched at a minute of the same month that follows from its number.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    kind, host = F.col("event_type"), listjoin.host(F.col("url"))
    key = (
        F.when(kind.isin("click", "view", "signup") & (listjoin.folder(F.col("url")) != ""), F.concat_ws("/", host, listjoin.folder(F.col("url"))))
        .when(kind == "purchase", host)
        .otherwise(F.regexp_replace(host, r"^(www|m|blog)\.", ""))
    )
    action = F.when(kind == "signup", "withdraw").when(kind == "purchase", "allow").otherwise("block")
    entries = events.join(pages, F.col("user_id") == F.col("page_id")).select(
        key.alias("key"), action.alias("action"), F.col("ts").cast("timestamp").alias("day"), F.struct("ts", "event_id").alias("nth")
    )
    minute = F.make_dt_interval(mins=(F.col("page_id") * 37 % 43200).cast("int"))
    return pages.withColumn("fetched_at", F.lit("2024-01-01 00:00:00").cast("timestamp") + minute), entries


_OP4_FETCH_SQL = r"""
WITH entry AS (
  SELECT e.event_id, e.ts, e.event_type,
    CASE e.event_type WHEN 'signup' THEN 'withdraw' WHEN 'purchase' THEN 'allow' ELSE 'block' END AS action,
    lower(regexp_extract(p.url, '://([^/:?#]+)', 1)) AS host, regexp_extract(p.url, '://[^/?#]*/([^/?#]+)', 1) AS folder
  FROM events e JOIN pages p ON p.page_id = e.user_id
), keyed AS (
  SELECT event_id, ts, action, CASE
    WHEN event_type IN ('click', 'view', 'signup') AND folder <> '' THEN host || '/' || folder
    WHEN event_type = 'purchase' THEN host
    ELSE regexp_replace(host, '^(www|m|blog)\.', '') END AS key
  FROM entry
), capture AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * CAST(page_id * 37 % 43200 AS INTEGER) AS fetched_at,
    lower(regexp_extract(url, '://([^/:?#]+)', 1)) AS host, regexp_extract(url, '://[^/?#]*/([^/?#]+)', 1) AS folder
  FROM pages
), part AS (SELECT DISTINCT host, folder, fetched_at, string_split(host, '.') AS labels FROM capture),
asked AS (
  SELECT host, folder, fetched_at, unnest([array_to_string(labels[i:], '.') FOR i IN range(1, len(labels) + 1)]) AS key FROM part
  UNION ALL SELECT host, folder, fetched_at, host || '/' || folder FROM part WHERE folder <> ''
), dated AS (
  SELECT a.host, a.folder, a.fetched_at, a.key, arg_max(k.action, (k.ts, k.event_id)) AS action, max(k.ts) AS since
  FROM asked a JOIN keyed k ON k.key = a.key AND k.ts <= a.fetched_at GROUP BY a.host, a.folder, a.fetched_at, a.key
), verdict AS (
  SELECT host, folder, fetched_at, arg_max(action, (length(key), key)) AS action, arg_max(key, (length(key), key)) AS list_key,
    arg_max(since, (length(key), key)) AS list_since
  FROM dated WHERE action <> 'withdraw' GROUP BY host, folder, fetched_at
)
SELECT c.page_id, c.url, c.fetched_at, coalesce(v.action = 'block', false) AS blocked, v.list_key, v.list_since
FROM capture c LEFT JOIN verdict v ON v.host = c.host AND v.folder = c.folder AND v.fetched_at = c.fetched_at
"""


@_query("op4_lists_at_fetch", _OP4_FETCH_SQL)
def op4_lists_at_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: every page's capture against the list entries active at the minute it was fetched."""
    judged = listjoin.judge(*_op4_tables(spark, sf_dir))
    return judged.select("page_id", "url", "fetched_at", "blocked", "list_key", "list_since")


@_query("op5_token_counts")
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5: token counts of whole texts."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer(), 512, kept=1_000_000)


@_query("op6_radix_windows")
def op6_radix_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6: bytes covered by 100-byte strings that start earlier too."""
    return windows.digest_columns(windows.cut_repeats(table(spark, sf_dir, "documents"), 100))


@_query("op7_covering_simhash")
def op7_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7: components of fingerprints at most 3 bits apart."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), 3, 3)
    return found.select("doc_id", hex64(found["fingerprint"]).alias("fingerprint"), "component_id")


_OP8_SQL = r"""
WITH vec AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vec q JOIN vec c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@_query("op8_threshold_topk", _OP8_SQL)
def op8_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8: the ten highest inner products of every hundredth vector."""
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), 10)


_OP9_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS nth, doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT nth, doc_id, md5(text) AS text, i, lines[i] AS line,
    translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM split)
), bad AS (
  -- Rows of one id and text are one document.
  SELECT key FROM line WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row(doc_id, text)) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (bad.key IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (bad.key IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN bad USING (key) GROUP BY nth
"""


@_query("op9_bloom_lines", _OP9_SQL)
def op9_bloom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: lines that ten or more documents share lose all their copies."""
    return lines.digest_columns(lines.dedup_lines(table(spark, sf_dir, "documents"), 10, 1))


_WORDS_SQL = r"""[x FOR x IN string_split_regex(regexp_replace(lower(coalesce(text, '')), '[!-/:-@\[-`{-~]', ' ', 'g'), '[ \t\n\x0b\x0c\r]+') IF x <> '']"""
_OP10_SQL = rf"""
WITH doc AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
held AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS shingle FROM doc
), item AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
sought AS (
  SELECT DISTINCT item_id, unnest([array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]) AS shingle FROM item
), total AS (SELECT item_id, count(*) AS n FROM sought GROUP BY item_id)
SELECT doc_id, item_id, any_value(n) AS n_shingles, count(*) AS n_shared, count(*) / any_value(n)::DOUBLE AS containment
FROM held JOIN sought USING (shingle) JOIN total USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
"""


@_query("op10_minhash_containment", _OP10_SQL)
def op10_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10: benchmark items of which a document holds four fifths of the five-word shingles."""
    return containment.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11: stretches of words that repeat with a period, three times or more."""
    return runs.digest_columns(runs.find_runs(runs.with_planted_runs(table(spark, sf_dir, "documents")), 24, 3))


_OP12_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), said AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END) | (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
    | (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END)
    | (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    | (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS failed
  FROM doc LEFT JOIN said USING (doc_id)
), tally AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM judged GROUP BY part, failed
), letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
ordered AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)
), step AS (
  SELECT filter_order, s.step, l.x, l.bit, (
    SELECT coalesce(sum(p.bit), 0) FROM letter p WHERE position(p.x IN filter_order) < s.step
  )::INTEGER AS before
  FROM ordered, (SELECT unnest(range(1, 6)) AS step) s JOIN letter l ON substr(filter_order, s.step, 1) = l.x
), counted AS (
  SELECT part, filter_order, step, x,
    sum(n) FILTER (failed & (before | bit) = 0) AS kept, sum(n) FILTER (failed & before = 0 AND failed & bit <> 0) AS removed,
    sum(n) FILTER (failed & before <> 0 AND failed & bit <> 0) AS redundant, sum(n) FILTER (failed = bit) AS unique_fails,
    sum(good) FILTER (failed & before = 0 AND failed & bit <> 0) AS good_lost,
    sum(toxic) FILTER (failed & before = 0 AND failed & bit <> 0) AS toxic_lost
  FROM tally, step GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""


@_query("op12_filter_audit", _OP12_SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12: what five filters remove in each order and language, alone and together."""
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_OP13_SQL = r"""
WITH doc AS (
  SELECT source, doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 15) AS key
  FROM documents
), of AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM doc GROUP BY source
), level AS (
  SELECT *, row_number() OVER filled AS nth, CAST(sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER before, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM of WINDOW filled AS (ORDER BY source_size / weight, source),
    before AS (ORDER BY source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (SELECT min_by(level, nth) AS level FROM level WHERE 3 * source_size >= level * weight),
aim AS (
  SELECT source, source_size, least(coalesce(c.level, 'inf'::DOUBLE) * weight, CAST(3 * source_size AS DOUBLE)) AS target FROM of, chosen c
), grouped AS (
  SELECT *, (row_number() OVER (PARTITION BY source, doc_id, size, key) - 1) // 1024 AS nth FROM doc
), placed AS (
  SELECT *, CASE WHEN nth = 0 THEN key ELSE substr(md5(key || '/' || nth), 1, 15) END AS place FROM grouped
), summed AS (
  SELECT p.doc_id, p.size, a.source_size, a.target, CAST(floor(a.target) AS BIGINT) AS budget, CAST(coalesce(sum(p.size) OVER (
    PARTITION BY p.source ORDER BY p.place, p.doc_id NULLS FIRST, p.size, p.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  ), 0) AS BIGINT) AS start
  FROM placed p JOIN aim a ON a.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
  budget // source_size * size + greatest(0, least(size, budget % source_size - start)) END AS taken
FROM summed
"""


@_query("op13_mix_sources", _OP13_SQL)
def op13_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13: sources mixed by weight, each cut or repeated to its exact budget."""
    return mixture.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
