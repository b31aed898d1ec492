"""The registered queries of the operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provgraph.llm.common import crc_mod
from provgraph.llm.embedding_dedup import near_duplicate_vectors
from provgraph.llm.exact_dedup import exact_duplicates
from provgraph.llm.fill_in_middle import fill_in_middle
from provgraph.llm.html_extraction import extract_text
from provgraph.llm.minhash import near_duplicates
from provgraph.llm.mixing import mix
from provgraph.llm.packing import pack
from provgraph.llm.secret_scan import BASE_RULES, find_secrets
from provgraph.llm.suffix_tree_lm import lm_scores
from provgraph.llm.token_alignment import align_tokens
from provgraph.llm.toxicity import fit, toxicity_scores
from provgraph.llm.url_filter import Rule, filter_urls
from provgraph.llm.warc import read_warc, write_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in BASE_RULES]
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = [F.size(F.filter(F.transform("spans", lambda s: s["kind"]), lambda kind: kind == F.lit(k))).cast("long").alias(f"n_{k}") for k in kinds]  # noqa: B023
    return found.select("doc_id", *count, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=5, percent=85)


URL_RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), total=1.5, cap=2.0)
    return marks.select("doc_id", "size", "source_size", "target", "taken", F.col("copies"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = read_warc(write_warc(_table(spark, sf_dir, "pages")))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(_table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50, with_output=False)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_secret_scan, op2_minhash, op3_url_filter, op4_suffix_tree, op5_toxicity, op6_exact_dedup, op7_embedding_dedup,
        op8_mixing, op9_packing, op10_warc, op11_html_extraction, op12_token_alignment, op13_fill_in_middle,
    )
    return {f.__name__: f for f in ops}


_OP3_SQL = """
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^(?:.|\\n)*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?:.|\\n)*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM p)
-- The given pages hold no canonical link and no redirect, so that no block travels.
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

_OP6_SQL = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

_OP8_SQL = """
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM s),
-- The sources held at the cap are those with the least size per weight.
o AS (
  SELECT source_size, weight, row_number() OVER u AS k,
         sum(source_size) OVER u AS held, sum(weight) OVER u AS gone, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight
  FROM w WINDOW u AS (ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (
  SELECT k, source_size, weight, (1.5 * all_size - 2.0 * (held - source_size))::DOUBLE / (all_weight - gone + weight) AS level FROM o),
l AS (SELECT coalesce(arg_min(level, k) FILTER (weight * level <= 2.0 * source_size), arg_max(level, k)) AS level FROM c),
t AS (
  SELECT source, source_size, least(2.0 * source_size, weight * level)::DOUBLE AS target,
         CASE WHEN source_size > 0 THEN least(2.0 * source_size, weight * level)::DOUBLE / source_size ELSE 0.0 END AS rate
  FROM w, l),
e AS (
  SELECT doc_id, d.source, size, source_size, target, rate, seed,
         floor(rate) + (('0x' || substr(md5(doc_id || ':' || seed // 4), (seed % 4) * 8 + 1, 8))::BIGINT / 4294967296.0 < rate - floor(rate))::INT AS copies
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range(32) AS x(seed)),
b AS (
  SELECT source, seed FROM (
    SELECT source, seed, row_number() OVER (PARTITION BY source ORDER BY abs(sum(copies * size) - any_value(target)), seed) AS r FROM e GROUP BY source, seed)
  WHERE r = 1)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies
FROM e JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.seed = b.seed
"""


_OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS h FROM p),
-- Base 32 of the 40 hex digits: each 5 of them are 4 letters.
e AS (
  SELECT page_id, payload_bytes, h, list_aggregate(list_transform(range(8), lambda i:
    list_aggregate(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * i + 1, 5))::BIGINT >> s) & 31) + 1, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM d),
k AS (SELECT h, max(page_id) AS keeper FROM d GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM e JOIN k USING (h)
"""


_OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
c AS (
  SELECT *, len(units)::BIGINT AS n, list_transform(range(4), lambda i: ('0x' || substr(h, 8 * i + 1, 8))::BIGINT) AS r,
         t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain
  FROM d),
k AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS c1, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS c2 FROM c),
p AS (
  SELECT doc_id, n, t, CASE WHEN plain OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:c1], '') AS prefix, array_to_string(units[c1 + 1:c2], '') AS middle, array_to_string(units[c2 + 1:n], '') AS suffix
  FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": _OP3_SQL, "op6_exact_dedup": _OP6_SQL, "op8_mixing": _OP8_SQL, "op10_warc": _OP10_SQL,
        "op13_fill_in_middle": _OP13_SQL,
    }
