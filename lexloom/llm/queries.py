"""The queries of this subpackage's operators over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, cover_tree, decontaminate, html_text, jaccard_join, language_id, quality, sharding, toxicity, url_filter

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Fixed values of the URL query: rules as (verdict, host/path), and the blocked hosts.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
BLOCKED = ["adult-x.example.net", "ads-track.example.com", "casino-win.example.com", "cheap-pills.example.com", "free-bets.example.com", "spam-farm.example.com"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    return bpe.digests(bpe.encode(_read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, check=True))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(_read(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"), spark.createDataFrame([(h,) for h in BLOCKED], "key string"), RULES)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_read(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(_read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_read(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_embedding_near_dedup, op2_quality, op3_byte_bpe, op4_sharding, op5_url_filter, op6_language_id, op7_toxicity, op8_ngram_jaccard, op9_decontamination, op10_html_extraction, pipeline)}

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM embeddings),
links AS (SELECT a.vec_id s, b.vec_id t FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT vec_id n, vec_id c FROM v UNION SELECT l.t, r.c FROM reach r JOIN links l ON l.s = r.n),
comp AS (SELECT n, min(c) c FROM reach GROUP BY n),
cnt AS (SELECT s, count(*) k FROM links GROUP BY s)
SELECT v.vec_id, CAST(coalesce(k, 0) AS BIGINT) n_links, c component_id, v.vec_id = c kept
FROM v JOIN comp ON comp.n = v.vec_id LEFT JOIN cnt ON cnt.s = v.vec_id
"""

_HOSTS = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED)
_FITS = "\n".join(f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'" for _, r in sorted(RULES, key=lambda r: -len(r[1])))
_OP5 = f"""
WITH u AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UP}', '{_LOW}'), '') host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') path FROM pages),
r AS (SELECT *, CASE {_FITS} END AS rule FROM u)
SELECT page_id, host, path, rule, CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for v, r in RULES)} WHEN {_HOSTS} THEN 'block' ELSE 'allow' END verdict FROM r
"""

_OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x20\\x09-\\x0D]+') w FROM documents),
sh AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct([array_to_string(w[i : i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)]) END s FROM w),
flat AS (SELECT doc_id, unnest(s) x FROM sh),
pairs AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sh x ON x.doc_id = a JOIN sh y ON y.doc_id = b WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)),
sides AS (SELECT a s, b t FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id n, doc_id c FROM sh UNION SELECT t, r.c FROM reach r JOIN sides ON s = r.n)
SELECT doc_id, CAST(len(s) AS BIGINT) n_shingles, (SELECT min(c) FROM reach WHERE n = doc_id) component_id FROM sh
"""

_OP9 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) n, array_to_string(w[p : p + 9], ' ') x FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) p FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') x FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON iw.x = dw.x AND iw.n = dw.n),
words AS (SELECT doc_id, count(DISTINCT q) h FROM (SELECT doc_id, unnest(range(p, p + n)) q FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) k, array_to_string(list_sort(list(DISTINCT item_id)), ',') ids FROM hits GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(h, 0) AS BIGINT) n_hit, CAST(coalesce(k, 0) AS BIGINT) n_items, sha256(coalesce(ids, '')) items_sha256, coalesce(h, 0) > 0 contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_embedding_near_dedup": _OP1, "op5_url_filter": _OP5, "op8_ngram_jaccard": _OP8, "op9_decontamination": _OP9}
