"""One driver query per operator over its whole table, with the operator's production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotbook.llm import (
    collocations,
    main_text,
    mixing,
    near_duplicates,
    packing,
    piece_model,
    prefix_forest,
    quality_model,
    quality_rules,
    ranked_search,
    surrogates,
    url_filter,
    warc,
)

SURROGATE_KEY = "demonstration key"  # a real run names its own secret
SOURCE_WEIGHTS = (3, 1, 2)
#: (verdict, host, path) of the URL rules, and the words in a host that put its pages' URLs on the list.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
             ("allow", "org", "/fr/"))
PIECE_MODEL = "piece_bpe_32k.model"
LISTED_HOSTS = "casino|spam|adult"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table. Python workers of a local session get this package by its path."""
    if spark.sparkContext.master.startswith("local["):
        paths = [str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(filter(None, paths)))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, share=1.5, cap=2.0)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE
spoken AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM spoken WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM spoken WHERE len(w) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles AS a JOIN shingles AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id, doc_id AS node FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.node)
SELECT doc_id, coalesce(max(sizes.n), 0) AS n_shingles, min(node) AS component_id, doc_id = min(node) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.apply_rules(docs, labels.filter("quality = 1"), keep=["doc_id"])


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as response records, and for each its metadata and its conversion record."""
    found = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")), keep=["page_id"])
    headers = F.col("headers")
    return found.select(
        "page_id", F.col("type").alias("warc_type"), "record_id", headers["WARC-Refers-To"].alias("refers_to"),
        "target_uri", "date", "content_type", headers["WARC-Source-Payload-Digest"].alias("source_payload_digest"),
        headers["WARC-Source-Block-Digest"].alias("source_block_digest"),
        headers["WARC-Block-Digest"].alias("block_digest"), F.length("block").cast("long").alias("n_bytes"),
        F.col("block").cast("string").alias("block"))


def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return surrogates.replace_personal_data(docs, SURROGATE_KEY, keep=["doc_id", "text"])


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels, metadata=("n_chars",))
    scored = quality_model.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the URLs of pages whose host holds one of the listed words."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(url_filter.host(F.col("url")).rlike(LISTED_HOSTS)).select("url")
    return url_filter.judge(pages, URL_RULES, listed, keep=["page_id"])


OP9_SQL = f"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
canon AS (
  SELECT *, CASE WHEN host <> '' THEN
    regexp_replace(host, '^(?:www|m)[.]', '') || regexp_replace(path, '/+$', '') END AS url FROM parts),
listed AS (SELECT DISTINCT url FROM canon WHERE regexp_matches(host, '{LISTED_HOSTS}')),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM canon)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN listed.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN listed USING (url)
"""


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    found = piece_model.encode(docs, public_tokenizers.path(PIECE_MODEL), keep=["doc_id"])
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
spoken AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM spoken GROUP BY doc_id),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS l FROM sizes),
norms AS (SELECT doc_id, 50 + (50 * n * big_n) // l AS m FROM sizes, total),
found AS (
  SELECT doc_id, t, count(*) AS tf FROM spoken WHERE t IN (SELECT t FROM asked) GROUP BY doc_id, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM found GROUP BY t), total),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN found USING (t) JOIN weights USING (t) JOIN norms USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH
pieces AS (
  SELECT lang, doc_id, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) AS r(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY lang, k, g HAVING count(*) >= 100),
candidates AS (SELECT lang, k, g, f AS a FROM f WHERE k >= 2),
inside AS (
  SELECT lang, list_slice(g, i, i + size - 1) AS g, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i FROM candidates, range(2, 5) AS s(size) WHERE size < k)
  GROUP BY lang, list_slice(g, i, i + size - 1)),
cuts AS (
  SELECT c.lang, c.g, c.a, x.f AS l, y.f AS r, n, cut, ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) AS c
  JOIN f AS x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, cut)
  JOIN f AS y ON y.lang = c.lang AND y.g = list_slice(c.g, cut + 1, c.k)
  JOIN totals ON totals.lang = c.lang
  LEFT JOIN inside ON inside.lang = c.lang AND inside.g = c.g
  WHERE longer IS NULL OR 100 * longer < 100 * c.a),
least AS (
  SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS place FROM cuts),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank,
    array_to_string(g, ' ') AS phrase, a, l, r, n, score
  FROM least WHERE place = 1)
SELECT * FROM ranked WHERE rank <= 2000
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mixing, op2_near_duplicates, op3_quality_rules, op4_warc_derivatives, op5_prefix_forest, op6_surrogates,
        op7_main_text, op8_quality_model, op9_url_filter, op10_packing,
        op11_piece_encoding, op12_ranked_search, op13_collocations)}


def llm_statements() -> dict[str, str]:
    return {"op2_near_duplicates": OP2_SQL, "op9_url_filter": OP9_SQL, "op12_ranked_search": OP12_SQL,
            "op13_collocations": OP13_SQL}
