"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.llm.bpe import decode, encode
from sparkfolio.llm.collocations import mine
from sparkfolio.llm.contamination import find_passages
from sparkfolio.llm.hamming_search import top_k
from sparkfolio.llm.jaccard_join import link_components
from sparkfolio.llm.langid import identify
from sparkfolio.llm.line_dedup import dedup_lines
from sparkfolio.llm.packing import pack, token_pieces
from sparkfolio.llm.quality import judge
from sparkfolio.llm.ranked_search import search
from sparkfolio.llm.sharding import external_shuffle
from sparkfolio.llm.toxicity import classify
from sparkfolio.llm.url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The url rules of the query (fixed values): verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


@query
def op5_external_shuffle(spark, sf_dir):
    placed = external_shuffle(table(spark, sf_dir, "documents"), n_shards=8)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return placed.select("record.doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_url_cascade(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES).select("record.page_id", "host", "path", "rule", "verdict")


ORACLE["op7_url_cascade"] = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
s AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM u),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                                    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT page_id, host, path, r.*, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) + length(rpath) DESC) AS k
  FROM s LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rhost || rpath AS rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""


@query
def op4_bpe_round_trip(spark, sf_dir):
    coded = decode(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return coded.select("record.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_cross_parsing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs).select("record.doc_id", "held_out", "lang_pred", "score", "density")


@query
def op3_counterfactual_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).select("record.doc_id", "held_out", "score", "predicted")


@query
def op1_isolation_forest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels")).select(
        "record.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


@query
def op9_linear_grouping_packing(spark, sf_dir):
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pack(pieces).select("row.record.doc_id", "row.piece", "row.start", "row.length", "row.ids_crc32", "sequence_id", "offset")


@query
def op8_multi_index_hashing(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), k=10)


ORACLE["op8_multi_index_hashing"] = """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
d AS (
  SELECT q.vec_id AS query_id, o.vec_id AS neighbor_id,
         CAST(list_sum(list_transform(list_zip(q.b, o.b), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END)) AS BIGINT) AS distance
  FROM c q JOIN c o ON q.vec_id % 100 = 0 AND q.vec_id <> o.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS k FROM d)
SELECT query_id, CAST(k AS INTEGER) AS rank, neighbor_id, distance FROM r WHERE k <= 10
"""


@query
def op6_line_chunks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("record.doc_id", "text", "n_lines", "n_removed")


@query
def op2_vertical_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return link_components(docs, count_links=True).select("record.doc_id", "n_shingles", "component_id", "class_id", "n_links")


ORACLE["op2_vertical_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
k AS (SELECT x FROM e GROUP BY x HAVING count(*) > 1),
m AS (SELECT e.* FROM e SEMI JOIN k USING (x)),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM m a JOIN m b USING (x) WHERE a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(doc_id, low) AS (SELECT doc_id, doc_id FROM s UNION SELECT p.b, r.low FROM r JOIN p ON r.doc_id = p.a),
c AS (SELECT doc_id, min(low) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id,
       CASE WHEN len(g) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY list_sort(g)) END AS class_id,
       coalesce(n_links, 0) AS n_links
FROM s JOIN c USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM p GROUP BY a) l USING (doc_id)
"""


@query
def op11_stripes(spark, sf_dir):
    return mine(table(spark, sf_dir, "documents").select("text", "lang"))


ORACLE["op11_stripes"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 6) r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM o GROUP BY ALL HAVING count(*) >= 100),
b AS (
  SELECT DISTINCT s.lang, s.phrase FROM f s JOIN f l ON s.lang = l.lang AND l.k > s.k AND l.f >= s.f AND contains(' ' || l.phrase || ' ', ' ' || s.phrase || ' ')),
c AS (
  SELECT f.*, cut, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS x, array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS y
  FROM f ANTI JOIN b USING (lang, phrase), range(1, 5) r(cut) WHERE cut < k),
s AS (
  SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, n, 1000 * c.f * n // (x.f * y.f) AS score, cut
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y JOIN t ON t.lang = c.lang),
m AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM m WHERE nth = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 2000
"""


@query
def op12_fm_index(spark, sf_dir):
    found = find_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.col("items").cast("array<string>"))
    return found.select("record.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
                        F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s[0].cast("string"), s[1].cast("string"))), " ").alias("spans"))


ORACLE["op12_fm_index"] = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' '))) AS x
  FROM b WHERE len(w) > 0),
d AS (
  SELECT row, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS x
  FROM w, (SELECT DISTINCT m FROM p) WHERE len(w) >= m),
h AS (SELECT row, i, d.m, item_id FROM d JOIN p ON d.m = p.m AND d.x = p.x),
q AS (SELECT DISTINCT row, unnest(range(i, i + m)) AS i FROM h),
n AS (SELECT row, count(*) AS n_hit FROM q GROUP BY row),
s AS (SELECT row, list(i ORDER BY i) AS i FROM q GROUP BY row),
e AS (
  SELECT row, list_transform(list_filter(list_transform(i, lambda x, k: CASE WHEN k = 1 OR i[k - 1] < x - 1 THEN x END), lambda x: x IS NOT NULL), lambda x: x - 1) AS a,
         list_filter(list_transform(i, lambda x, k: CASE WHEN k = len(i) OR i[k + 1] > x + 1 THEN x END), lambda x: x IS NOT NULL) AS z FROM s),
t AS (SELECT row, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated,
       coalesce(array_to_string(list_transform(a, lambda x, k: x || '-' || z[k]), ' '), '') AS spans
FROM w LEFT JOIN n USING (row) LEFT JOIN t USING (row) LEFT JOIN e USING (row)
"""


@query
def op13_best_position(spark, sf_dir):
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


ORACLE["op13_best_position"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w)) AS n_terms FROM d),
f AS (SELECT row, doc_id, len(w) AS n, unnest(w) AS t FROM d),
p AS (SELECT row, doc_id, n, t, count(*) AS tf FROM f WHERE t IN (SELECT t FROM b) GROUP BY ALL),
q AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS HUGEINT) AS w FROM p, c GROUP BY t),
s AS (
  SELECT item_id, row, doc_id, sum(q.w * ((CAST(1000000000 AS HUGEINT) * tf) // (1000 * tf + 8 * (10 + (CAST(90 AS HUGEINT) * n * n_docs) // CAST(n_terms AS HUGEINT))))) AS score
  FROM p JOIN b USING (t) JOIN q USING (t), c GROUP BY item_id, row, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 10
"""
