"""The registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutelage.llm import centroids, cosine, decontamination, html, packing, privacy, quality, sampling, secrets, simhash, spelling, toxicity, warc
from tutelage.llm.frames import table
from tutelage.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, d: str) -> DataFrame:
    pieces = packing.tokenise(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json"), max_len=4096, end_id=1, ids=False, crc=True)
    return packing.pack(pieces, max_len=4096)


@query("op2_simhash_near_dedup")
def op2(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"), width=4, max_bits=4)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op7_benchmark_decontamination", rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
pos AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, item_id, i, n FROM pos JOIN win USING (n, s)),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op7(spark: SparkSession, d: str) -> DataFrame:
    found = decontamination.contamination(table(spark, d, "documents"), table(spark, d, "benchmark"), window=10, keep=["doc_id"])
    c = F.col("contamination")
    return found.select("doc_id", c["n_words"].alias("n_words"), c["n_hit"].alias("n_hit"), F.size(c["items"]).cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort(c["items"])), 256).alias("items_sha256"), (c["n_hit"] > 0).alias("contaminated"))


@query("op9_secret_scan_ledger")
def op9(spark: SparkSession, d: str) -> DataFrame:
    docs, ledger = table(spark, d, "documents").select("doc_id", "text"), fresh_path(spark, "ledger")
    secrets.scan(docs, ledger)
    found = secrets.findings(docs, ledger, ("doc_id",))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op8_toxicity")
def op8(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, d, "labels"), "toxic"))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_quality_classifier")
def op4(spark: SparkSession, d: str) -> DataFrame:
    scored = quality.classify(table(spark, d, "documents"), table(spark, d, "labels"), "quality")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op3_weighted_fingerprints")
def op3(spark: SparkSession, d: str) -> DataFrame:
    return sampling.edits(table(spark, d, "documents"))


@query("op5_warc_bundles", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT page_id, html, h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS INT), 5) AS BIGINT) >> (5 * (3 - k % 4))) & 31 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f""")
def op5(spark: SparkSession, d: str) -> DataFrame:
    index = warc.write(table(spark, d, "pages"), fresh_path(spark, "warc"))
    return warc.read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_html_extraction")
def op10(spark: SparkSession, d: str) -> DataFrame:
    return html.extract(table(spark, d, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op6_pii_surrogates")
def op6(spark: SparkSession, d: str) -> DataFrame:
    found = privacy.replace(table(spark, d, "documents").select("doc_id", "text"), privacy.SECRET)
    spans = F.transform("entities", lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"), e["surrogate"]))
    return found.select("doc_id", "text", F.size("entities").cast("bigint").alias("n_entities"), F.array_join(spans, ",").alias("entities"))


@query("op11_cosine_near_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NOT NULL AND isfinite(c))) = len(x) AND len(list_filter(x, lambda c: c <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM comp LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a) USING (vec_id)""")
def op11(spark: SparkSession, d: str) -> DataFrame:
    return cosine.near(table(spark, d, "embeddings"), least=0.9)


def _sql_lloyd(rounds: int = 3, k: int = 16) -> str:
    """Lloyd's algorithm by full search, a round written out after the other."""
    parts = ["""v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(64 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)""",
             f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < {k})"]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (SELECT vec_id, any_value(v.x) AS x, min([list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c]) AS m
  FROM v, c{i} c GROUP BY vec_id)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT m[2] AS c, j, sum(x[j]) AS s, count(*) AS n FROM a{i}, (SELECT unnest(range(1, 65)) AS j) GROUP BY m[2], j)""")
            parts.append(f"""c{i + 1} AS (SELECT c{i}.c, coalesce(f.x, c{i}.x) AS x FROM c{i}
  LEFT JOIN (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x FROM s{i} GROUP BY c) f ON f.c = c{i}.c)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(m[2] AS INT) AS cluster, CAST(m[1] AS BIGINT) AS distance, CAST(sum(m[1]) OVER (PARTITION BY m[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(m[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} c ON c.c = m[2]"""


@query("op12_ns_bounds_clustering", _sql_lloyd())
def op12(spark: SparkSession, d: str) -> DataFrame:
    return centroids.cluster(table(spark, d, "embeddings"), k=16, rounds=3)


_CRC = "list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"


@query("op13_spelling_variants", rf"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: {_CRC}) AS crc),
runs AS (SELECT doc_id, w, count(*) AS m FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents)
  WHERE length(w) >= 6 GROUP BY doc_id, w),
bytes AS (SELECT w, m, hex(encode(doc_id || ':' || w)) AS x FROM runs),
hashed AS (SELECT w, m, xor(list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
  lambda c, b: xor(c >> 8, crc[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295) AS h FROM bytes, t),
v AS (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM (SELECT m, CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % length(w) AS INT)) || substr(w, CAST(h % length(w) AS INT) + 2) ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
one AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word < b.word UNION SELECT rest, cut.word FROM cut JOIN v ON v.word = rest),
pair AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
linked AS (SELECT a AS word, any_value(x.n) AS n, count(*) AS n_near, arg_min(y.word, (-y.n, y.word)) AS form, max(y.n) AS form_n FROM pair JOIN v x ON x.word = a JOIN v y ON y.word = b GROUP BY a),
step AS (SELECT word, n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM linked),
way(word, here) AS (SELECT word, form FROM step WHERE form IS NOT NULL UNION ALL SELECT way.word, step.form FROM way JOIN step ON step.word = way.here WHERE step.form IS NOT NULL),
ends AS (SELECT way.word, here AS root FROM way LEFT JOIN step ON step.word = way.here WHERE step.form IS NULL)
SELECT v.word, form, coalesce(root, v.word) AS root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n FROM v LEFT JOIN step USING (word) LEFT JOIN ends USING (word)""")
def op13(spark: SparkSession, d: str) -> DataFrame:
    return spelling.group(table(spark, d, "documents"))
