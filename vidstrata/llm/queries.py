"""The operators over the test tables, with production parameters: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidstrata.llm import (
    fingerprints,
    html_text,
    language,
    lattice,
    mixing,
    packing,
    ranked_search,
    repeats,
    similar,
    token_counts,
    toxicity,
    vector_search,
    whitening,
)
from vidstrata.llm.common import held_out, small_batches
from vidstrata.session import tune

QUERIES = {}


def query(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        small_batches(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    found = html_text.main_text(pages, html_text.fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_similar_documents(spark, sf_dir):
    return similar.similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_section_tokens(spark, sf_dir):
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


@query
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"))
    model = language.fit(docs.where(~out))
    found = language.detect(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "language.lang_pred", "language.score")


@query
def op5_nearest_vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select("vec_id", vector_search.whole_vector(F.col("embedding"), 64).alias("vector"))
    return vector_search.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"))
    model = toxicity.fit(docs.where(~out), table(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    predicted = F.when(F.col("toxicity.score") >= 0.5, 1).otherwise(0).cast("int")
    return found.select("doc_id", out.alias("held_out"), "toxicity.score", predicted.alias("predicted"), "toxicity.passages")


@query
def op7_repeated_passages(spark, sf_dir):
    return repeats.cut(table(spark, sf_dir, "documents"))


@query
def op8_fingerprints(spark, sf_dir):
    return fingerprints.with_neighbours(fingerprints.with_next(table(spark, sf_dir, "documents")))


@query
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "rate", "copies", "taken")


@query
def op11_near_vectors(spark, sf_dir):
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


@query
def op12_ranked_search(spark, sf_dir):
    return ranked_search.top_k(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query
def op13_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    whole = rows.select("vec_id", whitening.on_grid(F.col("embedding"), 1024, 100_000).alias("vector"))
    return whitening.whiten(whole, components=8)


SQL = {
    "op2_similar_documents": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i : i + 4], ' ') ELSE array_to_string(w, ' ') END AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS node, a AS seen FROM edges
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(r.least_id, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id)
LEFT JOIN (SELECT node, min(seen) AS least_id FROM reach GROUP BY node) r ON r.node = d.doc_id
""",
    "op5_nearest_vectors": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op11_near_vectors": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT r, vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM v),
links AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b
    ON a.r <> b.r AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.95),
reach AS (SELECT a AS node, a AS seen FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
components AS (SELECT node, min(u.vec_id) AS least FROM reach JOIN u ON u.r = reach.seen GROUP BY node),
degrees AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT u.vec_id, coalesce(degrees.n, 0) AS n_links, coalesce(least, u.vec_id) AS component_id, coalesce(least, u.vec_id) = u.vec_id AS kept
FROM u LEFT JOIN components ON components.node = u.r LEFT JOIN degrees ON degrees.node = u.r
UNION ALL
SELECT vec_id, 0, vec_id, true FROM embeddings
WHERE NOT coalesce(embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)
""",
    "op12_ranked_search": r"""
WITH terms AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT doc_id, r, len(w) AS n FROM terms WHERE len(w) > 0),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
asked AS (
  SELECT DISTINCT item_id, t FROM benchmark, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS u(t)),
counts AS (SELECT r, t, count(*) AS tf FROM terms, unnest(w) AS u(t) GROUP BY r, t),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM counts, corpus GROUP BY t, docs),
scores AS (
  SELECT a.item_id, s.doc_id, s.r,
    sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))))::BIGINT AS score
  FROM asked a JOIN weights USING (t) JOIN counts c USING (t) JOIN sizes s ON s.r = c.r, corpus
  GROUP BY a.item_id, s.doc_id, s.r),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
""",
}
