"""Registered queries of the numbered operators, each over its whole tables, with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, collocations, langid, mixing, near_vectors, ngram_join, pieces, pii, quality, shards, spotsigs, vectors, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MIX_WEIGHTS = (3, 1, 2)
MIX_RATE = 1.5
MIX_COPIES = 2
SHARDS = 16
LANGUAGE_CONFIDENCE = 0.5


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


@query("op1_pareto_mix")
def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_RATE, MIX_COPIES)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op1_pareto_mix"] = r"""
WITH d AS (SELECT doc_id, source, ifnull(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][no % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap,
             1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s),
f AS (
  SELECT *, cap <= (budget - ifnull(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                   / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) * weight AS held
  FROM w),
t AS (
  SELECT source, source_size, CASE WHEN held THEN cap ELSE least(cap, (budget - ifnull(sum(cap) FILTER (held) OVER (), 0))
                                   * weight / sum(weight) FILTER (NOT held) OVER ()) END AS target FROM f),
e AS (
  SELECT d.doc_id, d.size, t.*, CASE WHEN source_size > 0 THEN least(2.0::DOUBLE, target / source_size) ELSE 0 END AS wanted,
         floor(wanted)::BIGINT AS certain, greatest(1e-9::DOUBLE, least(1 - 1e-9::DOUBLE, wanted - certain)) AS p,
         (('0x' || left(md5(concat_ws(':', 'mix', ifnull(d.doc_id::VARCHAR, ''), d.size::VARCHAR)), 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496 AS u,
         CASE WHEN certain < 2 THEN d.size ELSE 0 END AS offered
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
r AS (
  SELECT *, row_number() OVER line AS place, sum(offered) OVER (line ROWS UNBOUNDED PRECEDING) AS upto,
         target - sum(certain * size) OVER (PARTITION BY source) AS room
  FROM e WINDOW line AS (PARTITION BY source ORDER BY (u / (1 - u)) / (p / (1 - p)), ifnull(doc_id::VARCHAR, ''), size)),
g AS (
  SELECT *, offered > 0 AND upto <= room AS chosen,
         room - ifnull(sum(size) FILTER (offered > 0 AND upto <= room) OVER (PARTITION BY source), 0) AS gap FROM r),
c AS (
  SELECT *, CASE WHEN NOT chosen AND offered > 0 AND abs(offered - gap) < abs(gap) THEN {'off': abs(offered - gap), 'place': place} END
         AS offer FROM g)
SELECT doc_id, size, source_size, target,
       ((certain + CASE WHEN chosen OR coalesce(offer = min(offer) OVER (PARTITION BY source), FALSE) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c
"""


@query("op2_ngram_join")
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.join_documents(table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return joined.select("doc_id", "n_shingles", "component_id")


ORACLES["op2_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(ifnull(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
d AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) BETWEEN 1 AND 2 THEN [array_to_string(ws, ' ')]
         ELSE [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] END)) AS grams FROM w),
c AS (SELECT min(doc_id) AS cls, grams, len(grams) AS n FROM d WHERE len(grams) > 0 GROUP BY grams),
g AS (SELECT cls, n, unnest(grams) AS gram FROM c),
link AS (
  SELECT a.cls AS a, b.cls AS b FROM g a JOIN g b ON a.gram = b.gram AND a.cls <> b.cls
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT cls, cls AS other FROM c UNION SELECT r.cls, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT cls, min(other) AS component_id FROM reach GROUP BY cls)
SELECT d.doc_id, len(d.grams)::BIGINT AS n_shingles, CASE WHEN len(d.grams) = 0 THEN d.doc_id ELSE comp.component_id END AS component_id
FROM d LEFT JOIN c USING (grams) LEFT JOIN comp USING (cls)
"""


@query("op3_warc")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages"))


ORACLES["op3_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN firsts f USING (payload_digest)
"""


@query("op4_spotsigs")
def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


@query("op5_pieces")
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query("op6_posting_lists")
def op6_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


# All pairs: what a table of few lists must give exactly; over many lists the search is approximate.
ORACLES["op6_posting_lists"] = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.e, v.e) AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM p QUALIFY rank <= 5
"""


@query("op7_language_evidence")
def op7_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    found = langid.identify(docs, declared=F.col("lang"), host=F.col("source"))
    return found.select("doc_id", "lang", "detected", "confidence",
                        ((F.col("detected") != "und") & (F.col("confidence") >= LANGUAGE_CONFIDENCE)).alias("kept"))


@query("op8_kneser_ney_quality")
def op8_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")
    return quality.classify(table(spark, sf_dir, "documents"), trusted)


@query("op9_pii_anchors")
def op9_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda x: x["kind"].isin(*pii.BASE_KINDS))
    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        pii.spans_text(F.col("spans")).alias("spans"))


@query("op10_byte_shards")
def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op12_tiled_vectors")
def op12_tiled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


ORACLES["op12_tiled_vectors"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON l.a = r.other),
comp AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, ifnull(n.n_links, 0)::BIGINT AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp USING (vec_id) LEFT JOIN n ON n.a = e.vec_id
"""


@query("op11_son_collocations")
def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), support=10, longest=3, covered=50, limit=2000)


ORACLES["op11_son_collocations"] = r"""
WITH p AS (
  SELECT ifnull(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(ifnull(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
      FROM w, (VALUES (1), (2), (3)) t(m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND f >= 10),
k AS (SELECT c.*, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp FROM c, (VALUES (1), (2)) t(k) WHERE k < m),
cut AS (
  SELECT k.lang, k.phrase, a, l.f AS l, r.f AS r, (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = k.lp JOIN f r ON r.lang = k.lang AND r.phrase = k.rp
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY score, k) = 1),
sub AS (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS phrase FROM c WHERE m = 3),
long AS (SELECT lang, phrase, max(a) AS longer FROM sub GROUP BY lang, phrase)
SELECT cut.lang, row_number() OVER (PARTITION BY cut.lang ORDER BY score DESC, a DESC, cut.phrase) AS rank, cut.phrase, a, l, r, n, score
FROM cut JOIN n USING (lang) LEFT JOIN long USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_alignment(table(spark, sf_dir, "documents"), alignment.load())
