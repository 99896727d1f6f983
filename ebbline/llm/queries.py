"""The registered queries over whole tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.llm import (
    alignment,
    centroids,
    decontaminate,
    fertility,
    forest_join,
    merge_replay,
    paragraphs,
    projection_dedup,
    site_lines,
    suffix_dedup,
    token_files,
    toxicity,
)
from ebbline.llm import token_counts as counts
from ebbline.llm.common import table
from ebbline.sources import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op3_token_counts(spark, sf_dir):
    return counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return merge_replay.digests(table(spark, sf_dir, "documents"), ranks)


@query
def op4_token_files(spark, sf_dir):
    path = scratch_path(spark, "llm-tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_files.digests(spark.read.parquet(path))


@query
def op7_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = documents.select("doc_id", toxicity.held_out().alias("held_out"), toxicity.score(documents, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op10_site_lines(spark, sf_dir):
    kept = site_lines.page_boilerplate(table(spark, sf_dir, "pages"))
    return kept.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op10_site_lines"] = r"""
WITH lines AS (
  SELECT page_id, nullif(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://([^/?#:]+)', 1), '') AS host,
    list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
      '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', '', 'g'),
      '(?i)</?(a|b|i|em|strong|span)(\s[^>]*)?>', '', 'g'), '<[^>]*>', chr(10), 'g'), chr(10)),
      lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS lines
  FROM pages
), totals AS (SELECT host, count(*) AS pages FROM lines GROUP BY host),
often AS (
  SELECT host, line FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lines WHERE host IS NOT NULL)
  JOIN totals USING (host) GROUP BY host, line, pages HAVING count(*) >= 5 AND count(*) > 0.1 * pages
), marks AS (SELECT host, list(line) AS bad FROM often GROUP BY host),
kept AS (
  SELECT page_id, l.host, lines, list_filter(lines, lambda x: NOT list_contains(coalesce(bad, []), x)) AS rest
  FROM lines l LEFT JOIN marks m ON l.host = m.host
)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(rest))::BIGINT AS n_dropped,
  sha256(array_to_string(rest, chr(10))) AS kept_sha256
FROM kept
"""


@query
def op9_ngram_join(spark, sf_dir):
    return forest_join.similarity_classes(table(spark, sf_dir, "documents"))


@query
def op2_paragraph_dedup(spark, sf_dir):
    """``n_removed`` counts all paragraphs that go: the lines ``removed`` and ``n_cut`` pieces inside other lines."""
    found = paragraphs.removals(table(spark, sf_dir, "documents"))
    gone = (F.col("n_removed") + F.col("n_cut")).alias("n_removed")
    return found.select("doc_id", "n_lines", gone, "removed", "first_docs", F.sha2("kept", 256).alias("kept_sha256"), "n_cut")


@query
def op1_decontamination(spark, sf_dir):
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"))


# Every window of an item's length in every document, aligned by shared shingles.
ORACLES["op1_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
), item_shingles AS (
  SELECT item_id, len(w) AS n, i, array_to_string(w[i:i + 4], ' ') AS s
  FROM items, unnest(range(1, len(w) - 3)) AS r(i) WHERE len(w) >= 7
), doc_shingles AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s, len(w) AS len FROM words, unnest(range(1, len(w) - 3)) AS r(i)
), weights AS (SELECT s, 1.0::DOUBLE / count(DISTINCT item_id) AS weight FROM item_shingles GROUP BY s),
item_counts AS (SELECT item_id, n, s, count(*) AS c, any_value(weight) AS weight FROM item_shingles JOIN weights USING (s) GROUP BY 1, 2, 3),
whole AS (SELECT item_id, sum(c * weight) AS whole FROM item_counts GROUP BY item_id),
starts AS (
  SELECT DISTINCT doc_id, item_id, n, d.i - t.i AS pos FROM doc_shingles d JOIN item_shingles t USING (s)
), windows AS (
  SELECT a.doc_id, a.item_id, a.pos, d.s, count(*) AS m
  FROM starts a JOIN doc_shingles d ON d.doc_id = a.doc_id AND d.i - 1 >= a.pos AND d.i + 4 <= a.pos + a.n
  GROUP BY 1, 2, 3, 4
), scored AS (
  SELECT doc_id, item_id, pos, sum(coalesce(c.weight * least(c.c, m), 0)) AS both_, sum(coalesce(c.weight, 1) * m) AS window_
  FROM windows LEFT JOIN item_counts c USING (item_id, s) GROUP BY 1, 2, 3
)
SELECT doc_id, item_id, round(max(both_ / (whole + window_ - both_)), 6) AS similarity
FROM scored JOIN whole USING (item_id) GROUP BY doc_id, item_id HAVING max(both_ / (whole + window_ - both_)) >= 0.8 - 1e-9
"""


@query
def op6_projection_dedup(spark, sf_dir):
    return projection_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_suffix_dedup(spark, sf_dir):
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_fertility_rules(spark, sf_dir):
    ranks, pieces = (public_tokenizers.path(n) for n in ("byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model"))
    return fertility.quality(table(spark, sf_dir, "documents"), ranks, pieces)


@query
def op12_token_alignment(spark, sf_dir):
    byte_level, pieces = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), byte_level, pieces)


@query
def op13_centroids(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def _centroid_sql(number: int, rounds: int, size: int) -> str:
    """Plain rounds of assigning every vector to every centroid and taking floors of means."""
    distance = "list_sum(list_transform(list_zip(a.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, v FROM kept QUALIFY k < {number}
)"""
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, a.v, min(struct_pack(d := {distance}, k := c.k)) AS best FROM kept a CROSS JOIN c{r} c GROUP BY vec_id, a.v
)"""
        )
        if r < rounds:
            parts.append(
                f"""c{r + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
    SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS v FROM (
      SELECT best.k AS k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r}, unnest(range(1, {size + 1})) AS t(i) GROUP BY 1, 2
    ) GROUP BY k
  ) m ON c.k = m.k
)"""
            )
    return (
        "WITH " + ", ".join(parts) + f"""
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.k = a.best.k
"""
    )


ORACLES["op13_centroids"] = _centroid_sql(centroids.CENTROIDS, centroids.ROUNDS, 64)
