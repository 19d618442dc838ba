"""The operators as queries over the given tables, and as SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.byte_bpe import round_trip_digests
from footfall.llm.centroid_clusters import centroid_clusters
from footfall.llm.common import shared_folder, stored
from footfall.llm.exact_dedup import exact_duplicates
from footfall.llm.html_text import main_texts
from footfall.llm.importance import resampled
from footfall.llm.jaccard_join import jaccard_components
from footfall.llm.language_id import predicted
from footfall.llm.line_dedup import near_lines
from footfall.llm.packing import packed_documents
from footfall.llm.spot_signatures import ANCHORS, fingerprints_after_edit
from footfall.llm.token_rollups import Rollup, deletes, inserts, revisions, token_counts
from footfall.llm.vector_search import exact_top_k
from footfall.llm.warc import archived

TOKENIZER_VERSION = "byte_bpe_50k"


def held_out() -> Column:
    """The bucket of documents that nothing is learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(_table(spark, sf_dir, "pages"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip_digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(_table(spark, sf_dir, "pages"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_lines(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predicted(_table(spark, sf_dir, "documents"), training=~held_out())
    return rows.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of the documents, each text once, kept up through four batches.

    Documents arrive in two batches with an estimated count (a token for every four bytes). A third batch revises all
    estimates to the tokenizer's counts; a fourth deletes exact copies, of which the largest doc_id stays. The last two are
    committed twice, as by a job that was run again.
    """
    documents = _table(spark, sf_dir, "documents")
    described = documents.select(
        "doc_id",
        "text",
        "source",
        "lang",
        F.lit(TOKENIZER_VERSION).alias("tokenizer_version"),
        F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / 4).alias("estimate"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"),
    )
    path = public_tokenizers.path(f"{TOKENIZER_VERSION}.tiktoken")
    keep = ("source", "lang", "tokenizer_version", "estimate", "digest")
    counted = stored(token_counts(described, path, public_tokenizers.PATTERN, keep=keep))
    rollup = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    late = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    estimated = counted.select("doc_id", "source", "lang", "tokenizer_version", F.col("estimate").alias("tokens"))
    rollup.commit("arrivals-1", inserts(estimated.filter(~late)))
    rollup.commit("arrivals-2", inserts(estimated.filter(late)))
    largest = counted.groupBy("digest").agg(F.max("doc_id").alias("largest"))
    copies = counted.join(largest, "digest").filter("doc_id < largest")
    for _ in range(2):
        rollup.commit("counts", revisions(counted, "estimate", "tokens"))
        rollup.commit("copies", deletes(copies))
    return rollup.totals()


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(_table(spark, sf_dir, "embeddings"))


def op12_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_after_edit(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (
        op1_exact_top_k,
        op2_exact_dedup,
        op3_main_text,
        op4_byte_bpe,
        op5_warc,
        op6_line_dedup,
        op7_best_fit_packing,
        op8_language_id,
        op9_ngram_jaccard,
        op10_token_rollups,
        op11_centroid_clusters,
        op12_spot_signatures,
        op13_importance_resampling,
    )
    return {query.__name__: query for query in operators}


OP1_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.n <> c.n AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""

OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id
 , max(doc_id) OVER (PARTITION BY t) AS keep_id
 , count(*) OVER (PARTITION BY t) AS group_size
 , doc_id = max(doc_id) OVER (PARTITION BY t) AS kept
 , sha256(t) AS text_sha256
FROM d
"""

OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
s AS (SELECT page_id, h, strlen(h) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id
 , CAST(n AS BIGINT) AS payload_bytes
 , sha1(h) AS payload_digest
 , CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type
 , CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM s
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
  FROM w
), n AS (SELECT doc_id, len(shingles) AS n_shingles FROM s)
, x AS (SELECT doc_id, unnest(shingles) AS g FROM s)
, o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL)
, links AS (
  SELECT o.a, o.b FROM o JOIN n na ON na.doc_id = o.a JOIN n nb ON nb.doc_id = o.b
  WHERE 100 * o.shared >= 80 * (na.n_shingles + nb.n_shingles - o.shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT reach.doc_id, links.b AS other FROM reach JOIN links ON links.a = reach.other
)
SELECT n.doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, min(other) AS component_id
FROM n JOIN reach ON reach.doc_id = n.doc_id GROUP BY n.doc_id, n_shingles
"""


def _clustering_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Lloyd's rounds one after the other, every vector held against every centroid."""
    parts = [
        """v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, e) - 1 AS INTEGER) AS k, e
  FROM v QUALIFY k < {clusters}
)""",
    ]
    for at in range(rounds + 1):
        parts.append(
            f"""a{at} AS MATERIALIZED (
  SELECT n, min(struct_pack(d := d, k := k)) AS best FROM (
    SELECT v.n, c.k, CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM v CROSS JOIN c{at} c) GROUP BY n
)"""
        )
        if at < rounds:
            parts.append(
                f"""m{at} AS (
  SELECT k, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS w
  FROM (SELECT a.best.k AS k, unnest(v.e) AS x, unnest(range(64)) AS i FROM v JOIN a{at} a USING (n)) GROUP BY k, i
), c{at + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.e, c.e) AS e FROM c{at} c LEFT JOIN (
    SELECT k, list((s - ((s % w) + w) % w) // w ORDER BY i) AS e FROM m{at} GROUP BY k) m USING (k)
)"""
            )
    return f"""
WITH {", ".join(parts)}
SELECT v.vec_id, a.best.k AS cluster, a.best.d AS distance
 , CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia
 , CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia
 , sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (n) JOIN c{rounds} c ON c.k = a.best.k
"""


# Both texts cut into words and chains in the same way; a code is the beginning of an MD5.
_SPOTS_SQL = r"""
{out} AS MATERIALIZED (
  WITH w AS (
    SELECT n, t, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM (SELECT n, {text} AS t FROM {source})
  ), p AS (
    SELECT n, word, i, list_contains((SELECT l FROM anchors), word) AS anchor
    FROM (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS i FROM w)
  ), q AS (
    SELECT n, word, i, anchor, CAST(count(*) FILTER (NOT anchor) OVER (PARTITION BY n ORDER BY i) AS BIGINT) AS seen FROM p
  ), c AS (SELECT n, seen AS at, word FROM q WHERE NOT anchor
  ), g AS (
    SELECT q.n, list(DISTINCT substr(md5(concat_ws(' ', q.word, x.word, y.word, z.word)), 1, 12)) AS codes
    FROM q JOIN c x ON x.n = q.n AND x.at = q.seen + 1 JOIN c y ON y.n = q.n AND y.at = q.seen + 2
    JOIN c z ON z.n = q.n AND z.at = q.seen + 3 WHERE q.anchor GROUP BY q.n
  )
  SELECT w.n, list_sort(coalesce(g.codes, CASE WHEN len(words) > 0 THEN [substr(md5(array_to_string(words, ' ')), 1, 12)]
    WHEN t <> '' THEN [substr(md5(' ' || t), 1, 12)] ELSE CAST([] AS VARCHAR[]) END)) AS f
  FROM w LEFT JOIN g USING (n)
)"""

_LIKE_SQL = """CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE CAST(len(list_intersect({a}, {b})) AS DOUBLE)
   / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"""

OP12_SQL = f"""
WITH anchors AS (SELECT [{", ".join(f"'{word}'" for word in ANCHORS)}] AS l),
d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS n, doc_id, coalesce(text, '') AS t FROM documents),
e AS MATERIALIZED (
  SELECT d.n, d.doc_id, d.t, o.n AS next,
    left(d.t, length(d.t) - length(d.t) // 2) || CASE WHEN length(d.t) < 2 THEN '' ELSE left(o.t, length(d.t) // 2) END AS edited
  FROM d JOIN d o ON o.n = d.n % (SELECT count(*) FROM d) + 1
),{_SPOTS_SQL.format(out="own", text="t", source="d")},{_SPOTS_SQL.format(out="changed", text="edited", source="e")}
SELECT e.doc_id, CAST(length(e.t) AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256
 , array_to_string(own.f, '') AS fingerprint, array_to_string(changed.f, '') AS edited_fingerprint
 , {_LIKE_SQL.format(a="own.f", b="changed.f")} AS near_edited
 , {_LIKE_SQL.format(a="own.f", b="after.f")} AS near_next
FROM e JOIN own ON own.n = e.n JOIN changed ON changed.n = e.n JOIN own after ON after.n = e.next
"""

# DuckDB has no CRC-32: a byte at a time, by the table of what each byte adds.
OP13_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(range(9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)
    ORDER BY b) AS l
  FROM (SELECT unnest(range(256)) AS b)
), texts AS (
  SELECT row_number() OVER () AS n, * FROM (
    SELECT true AS own, doc_id, text FROM documents UNION ALL SELECT false, NULL, text FROM benchmark)
), w AS MATERIALIZED (
  SELECT n, own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts
), f AS MATERIALIZED (
  SELECT n, own, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature
  FROM w
), named AS (SELECT feature, hex(encode(feature)) AS h FROM (SELECT DISTINCT feature FROM f)
), b AS MATERIALIZED (
  SELECT feature, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: CAST(('0x' || substr(h, 2 * i + 1, 2)) AS BIGINT)),
    lambda c, x: xor(c // 256, l[xor(c % 256, x) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
  FROM named CROSS JOIN steps
), counted AS MATERIALIZED (
  SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM f JOIN b USING (feature) GROUP BY bucket
), totals AS (SELECT CAST(sum(s) AS BIGINT) AS s, CAST(sum(t) AS BIGINT) AS t FROM counted
), gains AS MATERIALIZED (
  SELECT bucket, CAST(floor(1000 * ln((CAST(c.t + 1 AS DOUBLE) * (x.s + 10000)) / (CAST(c.s + 1 AS DOUBLE) * (x.t + 10000)))) AS BIGINT) AS gain
  FROM counted c CROSS JOIN totals x
), weights AS (
  SELECT n, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM f JOIN b USING (feature) JOIN gains USING (bucket) WHERE own GROUP BY n
), scored AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('7:' || doc_id), 1, 8)) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM w LEFT JOIN weights USING (n) WHERE own
), ordered AS (
  SELECT *, n_words >= 20 AND doc_id IS NOT NULL AS fits,
    row_number() OVER (PARTITION BY n_words >= 20 AND doc_id IS NOT NULL ORDER BY score DESC, doc_id, n_features) AS r
  FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score
 , CASE WHEN fits AND r <= (SELECT count(*) * 25 // 100 FROM ordered WHERE fits) THEN r END AS rank
FROM ordered
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_top_k": OP1_SQL,
        "op2_exact_dedup": OP2_SQL,
        "op5_warc": OP5_SQL,
        "op9_ngram_jaccard": OP9_SQL,
        "op11_centroid_clusters": _clustering_sql(),
        "op12_spot_signatures": OP12_SQL,
        "op13_importance_resampling": OP13_SQL,
    }
