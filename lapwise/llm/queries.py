"""The operators run over the shared tables, each with its result digested to the agreed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm import (
    ann, html, importance, language, minhash, mixing, negatives, packing, pstable, repeats, secrets, sharding, topk,
)
from lapwise.llm.common import read


def op1_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    return sharding.shuffle(docs, 24).select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = docs.select("doc_id", secrets.find_secrets("text").alias("found"))

    def number(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = [rule.kind for rule in secrets.BASE_RULES]
    return found.select(
        "doc_id", *[number(kind) for kind in base],
        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0, 20)


OP3_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS c FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
s AS (
    SELECT q.vec_id AS query_id, w.vec_id AS vec_id, list_inner_product(q.c, w.c)::BIGINT AS score
    FROM v q JOIN v w ON q.vec_id % 20 = 0 AND q.vec_id <> w.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = minhash.near_duplicates(docs, "text", "doc_id", width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


_WORD = r"[^\x20\x09-\x0D]+"
OP4_SQL = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
    FROM documents
),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
    FROM w
),
g AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM g a JOIN g b USING (h) WHERE a.doc_id <> b.doc_id
    GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN c USING (doc_id)
"""


def held_out(key: Column | str) -> Column:
    """Documents kept apart from learning, by their key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = language.fit(docs.where(~held_out("doc_id")), "text", "lang", "doc_id")
    return docs.select(
        "doc_id", held_out("doc_id").alias("held_out"), language.predict_language("text", profiles).alias("_p")
    ).select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", html.extract("html").alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.repeated_spans(docs, "text", "doc_id")
    removed = F.aggregate("repeats", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), removed.alias("n_removed"),
        F.size("repeats").cast("bigint").alias("n_spans"),
        F.sha2(repeats.kept(F.col("text"), F.col("repeats")), 256).alias("kept_sha256"),
    )


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), "text", "doc_id")


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", mixing.words("text").alias("size"))
    return mixing.mix(sized, "doc_id", "size", "source").select("doc_id", "size", "source_size", "target", "taken")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, 5)


OP9_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
    FROM documents
),
n AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS n,
           1.5::DOUBLE * sum(sum(size)) OVER () AS budget
    FROM d GROUP BY source
),
w AS (SELECT *, [5, 2, 1][(n - 1) % 3 + 1]::DOUBLE AS weight, 2 * source_size AS most FROM n),
l AS (
    SELECT *, most / weight AS ratio,
           (budget - coalesce(sum(most) OVER (ORDER BY most / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY most / weight, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
),
t AS (
    SELECT source, source_size, budget, least(most::DOUBLE, coalesce(
        (SELECT level FROM l WHERE level < ratio ORDER BY ratio, n LIMIT 1) * weight, most)) AS target
    FROM l
),
copies AS (
    SELECT d.*, target, budget, coalesce('=' || d.source, '') AS name,
           (turn + ('0x' || md5(coalesce(doc_id::VARCHAR, 'null') || ':' || turn)[:13])::BIGINT / 4503599627370496.0::DOUBLE) / 2 AS place
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source, range(2) AS turns(turn) WHERE size > 0 AND target > 0
),
served AS (
    SELECT *, sum(size) OVER (PARTITION BY name ORDER BY place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) / target AS finish
    FROM copies
),
used AS (
    SELECT *, sum(size) OVER (ORDER BY finish, name, place, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS used
    FROM served
),
taken AS (SELECT r, sum(size)::BIGINT AS taken FROM used WHERE used <= budget GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN taken USING (r)
"""

def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents"), "text", "doc_id", read(spark, sf_dir, "benchmark"), "text")


_RUNS = r"""
    SELECT {id}, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM (
        SELECT {id}, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM {table})
"""
# CRC-32 by its table of 256 entries, a byte at a time.
OP11_SQL = f"""
WITH steps AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
runs AS MATERIALIZED ({_RUNS.format(id="r", table="d")}),
goal AS MATERIALIZED ({_RUNS.format(id="item_id", table="benchmark")}),
crc AS MATERIALIZED (
    SELECT f, xor(list_reduce([4294967295] || list_transform(range(1, strlen(f) + 1),
            lambda i: ('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket
    FROM (SELECT f FROM runs UNION SELECT f FROM goal), steps
),
s AS (SELECT bucket, count(*) AS n FROM runs JOIN crc USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM goal JOIN crc USING (f) GROUP BY bucket),
gain AS (
    SELECT b AS bucket, floor(1000 * ln(
        ((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM runs) + 10000.0::DOUBLE))
        / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM goal) + 10000.0::DOUBLE))))::BIGINT AS g
    FROM range(10000) AS x(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
),
w AS (
    SELECT r, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
    FROM runs JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY r
),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM d LEFT JOIN w USING (r)
),
ranked AS (
    SELECT *, row_number() OVER (ORDER BY n_features < 39, score DESC, doc_id NULLS FIRST) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 25 * (SELECT count(*) FROM scored WHERE n_features >= 39) // 100 THEN place END AS rank
FROM ranked
"""


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pstable.near_vectors(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("label"))
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP12_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS c FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.c, b.c) >= 0.98
),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = read(spark, sf_dir, "embeddings")
    return negatives.hard_negatives(rows, "vec_id", "embedding", moved, vec_id % 100 == 0)


OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
s AS MATERIALIZED (
    SELECT a.vec_id AS a, w.vec_id AS w, a.label = w.label AS same, list_inner_product(a.c, w.c)::BIGINT AS score
    FROM v a JOIN v w ON a.vec_id % 100 = 0 AND a.vec_id <> w.vec_id
),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, w) <= 5)
SELECT p.a AS anchor_id, p.w AS positive_id,
       (row_number() OVER (PARTITION BY p.a, p.w ORDER BY s.score DESC, s.w))::INTEGER AS rank, s.w AS negative_id,
       p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
QUALIFY rank <= 10
"""

QUERIES = {
    "op1_shard": (op1_shard, None),
    "op2_secret_scan": (op2_secret_scan, None),
    "op3_top_k": (op3_top_k, OP3_SQL),
    "op4_near_duplicates": (op4_near_duplicates, OP4_SQL),
    "op5_language_id": (op5_language_id, None),
    "op6_extract": (op6_extract, None),
    "op7_repeats": (op7_repeats, None),
    "op8_pack": (op8_pack, None),
    "op9_mix": (op9_mix, OP9_SQL),
    "op10_nearest": (op10_nearest, None),
    "op11_resample": (op11_resample, OP11_SQL),
    "op12_near_vectors": (op12_near_vectors, OP12_SQL),
    "op13_hard_negatives": (op13_hard_negatives, OP13_SQL),
}
