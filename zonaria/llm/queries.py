"""One query per text operator over the given tables, and the DuckDB text where SQL can express it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import fluency, language, neighbours, packing, passages, periods, phrases, pieces, pii, quality, sharding, simhash, wordbpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def descriptions(docs: DataFrame, *more: str) -> DataFrame:
    """The documents as features with a zone description."""
    return docs.select(F.col("doc_id").alias("gid"), F.col("text").alias("zona_desc"), *more)


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return descriptions(spark.read.parquet(f"{sf_dir}/documents.parquet"), *more)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(documents(spark, sf_dir)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack_pieces(pieces).select(F.col("gid").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_texts(documents(spark, sf_dir)).withColumn("n_ids", (F.octet_length("ids") / 4).cast("long")).withColumn("ids_crc32", F.crc32("ids"))
    return pieces.decode_texts(encoded).select(F.col("gid").alias("doc_id"), "n_ids", "ids_crc32", F.crc32(F.encode("zona_desc", "UTF-8")).alias("decoded_crc32"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = (*pii.KINDS, "term")
    names = F.array(*[F.lit(k) for k in kinds])

    def count(k: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kinds[k]}")

    def digest(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat(names[s["kind"]], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))
    return pii.personal_data(documents(spark, sf_dir)).select(
        F.col("gid").alias("doc_id"), *[count(k) for k in range(len(pii.KINDS))], F.sha2(digest(base), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(F.col("gid").alias("doc_id"), "fingerprint", F.col("grupo").alias("component_id"))


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(documents(spark, sf_dir)).withColumnRenamed("gid", "doc_id")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.without_repeated_passages(documents(spark, sf_dir)).select(
        F.col("gid").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0", "vec_id", "embedding")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.learn(descriptions(docs.where(~held_out), F.col("lang").alias("idioma")))
    found = language.identify(descriptions(docs), model).withColumnRenamed("gid", "doc_id")
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("idioma").alias("lang_pred"), "score", "distance", "rejected")


@query
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select(F.col("doc_id").alias("gid"))
    return fluency.rate(documents(spark, sf_dir, F.col("lang").alias("idioma")), trusted).select(
        F.col("gid").alias("doc_id"), F.col("idioma").alias("lang"), "perplexity", "threshold", "kept")


ORACLES["op6_substring_dedup"] = r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
    firsts AS (SELECT k, min(doc_id) AS d FROM win GROUP BY k),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM win JOIN firsts USING (k) WHERE d < doc_id),
    g AS (SELECT doc_id, list(i) AS gs, count(*) AS n_removed FROM gone GROUP BY doc_id),
    words AS (SELECT w.doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
    kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS t FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i WHERE gone.i IS NULL GROUP BY 1)
    SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN g USING (doc_id) LEFT JOIN kept USING (doc_id)"""


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir)).withColumnRenamed("gid", "doc_id")


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = wordbpe.encode_words(documents(spark, sf_dir))
    return wordbpe.decode_words(encoded).select(
        F.col("gid").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("zona_desc", "UTF-8"), 256).alias("decoded_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth of ``documents`` by the checksum of its id repeats its words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size("w").cast("long"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    at = F.transform(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    planted = docs.withColumn("w", F.when(h % 10 == 0, words)).withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    return planted.withColumn("text", F.when(F.col("p").isNotNull(), F.array_join(at, " ")).otherwise(F.col("text"))).drop("w", "a", "p")


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    runs = F.col("repeticiones")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["largo"].alias("l"), (-r["inicio"]).alias("s"), (-r["periodo"]).alias("p"))))
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["inicio"], r["largo"], r["periodo"]), F.lit("\n")))
    return periods.repeated_runs(descriptions(with_planted_runs(docs))).withColumn("m", longest).select(
        F.col("gid").alias("doc_id"), F.size(runs).cast("long").alias("n_runs"), (-F.col("m.s")).alias("start"), F.col("m.l").alias("length"),
        (-F.col("m.p")).alias("period"), F.floor(1000 * F.col("m.l") / -F.col("m.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("zona_desc", 256).alias("collapsed_sha256"))


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir, F.col("lang").alias("idioma"))).select(
        F.col("idioma").alias("lang"), F.col("puesto").alias("rank"), F.col("frase").alias("phrase"), "a", "l", "r", "n", F.col("puntaje").alias("score"))


ORACLES["op13_phrase_collocations"] = r"""WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    pieces AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
    numbered AS (SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM numbered GROUP BY lang),
    words AS (SELECT lang, p, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM numbered),
    ahead AS (SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY p ORDER BY i)),
    grams AS (SELECT lang, w AS phrase, 1 AS m, count(*) AS f FROM ahead GROUP BY ALL
        UNION ALL SELECT lang, w || ' ' || w2, 2, count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
        UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3, 3, count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL
        UNION ALL SELECT lang, w || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY ALL),
    often AS (SELECT * FROM grams WHERE f >= 30),
    cuts AS (SELECT o.lang, o.phrase, o.m, o.f AS a, k, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * o.f // (l.f + r.f) AS BIGINT) AS score
        FROM often o JOIN range(1, 4) AS ks(k) ON k < o.m
        JOIN often l ON l.lang = o.lang AND l.phrase = array_to_string(string_split(o.phrase, ' ')[1:k], ' ')
        JOIN often r ON r.lang = o.lang AND r.phrase = array_to_string(string_split(o.phrase, ' ')[k + 1:o.m], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (SELECT o.lang, array_to_string(string_split(o.phrase, ' ')[s:s + size - 1], ' ') AS phrase, max(o.f) AS f
        FROM often o JOIN range(2, 4) AS sizes(size) ON size < o.m JOIN range(1, 4) AS firsts(s) ON s + size - 1 <= o.m GROUP BY 1, 2),
    kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR CAST(100 AS HUGEINT) * inside.f < CAST(80 AS HUGEINT) * best.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
