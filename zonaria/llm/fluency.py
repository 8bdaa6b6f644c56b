"""Quality of zone descriptions by perplexity: an interpolated modified Kneser-Ney model of trusted descriptions.

The model is over characters (orders one to five), so that compounds and rare words of any language get a fair figure.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import grouped_with, stored, text_batches, texts_of

ORDER = 5
#: Bits of a character in a gram: code points below 4096 stand for themselves, others share the upper half.
BITS = 12
#: Bytes of text that meet the model together, and in how many waves the corpus goes, which bounds the disk in use.
TOGETHER, WAVES = 16 << 20, 4
#: Share of trusted rows held back to set thresholds: a quantile of their perplexity per language, stretched.
HELD_BACK, QUANTILE, STRETCH = 5, 0.995, 1.1
BATCH = 1 << 20


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each character of the lower-cased texts (white space is one blank, blanks go before), and how
    many each text has."""
    plain = [" ".join(t.lower().split()) for t in texts]
    sizes = np.array([len(t) for t in plain], dtype=np.int64)
    lead = " " * (ORDER - 1)
    points = np.frombuffer("".join(lead + t for t in plain).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    points = np.where(points < 1 << BITS, points, (1 << BITS - 1) + points % (1 << BITS - 1))
    grams = np.zeros(max(len(points) - ORDER + 1, 0), dtype=np.int64)
    for k in range(ORDER):
        grams = grams << BITS | points[k:k + len(grams)]
    ends = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
    inside = np.repeat(ends - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return grams[inside], sizes


def tagged(gram: Column, length: int) -> Column:
    """Key of the last ``length`` characters of a gram."""
    return gram.bitwiseAND(F.lit((1 << BITS * length) - 1)).bitwiseOR(F.lit(length << BITS * ORDER))


def gram_counts(features: DataFrame, text_col: str) -> DataFrame:
    """``gram, n``: counts of the longest grams, summed in batches before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text_col, 8 * BATCH):
            gram, n = np.unique(grams_of(texts_of(batch, text_col))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], names=["gram", "n"])

    return features.select(text_col).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Discounts of grams seen once, twice and more often, from how many are seen one to four times."""
    seen = {r.n: r["count"] for r in counts.where("n <= 4").groupBy("n").count().collect()}
    n1, n2, n3, n4 = (seen.get(k, 0) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = [(k + 1) * y * b / a if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return tuple(min(max(k - r, 0.05), k - 0.05) for k, r in zip((1.0, 2.0, 3.0), ratio))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``key, p, back``: of every gram of one to five characters the log probability of its last character (``p``), and of
    every context the log weight of what lies below it (``back``).

    The longest grams have counts, shorter ones the number of different characters before them. Orders are joined from
    the lowest up; all tables are sharded by their keys.
    """
    orders = {ORDER: counts.select("gram", "n")}
    for k in range(ORDER - 1, 0, -1):
        orders[k] = stored(orders[k + 1].groupBy(F.col("gram").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("gram")).agg(F.count("*").alias("n")))
    below, tables, characters = None, [], orders[1].count() + 1
    for k in range(1, ORDER + 1):
        once, twice, more = discounts(orders[k])
        cut = F.when(F.col("n") == 1, once).when(F.col("n") == 2, twice).otherwise(more)
        grams = orders[k].select("gram", "n", cut.alias("cut"), F.shiftright("gram", BITS).alias("context"))
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("weight"))
        one = grams.join(contexts, "context").withColumn("rest", F.col("gram").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)))
        lower = F.lit(1.0 / characters) if below is None else F.col("lower")
        if below is not None:
            one = one.join(below.select(F.col("gram").alias("rest"), F.col("p").alias("lower")), "rest")
        below = stored(one.select("gram", ((F.col("n") - F.col("cut")) / F.col("total") + F.col("weight") * lower).alias("p")))
        tables.append(below.select(tagged(F.col("gram"), k).alias("key"), F.log("p").alias("p"), F.lit(None).cast("double").alias("back")))
        tables.append(contexts.select(tagged(F.col("context"), k - 1).alias("key"), F.lit(None).cast("double").alias("p"), F.log("weight").alias("back")))
    unknown = F.lit(-float(np.log(characters)))
    tables.append(counts.sparkSession.range(1).select(F.col("id").alias("key"), unknown.alias("p"), F.lit(None).cast("double").alias("back")))
    return stored(reduce(DataFrame.unionByName, tables).groupBy("key").agg(F.max("p").alias("p"), F.max("back").alias("back")))


def gram_scores(grams: DataFrame, model: DataFrame) -> DataFrame:
    """``gram, score``: log probability of the last character of each gram by the longest part of it that the model has,
    with the weights of the contexts passed on the way down."""
    parts = F.array(*[F.struct(tagged(F.col("gram"), k).alias("key"), F.lit(k).alias("level"), F.lit(True).alias("whole")) for k in range(ORDER, -1, -1)],
                    *[F.struct(tagged(F.shiftright("gram", BITS), k - 1).alias("key"), F.lit(k).alias("level"), F.lit(False).alias("whole")) for k in range(ORDER, 0, -1)])
    asked = grams.select("gram", F.explode(parts).alias("part")).select("gram", "part.*")
    hits = asked.join(model, "key").where(F.when(F.col("whole"), F.col("p").isNotNull()).otherwise(F.col("back").isNotNull()))
    best = hits.groupBy("gram").agg(
        F.max(F.when(F.col("whole"), F.struct("level", "p"))).alias("best"),
        F.collect_list(F.when(~F.col("whole"), F.struct("level", "back"))).alias("backs"))
    weights = F.aggregate(F.filter("backs", lambda b: b["level"] > F.col("best.level")), F.lit(0.0), lambda s, b: s + b["back"])
    return best.select("gram", (F.col("best.p") + weights).alias("score"))


def _wave(features: DataFrame, wave: int) -> DataFrame:
    return features.where(F.pmod("_at", F.lit(WAVES)) == wave)


def perplexities(features: DataFrame, model: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """``gid, idioma, perplexity`` of every row. Descriptions are dealt to groups of bounded size; a group asks the sharded
    model for its different grams and scores its texts with the answers."""
    size = features.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    groups = max(1, int(size // WAVES // TOGETHER) + 1)
    out = []

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams = [np.unique(grams_of(texts_of(b, "texto"))[0]) for b in text_batches(table.to_batches(), "texto", BATCH)]
        grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, dtype=np.int64)
        return pa.table({"group": np.full(len(grams), key[0].as_py()), "gram": grams})

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        gram, value = answers.column("gram").to_numpy(), answers.column("score").to_numpy()
        by = np.argsort(gram)
        gram, value = gram[by], value[by]
        found = []
        for batch in text_batches(rows.to_batches(), "texto", BATCH):
            own, sizes = grams_of(texts_of(batch, "texto"))
            logs = value[np.searchsorted(gram, own)] if len(own) else np.zeros(0)
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=logs, minlength=len(sizes))
            found.append(np.where(sizes > 0, np.exp(-total / np.maximum(sizes, 1)), np.nan))
        values = np.concatenate(found) if found else np.zeros(0)
        return pa.table({"gid": rows.column("gid"), "idioma": rows.column("idioma"), "held": rows.column("held"),
                         "perplexity": pa.array(values, pa.float64(), mask=np.isnan(values))})

    for wave in range(WAVES):
        rows = _wave(features, wave).select(F.col(id_col).cast("long").alias("gid"), F.col(text_col).alias("texto"), F.col(label_col).alias("idioma"), "held",
                                            F.pmod(F.floor(F.col("_at") / WAVES), F.lit(groups)).alias("group"))
        asked = stored(rows.groupBy("group").applyInArrow(ask, "group long, gram long"))
        answers = asked.join(stored(gram_scores(asked.select("gram").distinct(), model)), "gram")
        out.append(stored(grouped_with(rows, F.col("group"), answers, "group", score, "gid long, idioma string, held boolean, perplexity double")))
    return reduce(DataFrame.unionByName, out)


def rate(features: DataFrame, trusted: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", label_col: str = "idioma") -> DataFrame:
    """Perplexity and verdict of every description: ``gid, idioma, perplexity, threshold, kept``.

    ``trusted`` has the ids of descriptions known to be good. The model is counted on four fifths of them; of the others
    a high quantile of perplexity per language, stretched, is the ``threshold``, so that text like the trusted stays. A
    language that is null or has no trusted rows takes the quantile of all. Null and empty descriptions have no
    perplexity and are not kept; without trusted rows there is no threshold and all others are kept. Rows without an id
    are never trusted; ids may repeat; equal rows have equal results; other columns are not read; an empty table gives
    an empty one.
    """
    at = F.shiftrightunsigned(F.xxhash64(F.lit("wave"), id_col, text_col), 1)
    held = F.pmod(F.xxhash64(F.lit("held"), id_col), F.lit(HELD_BACK)) == 0
    rows = features.select(id_col, text_col, label_col, at.alias("_at"))
    good = trusted.select(F.col(id_col).alias("_good")).where("_good is not null").distinct()
    counts = []
    for wave in range(WAVES):
        known = _wave(rows, wave).where(~held).join(good, F.col(id_col) == F.col("_good"), "left_semi")
        counts.append(stored(gram_counts(known, text_col)))
    model = kneser_ney(stored(reduce(DataFrame.unionByName, counts).groupBy("gram").agg(F.sum("n").alias("n"))))
    found = perplexities(rows.withColumn("held", F.coalesce(held, F.lit(False))), model, id_col, text_col, label_col)
    judged = found.where("held").join(good, F.col("gid") == F.col("_good"), "left_semi").where("perplexity is not null")
    limit = F.percentile_approx("perplexity", QUANTILE, 10_000) * STRETCH
    limits = judged.groupBy("idioma").agg(limit.alias("own")).where("idioma is not null")
    overall = judged.agg(limit.alias("all")).first()["all"]
    joined = found.join(limits.withColumnRenamed("idioma", "_idioma"), F.col("idioma") == F.col("_idioma"), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    return joined.select(F.col("gid").alias(id_col), F.col("idioma").alias(label_col), "perplexity", threshold.alias("threshold"),
                         (F.col("perplexity").isNotNull() & (threshold.isNull() | (F.col("perplexity") <= threshold))).alias("kept"))
