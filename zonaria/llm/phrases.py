"""Collocations of zone descriptions: a sample proposes phrases, passes over all texts count them and their border."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import free_name, stored, text_batches

#: Occurrences that make a phrase frequent, words of the longest phrase, phrases reported for each group.
LEAST, LONGEST, TOP = 30, 4, 2_000
#: One text of so many (by a hash of its id) is in the sample; there a phrase is proposed from so many occurrences on.
SAMPLE_OF, PROPOSED = 8, 3
#: A longer phrase with this share (percent) of a phrase's occurrences stands for it.
ABSORBED = 80
#: Bits of the map of known phrases: 8 MB, whatever the corpus. Where bits collide, phrases are counted in vain, none is lost.
BITS = 1 << 26
#: Salts of the counts of single words, which belong to many phrases, and of large groups.
SALTS = 16
BATCH = 6 << 20
#: Phrases that leave a batch together.
SENT = 1 << 16
#: Occurrences in a batch from which a phrase is added up for the task, and how many of those a task holds.
OFTEN, HELD = 4, 100_000
UNKNOWN = "und"
#: Ends a piece; no byte of UTF-8.
STOP = b"\xff"
MIX = 0x9E3779B97F4A7C15
FOLDED = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else b for b in range(256))
COUNTED = "grupo string, frase string, palabras int, n long"


def word_code(group: bytes, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(group + STOP + word)


def longer_code(code: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Codes of phrases with one more word."""
    code = code * np.uint64(MIX) + word
    return code ^ code >> np.uint64(29)


def codes_of(groups: list[str], phrases: list[str]) -> np.ndarray:
    """The code of each phrase, from its words one by one."""
    words = [[word_code(g.encode(), w) for w in p.encode().split(b" ")] for g, p in zip(groups, phrases)]
    size = np.array([len(w) for w in words], dtype=np.int64)
    out = np.array([w[0] for w in words], dtype=np.uint64)
    for k in range(1, int(size.max(initial=0))):
        more = np.flatnonzero(size > k)
        out[more] = longer_code(out[more], np.array([words[i][k] for i in more.tolist()], dtype=np.uint64))
    return out


class Known:
    """Phrases as bits of a map of fixed size."""

    def __init__(self, bits: np.ndarray | None = None):
        self.bits = np.zeros(BITS >> 3, dtype=np.uint8) if bits is None else bits

    def has(self, codes: np.ndarray) -> np.ndarray:
        place = self.place(codes)
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)

    @staticmethod
    def place(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint64(MIX) >> np.uint64(65 - BITS.bit_length())).astype(np.int64)

    def with_phrases(self, phrases: DataFrame) -> Known:
        """Also ``phrases(grupo, frase)``: executors set the bits, the driver gets the map, at most 8 MB."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = codes_of(batch.column("grupo").to_pylist(), batch.column("frase").to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(1 + self.place(codes))], names=["code"])

        maps = (phrases.select("grupo", "frase").mapInArrow(run, "code long")
                .groupBy(F.bitmap_bucket_number("code").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits")))
        out = self.bits.copy()
        for row in maps.collect():
            held = np.frombuffer(bytes(row.bits), dtype=np.uint8)
            at = (row.part - 1) * len(held)  # parts and places in them count from 1
            out[at:at + len(held)] |= held
        return Known(out)


def words_of(texts: list[str]) -> list[bytes]:
    """Words of all ``texts``, with a stop between pieces. Only A-Z change case."""
    return STOP.join([t.encode() for t in texts]).lower().translate(FOLDED).replace(STOP, b" \xff ").split()


def phrases_in(group: bytes, texts: list[str], longest: int, known: Known | None, before: Known | None, only: int | None) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Phrases of ``texts`` with their occurrences, by length. A phrase is open, and counted, if its first and its last
    words but one are in ``known`` (single words always); with ``only``, those of that length alone.

    With ``before`` those that were open under ``before`` are left out, and the others also open longer phrases as if
    they were known: whatever turns out frequent among them has been counted together with all that it opens.
    """
    words = words_of(texts)
    number: dict[bytes, int] = {STOP: 0}
    at = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    del words
    single = list(number)
    word_codes = np.array([word_code(group, w) for w in single], dtype=np.uint64)
    ids, codes, times, made = at, word_codes, np.bincount(at, minlength=len(single)), []
    open_now = at > 0
    open_before = open_now & (before is not None)

    def names(size: int, which: np.ndarray) -> list[bytes]:
        if size == 1:
            return [single[i] for i in which.tolist()]
        keys = made[size - 2][which]
        return [a + b" " + b for a, b in zip(names(size - 1, keys >> 32), names(1, keys & 0xFFFFFFFF))]

    for size in range(1, longest + 1):
        if size > 1:
            end = len(at) - size + 1
            if end <= 0:
                return
            open_now = live[:end] & live[1:end + 1]
            open_before = live_before[:end] & live_before[1:end + 1]
            place = np.flatnonzero(open_now)
            if not len(place):
                return
            keys, held, times = np.unique(ids[place] << 32 | at[place + size - 1], return_inverse=True, return_counts=True)
            made.append(keys)
            codes = longer_code(codes[keys >> 32], word_codes[keys & 0xFFFFFFFF])
            ids = np.zeros(end, dtype=np.int64)
            ids[place] = held
        fresh = open_now & ~open_before
        if only is None or only == size:
            new = np.zeros(len(codes), dtype=bool)
            new[ids[fresh]] = True
            new = np.flatnonzero(new)
            for at_once in np.split(new, range(SENT, len(new), SENT)):
                yield size, names(size, at_once), times[at_once]
        if size == longest or known is None or size == only:
            return
        live = open_now & known.has(codes)[ids]
        if before is not None:
            live |= fresh
            live_before = open_before & before.has(codes)[ids]
        else:
            live_before = np.zeros(len(ids), dtype=bool)


def counted(texts: DataFrame, longest: int, known: Known | None = None, before: Known | None = None, only: int | None = None) -> DataFrame:
    """Exact counts of phrases of ``texts(grupo, texto)``, see :func:`phrases_in`. Batches are counted first, so that a
    phrase leaves a batch once however often it stands there; common ones are added up for the whole task, so that no
    phrase is in more than a few rows for each. The empty phrase counts all words of a group."""
    spark = texts.sparkSession
    now = spark.sparkContext.broadcast(known) if known else None
    then = spark.sparkContext.broadcast(before) if before else None

    def rows_of(group: str, size: int, phrases: list[bytes], times: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([group] * len(phrases), pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()),
             pa.array(np.full(len(phrases), size, dtype=np.int32)), pa.array(times.astype(np.int64))], names=["grupo", "frase", "palabras", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often: dict[tuple[str, int], dict[bytes, int]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (group, size), held in often.items():
                yield rows_of(group, size, list(held), np.array(list(held.values())))
            often.clear()

        for batch in text_batches(batches, "texto", BATCH):
            rows: dict[str, list[str]] = {}
            for group, text in zip(batch.column("grupo").to_pylist(), batch.column("texto").to_pylist()):
                rows.setdefault(group, []).append(text)
            del batch
            for group, own in rows.items():
                for size, phrases, times in phrases_in(group.encode(), own, longest, now and now.value, then and then.value, only):
                    held = often.setdefault((group, size), {})
                    if size == 1 and not then:
                        held[b""] = held.get(b"", 0) + int(times.sum())
                    for i in np.flatnonzero(times >= OFTEN).tolist():
                        held[phrases[i]] = held.get(phrases[i], 0) + int(times[i])
                    rare = np.flatnonzero(times < OFTEN)
                    if len(rare):
                        yield rows_of(group, size, [phrases[i] for i in rare.tolist()], times[rare])
            if sum(map(len, often.values())) > HELD:
                yield from flushed()
        yield from flushed()

    # Counted already, so the rows are dealt out first; a further count before the shuffle would find little to add up.
    return texts.mapInArrow(run, COUNTED).repartition("grupo", "frase").groupBy("grupo", "frase", "palabras").agg(F.sum("n").alias("n"))


def proposals(sample: DataFrame, longest: int, proposed: int) -> tuple[DataFrame, Known]:
    """Phrases that the sample holds ``proposed`` times, length by length, and their map."""
    found, known = None, Known()
    for size in range(1, longest + 1):
        own = stored(counted(sample, longest, known if size > 1 else None, only=size).where((F.col("n") >= proposed) & (F.col("frase") != "")))
        found = own if found is None else found.unionByName(own)
        known = known.with_phrases(own)
    return found, known


def frequent_phrases(texts: DataFrame, sample: Column, least: int = LEAST, longest: int = LONGEST, proposed: int = PROPOSED) -> DataFrame:
    """All phrases of ``texts(grupo, texto)`` with ``least`` occurrences, exactly: ``grupo, frase, palabras, n``; the empty
    phrase counts the words of a group.

    Rows of ``sample`` propose phrases. A pass over all texts counts these and their negative border: phrases that were
    not proposed though their parts were. The border is not listed; a phrase of it is met where it stands. If a border
    phrase turns out frequent, a further pass counts the phrases that it opens, those that they would open, and so on up
    to ``longest`` words, so that nothing is left open after it.
    """
    found, known = proposals(stored(texts.where(sample)), longest, proposed)
    frequent = (F.col("n") >= least) | (F.col("frase") == "")
    result = stored(counted(texts, longest, known).where(frequent))
    failed = stored(result.where("frase <> ''").join(_by_merge(found), ["grupo", "frase"], "left_anti"))
    if failed.isEmpty():
        return result
    return result.unionByName(stored(counted(texts, longest, known.with_phrases(failed), known).where(frequent)))


def _by_merge(phrases: DataFrame) -> DataFrame:
    """``phrases`` as a side that no join broadcasts: there are as many as the corpus has, though packed files, filters and
    rows still to be exploded let them look small, and the driver would hold them all."""
    return phrases.hint("merge")


def _part(first: Column | int, count: Column | int) -> Column:
    return F.array_join(F.slice("w", first, count), " ")


def _counts_of(cuts: DataFrame, counts: DataFrame, part: str, words: str, name: str) -> DataFrame:
    """``cuts`` with the occurrences of ``part``. Single words are met by many phrases: their rows are salted."""
    salt = F.when(F.col(words) == 1, F.pmod(F.xxhash64("frase"), F.lit(SALTS)).cast("int")).otherwise(0)
    other = counts.select("grupo", F.col("frase").alias(part), F.col("n").alias(name),
                          F.explode(F.when(F.col("palabras") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return cuts.withColumn("salt", salt).join(_by_merge(other), ["grupo", part, "salt"]).drop("salt", part)


def _big(name: str) -> Column:
    return F.col(name).cast("decimal(19,0)")


def scored(counts: DataFrame) -> DataFrame:
    """Phrases of two words or more with their weakest cut: ``grupo, frase, palabras, a, l, r, puntaje``. Cut after its
    first k words, a phrase of a occurrences scores 2 000 000 a / (l + r), rounded down; ties go to the smallest k."""
    counts = counts.where("frase <> ''")
    cuts = (counts.where("palabras > 1").withColumnRenamed("n", "a").withColumn("w", F.split("frase", " "))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("palabras") - 1)))
            .withColumns({"first": _part(F.lit(1), F.col("k")), "rest": _part(F.col("k") + 1, F.col("palabras") - F.col("k")), "others": F.col("palabras") - F.col("k")})
            .drop("w"))
    cuts = _counts_of(_counts_of(cuts, counts, "first", "k", "l"), counts, "rest", "others", "r")
    cuts = cuts.withColumns({"l": _big("l"), "r": _big("r")}).withColumn("puntaje", F.expr("(2000000BD * CAST(a AS DECIMAL(19,0))) div (l + r)"))
    best = cuts.groupBy("grupo", "frase", "palabras", "a").agg(F.min(F.struct("puntaje", "k", "l", "r")).alias("c"))
    return best.select("grupo", "frase", "palabras", "a", F.col("c.l").cast("long").alias("l"), F.col("c.r").cast("long").alias("r"), F.col("c.puntaje").alias("puntaje"))


def without_absorbed(phrases: DataFrame, percent: int = ABSORBED) -> DataFrame:
    """``phrases`` without those that stand inside a longer one with ``percent`` of their occurrences or more."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("palabras") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("palabras") - size + 1), lambda first: F.array_join(F.slice("w", first, size), " "))))
    longer = (phrases.where("palabras > 2").withColumn("w", F.split("frase", " ")).select("grupo", F.explode(F.array_distinct(spans)).alias("frase"), "a")
              .groupBy("grupo", "frase").agg(F.max("a").alias("longer")))
    kept = F.col("longer").isNull() | (100 * _big("longer") < percent * _big("a"))
    return phrases.join(_by_merge(longer), ["grupo", "frase"], "left").where(kept).drop("longer")


def collocations(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", group_col: str = "idioma", least: int = LEAST, longest: int = LONGEST,
                 top: int = TOP) -> DataFrame:
    """The strongest phrases of the descriptions of each group: ``idioma, puesto, frase, a, l, r, n, puntaje``.

    Words are what blanks and tabs part within pieces, pieces what ``.,;:!?`` and line ends part; only A-Z change case. A
    candidate has two to ``longest`` words and ``least`` occurrences ``a`` (overlaps count) in its group. ``l`` and ``r``
    are the occurrences of its two parts at its weakest cut, ``n`` those of all words, ``puntaje`` its score; phrases that a
    longer one stands for are left out (see :func:`without_absorbed`). The ``top`` best of each group are ranked by score,
    occurrences and phrase. Counts are exact and cover all texts; the sample only proposes.

    A null group is ``und``. Null and empty texts have no words. Null or repeated ids and equal rows are rows like any
    other (ids only draw the sample); other columns are not read; an empty table, or one without frequent phrases, gives
    an empty result.
    """
    key = free_name(features, "_sample")
    rows = features.select(F.coalesce(F.col(f"`{group_col}`").cast("string"), F.lit(UNKNOWN)).alias("grupo"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("texto"),
                           F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(SAMPLE_OF)).alias(key))
    counts = frequent_phrases(rows, F.col(key) == 0, least, longest)
    best = without_absorbed(scored(counts))
    order = [F.desc("puntaje"), F.desc("a"), "frase"]
    # The best of each salt first: a large group is sorted by many tasks, and few rows of it meet in the end.
    best = best.withColumn("salt", F.pmod(F.xxhash64("frase"), F.lit(SALTS)))
    best = best.withColumn("puesto", F.row_number().over(W.partitionBy("grupo", "salt").orderBy(*order))).where(F.col("puesto") <= top)
    totals = counts.where("frase = ''").select("grupo", "n")
    return (best.withColumn("puesto", F.row_number().over(W.partitionBy("grupo").orderBy(*order))).where(F.col("puesto") <= top).join(_by_merge(totals), "grupo")
            .select(F.col("grupo").alias(group_col), F.col("puesto").cast("long").alias("puesto"), "frase", "a", "l", "r", "n", "puntaje"))
