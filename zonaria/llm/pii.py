"""Personal data in zone descriptions: patterns, and terms that give away what the patterns protect.

Catalyst expressions only; no Python runs on the executors.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored

# The kinds in their order, and what a match looks like. The patterns match what the plain ones of the
# README match; runs are possessive and start at their first character, so that no text takes more than linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = r"\p{L}[\p{L}'-]++"
#: A term discloses an entity if it says this share of the entity's information.
DISCLOSURE = 0.9
#: How many texts the entity's share in the corpus weighs as when a term's share of texts with the entity is estimated.
PRIOR = 1.0
#: So many counted terms go to every task; more are met by a shuffle.
AT_HAND = 1 << 17
BLOCK = 128
SPAN = "array<struct<start:int,end:int,value:string>>"


def bound(value: Column, use) -> Column:
    """``use(x)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def running(steps: Column) -> Column:
    """Running sums of an array of integers, in blocks, so that long arrays stay far from quadratic."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

    def placed(blocks: Column) -> Column:
        sums = F.transform(blocks, total)
        return bound(sums, lambda s: F.flatten(F.transform(blocks, lambda part, b: bound(
            total(F.slice(s, 1, b)), lambda base: F.transform(part, lambda _, i: base + total(F.slice(part, 1, i + 1)))))))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), lambda b: F.slice(steps, b * BLOCK + 1, BLOCK))
    return bound(blocks, placed)


def matches(text: Column, pattern: str) -> Column:
    """All non-overlapping matches with code point positions (end exclusive), from the gaps between them."""
    def zipped(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            steps = F.transform(found, lambda m, i: F.char_length(gaps[i]) + F.char_length(m))
            return bound(running(steps), lambda ends: F.transform(found, lambda m, i: F.struct(
                (ends[i] - F.char_length(m)).cast("int").alias("start"), ends[i].cast("int").alias("end"), m.alias("value"))))

        return F.when(F.size(found) > 0, bound(F.split(text, pattern, -1), with_gaps)).otherwise(F.array().cast(SPAN))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), zipped)


def holds(kind: str, value: Column) -> Column:
    """Whether a match of ``kind`` counts: addresses with parts up to 255, cards of 12 to 19 digits that pass Luhn's
    check, telephone numbers of 9 to 15 digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def spans_of(text: Column, number: int, kind: str) -> Column:
    hint = text.contains("@") if kind == "email" else text.contains("+") if kind == "phone" else text.rlike("[0-9]")
    good = F.filter(matches(text, PATTERNS[kind]), lambda s: holds(kind, s["value"]))
    spans = F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
    return F.when(hint, spans).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))


def base_spans(text: Column) -> Column:
    """Spans of all kinds by start, then kind: ``array<struct<start, kind, end, value>>`` (kind as its number)."""
    return F.array_sort(F.concat(*[spans_of(text, number, kind) for number, kind in enumerate(KINDS)]))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with blanks in place of ``spans`` (by start), all other characters where they were."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(acc: Column, s: Column) -> Column:
        open_part = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        blank = F.repeat(F.lit(" "), F.greatest(s["end"] - F.greatest(s["start"], acc["at"]), F.lit(0)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.array_append(acc["parts"], F.concat(open_part, blank)).alias("parts"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, add, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text)))))


def hashed(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def different_texts(texts: DataFrame, text_col: str) -> DataFrame:
    """Each different text once: ``digest``, its ``spans`` and its ``words``, the text with blanks in place of the spans. Stored."""
    once = texts.select(digest_of(F.col(text_col)).alias("digest"), F.col(text_col).alias("_text")).groupBy("digest").agg(F.first("_text").alias("_text"))
    return stored(once.withColumn("spans", base_spans(F.col("_text"))).select("digest", "spans", masked(F.col("_text"), F.col("spans")).alias("words")))


def digest_of(text: Column) -> Column:
    return F.xxhash64(text, F.octet_length(text))


def words_with_entities(different: DataFrame, most: float) -> DataFrame:
    """``digest, term, with_term``: the different words of every text that holds an entity, as hashes, with the number of
    different texts that hold the word, where that is at most ``most``. Stored."""
    words = F.array_distinct(F.transform(F.regexp_extract_all(F.col("words"), F.lit(TERM), F.lit(0)), hashed))
    frequency = different.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("with_term")).where(F.col("with_term") <= most)
    return stored(different.where(F.size("spans") > 0).select("digest", F.explode(words).alias("term")).join(frequency, "term").select("digest", "term", "with_term"))


def disclosing_terms(different: DataFrame, disclosure: float = DISCLOSURE, prior: float = PRIOR) -> tuple[DataFrame, DataFrame] | None:
    """The terms (``term``, a hash, and ``with_term``) whose pointwise mutual information with a protected entity reaches
    ``disclosure`` of the entity's own information content, and the words they were looked for among
    (:func:`words_with_entities`). None where no text holds an entity that says anything.

    Entity, term, both and all are counted over different texts, a term towards an entity wherever one text holds both. The
    share of a term's texts that hold the entity is estimated with ``prior`` texts in which the entity is as frequent as in
    the corpus, so an entity of a single text is disclosed by the words of that text alone as soon as the corpus is large
    enough for them to say as much, and never by words that are copied with it.

    Entities of the same texts have the same terms and are counted as one. A word in more texts than could disclose any
    entity of its text is left out before pairs are made; that changes no result.
    """
    total = float(max(different.count(), 1))
    held = stored(different.where(F.size("spans") > 0).select("digest", F.explode("spans").alias("s"))
                  .select("digest", F.xxhash64(F.col("s.kind"), F.lower("s.value")).alias("entity")).distinct())
    alike = held.groupBy("entity").agg(F.count("*").alias("with_entity"), F.bit_xor("digest").alias("x"), F.bit_xor(F.xxhash64("digest")).alias("y"))
    share = F.col("with_entity") / total
    alike = alike.where(share < 1).select("entity", F.xxhash64("with_entity", "x", "y").alias("group"), "with_entity", share.alias("share"), F.pow(share, 1 - disclosure).alias("least"))
    alike = alike.withColumn("most", (F.col("with_entity") + prior * F.col("share")) / F.col("least") - prior + 1e-6)
    most = alike.agg(F.max("most")).first()[0]
    if most is None:
        return None
    words = words_with_entities(different, most)
    groups = held.join(alike, "entity").drop("entity").distinct()
    pairs = words.join(groups, "digest").where(F.col("with_term") <= F.col("most"))
    both = pairs.groupBy("group", "term").agg(F.count("*").alias("both"), *[F.first(c).alias(c) for c in ("with_term", "share", "least")])
    estimate = (F.col("both") + prior * F.col("share")) / (F.col("with_term") + prior)
    return stored(both.where(estimate >= F.col("least")).select("term", "with_term").distinct()), words


def placed_words(different: DataFrame) -> DataFrame:
    return different.select("digest", F.explode(matches(F.col("words"), TERM)).alias("w")).select("digest", hashed(F.col("w.value")).alias("term"), "w.start", "w.end")


def term_spans(different: DataFrame, disclosure: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame | None:
    """``digest, start, end`` of every occurrence of a disclosing term, or None where there are none: in the texts that hold
    an entity, and in all others for the terms that these texts hold too."""
    found = disclosing_terms(different, disclosure, prior)
    if found is None:
        return None
    telling, words = found
    own = words.join(telling.select("term"), "term").select("digest", "term")
    marked = placed_words(different.where(F.size("spans") > 0)).join(own, ["digest", "term"]).select("digest", "start", "end")
    beside = words.groupBy("term").agg(F.count("*").alias("beside"))
    elsewhere = stored(telling.join(beside, "term").where(F.col("with_term") > F.col("beside")).select("term"))
    many = elsewhere.count()
    if not many:
        return marked
    elsewhere = F.broadcast(elsewhere) if many <= AT_HAND else elsewhere
    return marked.unionByName(placed_words(different.where(F.size("spans") == 0)).join(elsewhere, "term").select("digest", "start", "end"))


def personal_data(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", disclosure: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame:
    """Personal data in every description: ``gid, digest, spans``, the spans as ``array<struct<start, kind, end>>`` by start
    with the kinds ``email, ip, card, phone, term`` as numbers and code point positions (end exclusive).

    The first four kinds are patterns with checks. A ``term`` is a word of at least two letters outside such spans that the
    corpus shows to give one of them away (:func:`disclosing_terms`). ``digest`` identifies the text. Null and empty texts
    have no spans; a null or repeated ``gid`` is a row like any other; equal rows have equal results. Other columns are not
    read. Empty in, empty out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = features.select(id_col, text.alias(text_col))
    different = different_texts(texts, text_col)
    kind = "array<struct<start:int,kind:int,end:int>>"
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    marks = different.where(F.size("spans") > 0).select(F.col("digest").alias("_digest"), F.explode(base).alias("m"))
    terms = term_spans(different, disclosure, prior)
    if terms is not None:
        marks = marks.unionByName(terms.select(F.col("digest").alias("_digest"), F.struct("start", F.lit(len(KINDS)).alias("kind"), "end").alias("m")))
    marks = marks.groupBy("_digest").agg(F.array_sort(F.collect_set("m")).alias("spans"))
    keyed = texts.select(id_col, digest_of(F.col(text_col)).alias("digest"))
    return keyed.join(marks, F.col("digest") == F.col("_digest"), "left").select(id_col, "digest", F.coalesce("spans", F.array().cast(kind)).alias("spans"))


def sanitised(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", disclosure: float = DISCLOSURE, prior: float = PRIOR) -> DataFrame:
    """The features with personal data in ``zona_desc`` generalised to the name of its kind in brackets, terms removed.

    Overlapping spans become one, named after the first. All columns and rows stay; null texts stay null.
    """
    key, of, found = (free_name(features, n) for n in ("_text", "_digest", "_spans"))
    marks = personal_data(features, id_col, text_col, disclosure, prior).where(F.size("spans") > 0).groupBy(F.col("digest").alias(of)).agg(F.first("spans").alias(found))
    text = F.col(text_col)
    label = F.array(*[F.lit(f"[{k}]") for k in KINDS], F.lit("[]"))

    def replaced(spans: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

        def add(acc: Column, s: Column) -> Column:
            fresh = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), label[s["kind"]])
            return (F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.array_append(acc["parts"], fresh).alias("parts")))
                    .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["parts"].alias("parts"))))

        return F.aggregate(spans, start, add, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.char_length(text))))

    joined = features.withColumn(key, F.xxhash64(text, F.octet_length(text))).join(marks, F.col(key) == F.col(of), "left")
    return joined.withColumn(text_col, F.when(F.col(found).isNotNull(), replaced(F.col(found))).otherwise(text)).select(*[F.col(f"`{c}`") for c in features.columns])

