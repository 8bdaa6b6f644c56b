"""Near-duplicate zone descriptions by SimHash and meet-in-the-middle ball hashing."""
from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, free_name, local_roots, signed, stored, text_batches, texts_of

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints that one bucket holds on average, and beyond which a bucket is split by its variants.
BUCKET, CROWDED = 1_500, 3_000


def fingerprint_of(text: str, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 hashes of the shingles of ``text``; zero without a word."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 65_536):
        part = np.unpackbits(hashes[k:k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", shingle: int = SHINGLE) -> DataFrame:
    """``gid, fingerprint`` (the 64 bits as a signed long) of every row; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text_col):
            values = np.array([fingerprint_of(t, shingle) for t in texts_of(batch, text_col)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(id_col).cast(pa.int64()), pa.array(signed(values))], names=[id_col, "fingerprint"])

    return features.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, fingerprint long")


def masks(bits: int, most: int) -> np.ndarray:
    """All numbers below 2**bits with at most ``most`` bits set."""
    return np.array([sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)], dtype=np.uint64)


def links(distinct: DataFrame, count: int, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that connect any two of the ``distinct`` fingerprints within ``radius`` bits, directly or in steps.

    Every fingerprint has all variants within ``radius // 2`` bits; two fingerprints within ``radius`` share a variant,
    and two that share one are within ``radius``. The variants are shuffled by their leading bits: a fingerprint goes to
    every bucket in which it has a variant, and its variants there are written out on arrival, which moves some dozens of
    rows for each fingerprint in place of some thousands. A crowded bucket is split by a hash of the variants. Of each
    variant that several fingerprints share, the others are linked to its smallest one and verified; a bucket returns a
    spanning forest, so large groups of near copies give as many links as members, never all pairs.
    """
    half = radius // 2
    lead = min(24, max(1, math.ceil(math.log2(max(count, 2) / BUCKET))))
    rest = 64 - lead
    inner = {d: masks(rest, half - d) for d in range(half + 1)}
    home = F.shiftrightunsigned("fingerprint", rest)
    away = F.array(*[F.lit(int(m)).cast("long") for m in masks(lead, half)])
    parts = (distinct.groupBy(home.alias("bucket")).count().where(F.col("count") > CROWDED)
             .select("bucket", F.ceil(F.col("count") / CROWDED).cast("int").alias("parts")))
    sent = (distinct.select("fingerprint", F.explode(away).alias("flip")).select("fingerprint", home.bitwiseXOR(F.col("flip")).alias("bucket"))
            .join(parts, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .select("fingerprint", "bucket", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket, part, parts = (k.as_py() for k in key)
        own = np.unique(table.column("fingerprint").to_numpy().view(np.uint64))
        low = own & np.uint64((1 << rest) - 1)
        apart = np.bitwise_count((own >> np.uint64(rest)) ^ np.uint64(bucket))
        values, owners = [], []
        for d, mask in inner.items():
            at = np.flatnonzero(apart == d)
            for k in range(0, len(at), 512):
                some = at[k:k + 512]
                made = (low[some][:, None] ^ mask[None, :]).ravel()
                owner = np.repeat(some.astype(np.int32), len(mask))
                if parts > 1:
                    kept = (made * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(parts) == part
                    made, owner = made[kept], owner[kept]
                values.append(made)
                owners.append(owner)
        values, owners = np.concatenate(values), np.concatenate(owners)
        ordered = np.sort(values)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        del ordered
        found = []
        if len(shared):
            for k in range(0, len(values), 1 << 20):
                place = np.minimum(np.searchsorted(shared, values[k:k + (1 << 20)]), len(shared) - 1)
                hit = np.flatnonzero(shared[place] == values[k:k + (1 << 20)])
                found.append((place[hit], owners[k:k + (1 << 20)][hit]))
            place, owner = (np.concatenate(x) for x in zip(*found))
            first = np.full(len(shared), len(own), dtype=np.int64)
            np.minimum.at(first, place, owner)
            pair = np.unique(first[place] * len(own) + owner)
            a, b = pair // len(own), pair % len(own)
            near = (a != b) & (np.bitwise_count(own[a] ^ own[b]) <= radius)
            root = local_roots(len(own), a[near], b[near])
            tied = np.flatnonzero(root != np.arange(len(own)))
        else:
            root, tied = np.zeros(0, int), np.zeros(0, int)
        return pa.table({"a": own[tied].view(np.int64), "b": own[root[tied]].view(np.int64)})

    return sent.groupBy("bucket", "part", "parts").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Groups of near-duplicate zone descriptions: one row per feature with ``gid``, ``fingerprint`` and ``grupo``.

    ``fingerprint`` is the 64-bit SimHash of the 4-word shingles of the lower-cased (A-Z) description as 16 hex digits;
    ``grupo`` is the smallest ``gid`` that can be reached over links of at most ``radius`` (an even number) differing bits.

    Null or empty descriptions, and those without a word, have fingerprint zero and are linked like any other. Rows that
    repeat stay as they are. A null ``gid`` takes part but never names a group; a group of null ids alone has a null
    ``grupo``. An empty table gives an empty result. Other columns are not read.
    """
    if radius % 2:
        raise ValueError("the radius is halved: give an even number")
    marked = stored(fingerprints(features, id_col, text_col, shingle))
    distinct = stored(marked.groupBy("fingerprint").agg(F.min(id_col).alias("least")))
    tied = components(links(distinct, distinct.count(), radius))
    group = (distinct.join(tied.withColumnRenamed("node", "fingerprint"), "fingerprint")
             .select("fingerprint", "root", "least"))
    named = group.select("fingerprint", "root").join(group.groupBy("root").agg(F.min("least").alias("named")), "root").select("fingerprint", "named")
    whole = distinct.join(named, "fingerprint", "left").select("fingerprint", F.coalesce("named", "least").alias("grupo"))
    return marked.join(whole, "fingerprint").select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "grupo")


def without_near_duplicates(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc") -> DataFrame:
    """The features that stay: of each group the row with the smallest id (one row where several share it, by their text
    hash); rows without an id always stay. All columns are kept."""
    groups, kept = near_duplicates(features, id_col, text_col), free_name(features, "_kept")
    keep = groups.where(F.col(id_col).isNotNull() & (F.col(id_col) == F.col("grupo"))).select(F.col(id_col).alias(kept)).distinct()
    stay = features.join(keep, features[id_col] == F.col(kept), "left_semi")
    return stay.dropDuplicates([id_col]).unionByName(features.where(F.col(id_col).isNull()))
