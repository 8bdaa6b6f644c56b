"""Removal of passages that an earlier zone description already holds: hashed windows of words, counted in Spark."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, grouped_with, stored, text_batches, texts_of

WINDOW = 13
WORDS = re.compile(WORD)
BASE, MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9
#: Windows that one task sorts at once, and the bytes of text for each that are counted on.
AT_ONCE, BYTES_EACH = 1 << 20, 6
#: Descriptions that get their answers together.
GROUP = 1_000
HEAD = np.dtype([("gap", "<u4"), ("n", "u1")])


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def window_hashes(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of every window of ``width`` word hashes, mixed so that all bits spread."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out *= np.uint64(base)
        out += words[k:k + n]
    out ^= out >> np.uint64(31)
    out *= np.uint64(MIX)
    out ^= out >> np.uint64(29)
    return out


def joined(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """Hash pairs of all windows of ``texts``, how many each text has, and the words: one pass over all texts."""
    words = [t.encode().split() for t in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = word_hashes([w for own in words for w in own])
    one, two = window_hashes(flat, width, BASE | 1), window_hashes(flat, width, MIX | 1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    counts = np.maximum(lengths - width + 1, 0)
    inside = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    return one[inside], two[inside], counts, words


def heads_of(owner: np.ndarray) -> tuple[int, bytes]:
    """Sorted ids as the first one and, for each run of equal ids, the gap from the id before and its length."""
    cut = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))
    gid, n = owner[cut], np.diff(np.append(cut, len(owner)))
    gap = np.diff(gid, prepend=gid[:1])
    more, far = -(-n // 255), gap >> 32
    times = more + far
    out = np.zeros(times.sum(), dtype=HEAD)
    last = np.cumsum(times)
    lead = last - times
    inside = np.arange(len(out)) - np.repeat(lead, times)
    far, more, gap, n = (np.repeat(x, times) for x in (far, more, gap, n))
    out["gap"] = np.where(inside < far, 0xFFFFFFFF, np.where(inside == far, gap - far * 0xFFFFFFFF, 0))
    out["n"] = np.where(inside < far, 0, np.minimum(255, n - 255 * (inside - far)))
    return int(gid[0]), out.tobytes()


def owners_of(first: int, heads: bytes) -> np.ndarray:
    head = np.frombuffer(heads, dtype=HEAD)
    return np.repeat(first + np.cumsum(head["gap"].astype(np.int64)), head["n"])


def runs_of(starts: np.ndarray) -> np.ndarray:
    """Sorted numbers as pairs of first and end (exclusive) of their runs."""
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return np.stack((starts[np.concatenate(([0], cut))], starts[np.append(cut, len(starts)) - 1] + 1), axis=1).astype("<i4")


def bucketed(features: DataFrame, buckets: int, id_col: str, text_col: str, width: int) -> DataFrame:
    """The windows of a batch of descriptions, dealt out by hash: ``bucket, first, heads`` (ids and numbers of windows),
    ``hashes, checks`` (eight and two bytes for each window).

    A window that repeats in a batch is sent for the smallest id alone. The batch itself holds the earlier description of
    the others, which leave as rows ``gid, digest, spans``: runs of window numbers in the text of that digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text_col, 4 << 20):
            ids = batch.column(id_col)
            known = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            gids = ids.take(pa.array(known)).cast(pa.int64()).to_numpy()
            order = np.argsort(gids, kind="stable")
            texts = texts_of(batch, text_col)
            texts, gids = [texts[i] for i in known[order]], gids[order]
            one, two, counts, _ = joined(texts, width)
            if not len(one):
                continue
            row = np.repeat(np.arange(len(gids)), counts)
            place = np.arange(len(one)) - np.repeat(np.cumsum(counts) - counts, counts)
            by = np.argsort(one, kind="stable")  # stable: the smallest id comes first among equals
            two = (two >> np.uint64(48)).astype("<u2")
            new = np.concatenate(([True], (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])))
            least = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
            again = np.sort(by[~new & (gids[row[by]] > gids[row[least]])])
            first = by[new]
            bucket = (one[first] >> np.uint64(40)).astype(np.int64) * buckets >> 24
            first = first[np.lexsort((row[first], bucket))]
            bucket = (one[first] >> np.uint64(40)).astype(np.int64) * buckets >> 24
            out = []
            cut = np.flatnonzero(np.diff(bucket)) + 1
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)]):
                at = first[s:e]
                out.append((int(bucket[s]), *heads_of(gids[row[at]]), one[at].tobytes(), two[at].tobytes(), None, None, None))
            cut = np.flatnonzero(np.diff(row[again])) + 1 if len(again) else []
            for own in np.split(again, cut) if len(again) else []:
                text = texts[row[own[0]]]
                digest = xxhash.xxh64_intdigest(text.encode(), 42)
                out.append((int(digest % buckets), None, None, None, None, int(gids[row[own[0]]]), digest - (digest >> 63 << 64), runs_of(place[own]).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SENT.types)], names=SENT.names)

    return features.select(id_col, text_col).mapInArrow(run, "bucket int, first long, heads binary, hashes binary, checks binary, gid long, digest long, spans binary")


SENT = pa.schema([("bucket", pa.int32()), ("first", pa.int64()), ("heads", pa.binary()), ("hashes", pa.binary()), ("checks", pa.binary()),
                  ("gid", pa.int64()), ("digest", pa.int64()), ("spans", pa.binary())])
FOUND = pa.schema([("group", pa.int64()), ("gids", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary()), ("digest", pa.int64()), ("spans", pa.binary())])


def group_of(gid: int, groups: int) -> int:
    """Spark's ``pmod(xxhash64(gid), groups)``."""
    code = xxhash.xxh64_intdigest(gid.to_bytes(8, "little", signed=True), 42)
    return (code - (code >> 63 << 64)) % groups


def repeated_windows(features: DataFrame, id_col: str, text_col: str, width: int, buckets: int, groups: int) -> DataFrame:
    """The windows of each description that one with a smaller id holds, packed for ``groups`` groups of ids: either ids with
    the ``hashes`` of their windows (little-endian 64 bits), or one id with ``spans``, runs of window numbers in the text of
    ``digest``.

    Every window of ``width`` words is hashed (64 bits of one polynomial and 16 of another decide equality); windows meet
    by hash in buckets of bounded size, in batches of some eleven bytes a window rather than a row each. A very frequent
    window reaches its bucket once per batch of text.
    """
    def meet(key: tuple, table: pa.Table) -> pa.Table:
        sent = pa.compute.is_valid(table.column("heads"))
        rows = [(group_of(g, groups), np.int64(g).tobytes(), None, None, d, s)
                for g, d, s in zip(*(table.filter(pa.compute.invert(sent)).column(c).to_pylist() for c in ("gid", "digest", "spans")))]
        table = table.filter(sent)
        if table.num_rows:
            owner = np.concatenate([owners_of(f, h) for f, h in zip(table.column("first").to_pylist(), table.column("heads").to_pylist())])
            one = np.frombuffer(b"".join(table.column("hashes").to_pylist()), dtype="<u8")
            two = np.frombuffer(b"".join(table.column("checks").to_pylist()), dtype="<u2")
            by = np.lexsort((owner, two, one))
            new = np.flatnonzero(np.concatenate(([True], (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1]))))
            least = np.repeat(owner[by][new], np.diff(np.append(new, len(by))))
            held = by[owner[by] > least]
            gids, back = np.unique(owner[held], return_inverse=True)
            group = np.array([group_of(g, groups) for g in gids.tolist()], dtype=np.int64)[back] if len(gids) else back
            held = held[np.lexsort((owner[held], group))]
            group = np.sort(group)
            cut = np.flatnonzero(np.diff(group)) + 1
            for own in np.split(held, cut) if len(held) else []:
                start = np.concatenate(([0], np.flatnonzero(np.diff(owner[own])) + 1))
                rows.append((group_of(int(owner[own[0]]), groups), owner[own][start].astype("<i8").tobytes(),
                             np.diff(np.append(start, len(own))).astype("<i4").tobytes(), one[own].tobytes(), None, None))
        columns = zip(*rows) if rows else [[]] * len(FOUND)
        return pa.table([pa.array(c, t) for c, t in zip(columns, FOUND.types)], schema=FOUND)

    return bucketed(features, buckets, id_col, text_col, width).groupBy("bucket").applyInArrow(
        meet, "group long, gids binary, counts binary, hashes binary, digest long, spans binary")


class Answers:
    """What was found for the ids of one group."""

    def __init__(self, table: pa.Table):
        self.spans: dict[int, list[tuple[int, bytes]]] = {}
        gids, hashes = [np.zeros(0, "<i8")], [np.zeros(0, "<u8")]
        for row in table.to_pylist():
            own = np.frombuffer(row["gids"], dtype="<i8")
            if row["spans"] is not None:
                self.spans.setdefault(int(own[0]), []).append((row["digest"], row["spans"]))
            else:
                gids.append(np.repeat(own, np.frombuffer(row["counts"], dtype="<i4")))
                hashes.append(np.frombuffer(row["hashes"], dtype="<u8"))
        gids, hashes = np.concatenate(gids), np.concatenate(hashes)
        by = np.argsort(gids, kind="stable")
        self.gids, self.hashes = gids[by], hashes[by]

    def of(self, gid: int | None) -> tuple[list[tuple[int, bytes]], np.ndarray] | None:
        if gid is None:
            return None
        start, end = np.searchsorted(self.gids, (gid, gid + 1))
        spans = self.spans.get(gid, [])
        return (spans, self.hashes[start:end]) if spans or end > start else None


def covered(words: int, spans: list[tuple[int, bytes]], wanted: np.ndarray, text: str, hashes: np.ndarray, width: int) -> np.ndarray:
    """Which words of a text stand in a window that was found."""
    depth = np.zeros(words + 1, dtype=np.int32)
    digest = xxhash.xxh64_intdigest(text.encode(), 42)
    digest -= digest >> 63 << 64
    for own, runs in spans:
        if own == digest:
            for s, e in np.frombuffer(runs, dtype="<i4").reshape(-1, 2).tolist():
                depth[s] += 1
                depth[e + width - 1] -= 1
    starts = np.flatnonzero(np.isin(hashes, wanted)) if len(wanted) else np.zeros(0, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, starts + width, -1)
    return np.cumsum(depth[:-1]) > 0


def _cuts(batch: pa.RecordBatch, answers: Answers, id_col: str, text_col: str, width: int) -> Iterator[tuple[list[bytes] | None, np.ndarray | None, str]]:
    """Words, which of them go, and text of every row; no words where nothing goes."""
    texts, found = texts_of(batch, text_col), [answers.of(g) for g in batch.column(id_col).to_pylist()]
    touched = [i for i, f in enumerate(found) if f]
    one, _, counts, words = joined([texts[i] for i in touched], width)
    at = np.concatenate(([0], np.cumsum(counts)))
    place = {i: k for k, i in enumerate(touched)}
    for i, text in enumerate(texts):
        k = place.get(i)
        gone = None if k is None else covered(len(words[k]), *found[i], text, one[at[k]:at[k + 1]], width)
        yield (None, None, text) if gone is None or not gone.any() else (words[k], gone, text)


def _answered(features: DataFrame, id_col: str, text_col: str, width: int, use, schema) -> DataFrame:
    """``use(batch, cuts)`` over the features in groups of some thousand ids, each with what was found for them."""
    size, rows = features.agg(F.sum(F.octet_length(text_col)), F.count("*")).first()
    buckets, groups = max(1, int((size or 0) // BYTES_EACH // AT_ONCE) + 1), rows // GROUP + 1
    found = stored(repeated_windows(features, id_col, text_col, width, buckets, groups))
    group = F.pmod(F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(F.col(id_col).cast("long"))), F.lit(groups))

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        held = Answers(answers)
        return pa.Table.from_batches([use(batch, list(_cuts(batch, held, id_col, text_col, width))) for batch in text_batches(rows.to_batches(), text_col)])

    return grouped_with(features, group, found, "group", run, schema)


def without_repeated_passages(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", width: int = WINDOW) -> DataFrame:
    """Descriptions without the passages that an earlier one holds: ``gid, n_words, n_removed, removed, kept``.

    A word (a run of anything but ASCII white space, taken unchanged) goes if a window of ``width`` words around it also
    starts in a description with a smaller ``gid``, judged on the input. ``removed`` lists the maximal intervals of word
    numbers (end exclusive), ``kept`` has the other words joined by one space. Null and empty descriptions give no
    words and an empty ``kept``; those shorter than a window stay whole. Rows without a ``gid`` neither lose words nor
    make others lose them; rows that share a ``gid`` do not remove from each other. Other columns are not read.
    """
    def use(batch: pa.RecordBatch, cuts: list) -> pa.RecordBatch:
        rows = []
        for words, gone, text in cuts:
            if gone is None:
                words = text.encode().split()
                rows.append((len(words), 0, [], b" ".join(words)))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).reshape(-1, 2)
            rows.append((len(words), int(gone.sum()), [{"start": s, "end": e} for s, e in edges.tolist()], b" ".join(w for w, g in zip(words, gone.tolist()) if not g)))
        n_words, n_removed, removed, kept = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()).cast(pa.string())],
            names=[id_col, "n_words", "n_removed", "removed", "kept"])

    rows = features.select(F.col(id_col).cast("long").alias(id_col), text_col)
    schema = T.StructType([rows.schema[id_col], *T.DataType.fromDDL("n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string").fields])
    return _answered(rows, id_col, text_col, width, use, schema)


def cut_passages(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", width: int = WINDOW) -> DataFrame:
    """The features with repeated passages cut out of ``zona_desc``, see :func:`without_repeated_passages`. What is left keeps
    its white space, a line break stands for each passage inside; untouched texts stay as they are, null included."""
    def use(batch: pa.RecordBatch, cuts: list) -> pa.RecordBatch:
        texts = batch.column(text_col).to_pylist()
        for i, (_, gone, text) in enumerate(cuts):
            if gone is not None:
                spans = [m.span() for m in WORDS.finditer(text)]
                edges = np.flatnonzero(np.diff(np.concatenate(([0], (~gone).astype(np.int8), [0])))).reshape(-1, 2)
                texts[i] = "\n".join(text[spans[s][0]:spans[e - 1][1]] for s, e in edges.tolist())
        columns = [pa.array(texts, pa.string()) if n == text_col else batch.column(n) for n in batch.schema.names]
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return _answered(features, id_col, text_col, width, use, features.schema)
