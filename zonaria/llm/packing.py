"""Packing of tokenised zone descriptions into sequences of fixed length, by bin completion."""
from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored, text_batches, texts_of

CAPACITY = 2048
#: Steps the search may take on the histogram of lengths before it settles for the best packing found.
SEARCH_STEPS = 6_000
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}


def byte_encoder(vocabulary: str = VOCABULARY):
    """Byte-level BPE encoder over the ranks in ``vocabulary``, the file's name or its path."""
    import public_tokenizers
    import tiktoken

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    with open(path) as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_pieces(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """Token ids of every description, an id 0 after them, cut to at most ``capacity``: ``gid, piece, start, length, ids``.

    ``ids`` holds the ids as little-endian unsigned 32-bit numbers. Only descriptions longer than ``capacity`` are cut,
    into pieces of exactly that length, of which the first may be shorter; ``start`` counts the ids before a piece.
    Null and empty descriptions have the one id 0. Marker texts of the vocabulary become their single id, as with the
    public tokenizer file of the same vocabulary, whose ids these are. ``block`` and ``nth`` number the pieces of equal
    length within a task; a null or repeated ``gid`` is carried along.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = byte_encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in text_batches(batches, text_col):
            ids_of = batch.column(id_col).to_pylist()
            rows = []
            for key, text in zip(ids_of, texts_of(batch, text_col)):
                ids = np.array([*encoder.encode(text, allowed_special="all"), 0], dtype="<u4")
                first = len(ids) % capacity or min(capacity, len(ids))
                at = 0
                for k in range(-(-len(ids) // capacity)):
                    end = first + k * capacity
                    seen[end - at] += 1
                    rows.append((key, k, at, end - at, ids[at:end].tobytes(), seen[end - at] - 1))
                    at = end
            key, piece, start, length, ids, nth = zip(*rows)
            yield pa.RecordBatch.from_arrays([
                pa.array(key, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(ids, pa.binary()), pa.array([block] * len(key), pa.int64()), pa.array(nth, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids", "block", "nth"])

    return features.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, piece int, start long, length long, ids binary, block long, nth long")


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram of lengths: (lengths of a sequence, how many such sequences)."""
    left = counts.copy()
    out = []
    while left.any():
        room, items = capacity, []
        while True:
            fits = np.flatnonzero(left[: room + 1])
            if not len(fits):
                break
            item = int(fits[-1])
            items.append(item)
            left[item] -= 1
            room -= item
        for item in items:
            left[item] += 1
        out.append(_repeat(tuple(items), left))
    return out


def _repeat(items: tuple[int, ...], left: np.ndarray) -> tuple[tuple[int, ...], int]:
    """As many sequences of ``items`` as ``left`` allows, taken from it."""
    kinds, each = np.unique(items, return_counts=True)
    times = int((left[kinds] // each).min())
    left[kinds] -= each * times
    return items, times


def completions(left: np.ndarray, capacity: int, most: int = 3) -> list[tuple[int, ...]]:
    """Undominated ways to complete a sequence around the largest length, the least waste first.

    A length that fills the room exactly dominates every other way. Otherwise the ways with one, two and three more
    lengths are compared, each completed until nothing fits, so that none is dominated by adding a length.
    """
    largest = int(np.flatnonzero(left)[-1])
    free = left.copy()
    free[largest] -= 1
    room = capacity - largest
    if room == 0 or not free[: room + 1].any():
        return [(largest,)]
    if free[room]:
        return [(largest, room)]
    sizes = np.flatnonzero(free[: room + 1])
    below = np.maximum.accumulate(np.where(free[: room + 1] > 0, np.arange(room + 1), 0))

    def partner(firsts: np.ndarray, spare: np.ndarray) -> np.ndarray:
        found = below[spare]
        again = (found == firsts) & (free[firsts] < 2)
        return np.where(again, below[np.maximum(np.minimum(found - 1, spare), 0)], found)

    seconds = partner(sizes, room - sizes)
    waste = room - sizes - seconds
    order = np.lexsort((-sizes, waste))[:most]
    ways = [(int(sizes[i]), int(seconds[i])) for i in order]
    if waste[order[0]]:
        some = sizes[-96:]
        for x in some[::-1]:
            spare = room - x
            inner = sizes[: np.searchsorted(sizes, spare, side="right")]
            inner = inner[(inner != x) | (free[inner] > 1)]
            if not len(inner):
                continue
            third = partner(inner, spare - inner)
            third = np.where((third == x) & (free[x] < 2 + (inner == x)), 0, third)
            rest = spare - inner - third
            best = int(np.argmin(rest))
            if rest[best] < waste[order[0]]:
                ways.append((int(x), int(inner[best]), int(third[best])))
    out = {}
    for way in ways:
        taken = free.copy()
        items = [largest]
        for item in (*[w for w in way if w],):
            if not taken[item]:
                break
            taken[item] -= 1
            items.append(item)
        spare = capacity - sum(items)
        while spare and len(fits := np.flatnonzero(taken[: spare + 1])):
            item = int(fits[-1])
            taken[item] -= 1
            items.append(item)
            spare -= item
        out[tuple(sorted(items, reverse=True))] = spare
    return [k for k, _ in sorted(out.items(), key=lambda x: (x[1], tuple(-i for i in x[0])))][:most]


def plan(counts: np.ndarray, capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[tuple[tuple[int, ...], int]]:
    """Fewest sequences for a histogram of lengths (``counts[length]``): bin completion branch and bound.

    The incumbent is best-fit decreasing. The search completes a sequence around the largest remaining length, repeats
    it as often as the histogram allows, and backs out where the waste so far leaves no way to beat the incumbent. It ends
    at the bound on waste, when every branch is closed, or after ``steps`` completions with the incumbent, which is valid.
    """
    total = int((counts * np.arange(len(counts))).sum())
    incumbent = best_fit(counts, capacity)
    fewest = sum(n for _, n in incumbent)
    bound = -(-total // capacity)
    stack = [(counts.copy(), 0, 0, None)]  # lengths left, sequences and waste so far, chain of decisions
    while stack and fewest > bound and steps > 0:
        left, used, wasted, chain = stack.pop()
        if wasted > (fewest - 1) * capacity - total:
            continue
        if not left.any():
            fewest, incumbent = used, []
            while chain:
                decision, chain = chain
                incumbent.append(decision)
            continue
        steps -= 1
        for items in reversed(completions(left, capacity)):
            rest = left.copy()
            _, times = _repeat(items, rest)
            stack.append((rest, used + times, wasted + times * (capacity - sum(items)), ((items, times), chain)))
    return incumbent


def segments(packing: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first, sequence, each, offset``: pieces of ``length`` ranked from ``first`` on fill the sequences
    from ``sequence`` on, ``each`` in one, from ``offset`` on. Sorted by length and first."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for items, times in packing:
        kinds, each = np.unique(items, return_counts=True)
        at = 0
        for kind, n in zip(kinds.tolist(), each.tolist()):
            rows.append((kind, used.get(kind, 0), sequence, n, at))
            used[kind] = used.get(kind, 0) + n * times
            at += n * kind
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (``length, block, nth`` and any other columns): as few sequences of
    ``capacity`` as the search finds, every piece once, gapless from offset 0.

    The search sees the histogram of lengths alone (at most ``capacity`` counts), whatever the number of pieces; pieces
    of equal length are interchangeable and get their rank from counts per task. An empty table gives an empty result.
    """
    held = stored(pieces)
    per_task = held.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = per_task.withColumn("base", F.sum("n").over(W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in held.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    table = segments(plan(counts, capacity, steps))  # at most one row per length and decision: bounded by the capacity
    keys = table[:, 0] << 40 | table[:, 1]
    wanted = [c for c in held.columns if c not in ("block", "nth")]
    ranked = held.join(before.select("length", "block", F.coalesce("base", F.lit(0)).alias("base")), ["length", "block"]).select(
        *wanted, (F.col("base") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 40 | rank, side="right") - 1
            place = rank - table[at, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in wanted], pa.array(table[at, 2] + place // table[at, 3]), pa.array(table[at, 4] + place % table[at, 3] * length)],
                names=[*wanted, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema if f.name in wanted)
    return ranked.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def pack_texts(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", capacity: int = CAPACITY) -> DataFrame:
    """Pack the descriptions of ``features``: ``gid, piece, start, length, ids, sequence_id, offset``, see
    :func:`token_pieces` and :func:`pack_pieces`."""
    return pack_pieces(token_pieces(features, id_col, text_col, capacity), capacity)
