"""Runs of repeated words in zone descriptions: suffix classes united by decreasing common prefix seed maximal runs."""
from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORD, text_batches, texts_of

WORDS = re.compile(WORD)
#: Shortest run in words.
SHORTEST = 12
#: Bytes of text whose suffixes are sorted together.
BATCH = 2 << 20
#: Positions in one block of an ordered set.
BLOCK = 4_096
RUN = pa.struct([("inicio", pa.int64()), ("largo", pa.int64()), ("periodo", pa.int64())])


def dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of ``keys``: equal keys share one."""
    order = np.argsort(keys)
    held = keys[order]
    out = np.empty(len(keys), dtype=np.int32)
    out[order] = np.cumsum(np.concatenate(([False], held[1:] != held[:-1])))
    return out


def shifted(rank: np.ndarray, by: int) -> np.ndarray:
    """``rank`` of the place ``by`` further on, -1 beyond the end."""
    out = np.full(len(rank), -1, dtype=np.int64)
    if by < len(rank):
        out[:-by] = rank[by:]
    return out


def repeated_suffixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the suffix array of ``symbols`` that share ``least`` words (six or more) or more: the two positions and
    how many words they share.

    Ranks of prefixes double in length. Suffixes that are alone with their prefix are settled; only the others are sorted
    again, so the work beyond the first words follows the repeats. Shared words come from the kept ranks, longest first.
    """
    n = len(symbols)
    levels = [(1, symbols.astype(np.int32))]
    for size in (2, 4, 6):
        left, right = levels[-1], levels[-1] if size < 6 else levels[1]
        levels.append((size, dense(left[1].astype(np.int64) * (n + 2) + shifted(right[1], left[0]) + 1)))
    size, rank = levels[-1]
    order = np.argsort(rank, kind="stable")
    held = rank[order]
    first = np.concatenate(([True], held[1:] != held[:-1]))
    at = np.flatnonzero(first)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(at, np.diff(np.append(at, n)))  # from here on the rank of a class is its first place
    levels[-1] = (size, rank.astype(np.int32))
    alone = first & np.concatenate((first[1:], [True]))
    slots = np.flatnonzero(~alone)  # places in the suffix array that are not settled
    while len(slots):
        member = order[slots]
        one, two = rank[member], shifted_at(rank, member + size)
        by = np.lexsort((two, one))
        member, one, two = member[by], one[by], two[by]
        order[slots] = member
        new = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
        rank = rank.copy()
        rank[member] = slots[np.flatnonzero(new)[np.cumsum(new) - 1]]
        size *= 2
        levels.append((size, rank.astype(np.int32)))
        slots = slots[~(new & np.concatenate((new[1:], [True])))]
    near = np.flatnonzero(~first)
    a, b = order[near - 1], order[near]
    shared = np.zeros(len(a), dtype=np.int64)
    for size, rank in reversed(levels):
        x, y = a + shared, b + shared
        inside = np.maximum(x, y) < n
        equal = np.zeros(len(a), dtype=bool)
        equal[inside] = rank[x[inside]] == rank[y[inside]]
        shared[equal] += size
    kept = shared >= least
    return a[kept], b[kept], shared[kept]


def shifted_at(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(rank), rank[np.minimum(at, len(rank) - 1)], -1)


class Positions:
    """An ordered set of positions in blocks, so that a new one moves a bounded part of a large set."""

    __slots__ = ("blocks", "lasts", "size")

    def __init__(self, position: int):
        self.blocks, self.lasts, self.size = [[position]], [position], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def beside(self, x: int) -> tuple[int, int]:
        """The members before and after ``x``; -1 where there is none."""
        k = bisect_left(self.lasts, x)
        if k == len(self.blocks):
            return self.lasts[-1], -1
        block = self.blocks[k]
        i = bisect_left(block, x)
        return block[i - 1] if i else self.lasts[k - 1] if k else -1, block[i]

    def add(self, x: int) -> None:
        k = min(bisect_left(self.lasts, x), len(self.blocks) - 1)
        block = self.blocks[k]
        block.insert(bisect_left(block, x), x)
        self.lasts[k] = block[-1]
        self.size += 1
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks[k:k + 1] = [block[:half], block[half:]]
            self.lasts[k:k + 1] = [block[half - 1], block[-1]]


def runs_of(symbols: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Maximal runs of ``symbols`` as ``(start, length, period)``, ordered.

    Positions whose suffixes share most words are united first. When two classes unite at a common prefix, their members
    that become neighbours in the ordered set share exactly that prefix; if they are no farther apart than it is long,
    the words between repeat, with that distance as smallest period. Of the seeds of a run the one that cannot be moved to
    the left is kept: it gives the start, and with the prefix the length.
    """
    least = max(6, -(-shortest // 2))  # a run of length period + prefix has period <= prefix
    a, b, shared = repeated_suffixes(symbols, least)
    by = np.argsort(-shared, kind="stable")
    words, root, held, out = symbols.tolist(), {}, {}, []

    def class_of(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while x != top:
            root[x], x = top, root.get(x, top)
        return top

    for x, y, prefix in zip(a[by].tolist(), b[by].tolist(), shared[by].tolist()):
        x, y = class_of(x), class_of(y)
        large, small = held.pop(x, None) or Positions(x), held.pop(y, None) or Positions(y)
        if large.size < small.size:
            x, y, large, small = y, x, small, large
        root[y], held[x] = x, large
        own = list(small)
        beside = [large.beside(p) for p in own]
        for k, (p, (before, after)) in enumerate(zip(own, beside)):
            if before >= 0 and p - before <= prefix and (not k or own[k - 1] < before):
                if not before or words[before - 1] != words[p - 1]:
                    out.append((before, p - before + prefix, p - before))
            if after >= 0 and after - p <= prefix and (k + 1 == len(own) or own[k + 1] > after):
                if not p or words[p - 1] != words[after - 1]:
                    out.append((p, after - p + prefix, after - p))
            large.add(p)
    return sorted(r for r in out if r[1] >= shortest)


def repeated_runs(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", shortest: int = SHORTEST) -> DataFrame:
    """Repeats within every description: ``gid, repeticiones, zona_desc``.

    ``repeticiones`` holds all maximal runs ``(inicio, largo, periodo)`` in words, by start, then period: stretches whose
    words a smallest period apart are equal, at least ``shortest`` words (twelve or more) and two periods long.
    ``zona_desc`` is the text without the words that a run holds after its first period, the rest joined by one blank.
    Null, empty and blank descriptions have no runs and an empty text. Null or repeated ids and equal rows are rows like
    any other; other columns are not read; an empty table gives an empty one. Each description is worked on whole.
    """
    if shortest < SHORTEST:
        raise ValueError("runs of fewer than twelve words are not sought")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, text_col, BATCH):
            words = [WORDS.findall(t) for t in texts_of(batch, text_col)]
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            starts = np.cumsum(sizes) - sizes
            known: dict[str, int] = {}
            word = np.array([known.setdefault(w, len(known)) for own in words for w in own], dtype=np.int64)
            owner = np.repeat(np.arange(len(words)), sizes)
            found = runs_of(dense(owner * (len(known) + 1) + word), shortest) if len(word) else []  # a word of another text is another symbol
            first, length, period = np.array(found, dtype=np.int64).reshape(-1, 3).T
            row = owner[first]
            change = np.zeros(len(word) + 1, dtype=np.int64)
            np.add.at(change, first + period, 1)
            np.add.at(change, first + length, -1)
            gone = np.cumsum(change)[:-1] > 0
            cuts = np.searchsorted(row, np.arange(len(words) + 1))
            runs = pa.StructArray.from_arrays([pa.array(c) for c in (first - starts[row], length, period)], fields=list(RUN))
            texts = [" ".join(own) if s == e else " ".join([w for w, out in zip(own, gone[at:at + len(own)].tolist()) if not out])
                     for own, at, s, e in zip(words, starts.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).cast(pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs), pa.array(texts, pa.string())],
                names=[id_col, "repeticiones", text_col])

    return features.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, repeticiones array<struct<inicio: long, largo: long, periodo: long>>, `{text_col}` string")
