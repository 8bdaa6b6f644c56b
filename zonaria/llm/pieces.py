"""SentencePiece encoding and decoding by suffix-array matching and relaxation, vectorised over a batch of texts."""
from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches, texts_of

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
LONGEST = 16
#: Distinct words whose ids a task keeps from batch to batch, and characters of new words that it matches at once.
KEPT_WORDS, MATCHED = 400_000, 1 << 18


def merge_order(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain pair merging: the neighbours whose union ranks first merge, leftmost first. Also the last pair merged."""
    symbols, last, never = list(symbols), None, 1 << 30
    ranks = [rank.get(a + b, never) for a, b in zip(symbols, symbols[1:])]
    while ranks and (best := min(ranks)) < never:
        i = ranks.index(best)
        last = symbols[i], symbols[i + 1]
        symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = rank.get(symbols[i - 1] + symbols[i], never)
        if i < len(ranks):
            ranks[i] = rank.get(symbols[i] + symbols[i + 1], never)
    return symbols, last


class PieceModel:
    """The vocabulary of a pair-merging model as arrays.

    ``order`` ranks the pieces by score; ``left`` and ``right`` are the two pieces that a piece is merged from (itself for a
    character); ``joins`` are the sorted pairs that merge. A sequence of pieces is the model's encoding exactly if each
    two neighbours are their own encoding, which :meth:`stays` tells from these tables.
    """

    def __init__(self, model: str = MODEL):
        import public_tokenizers
        import sentencepiece

        held = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
        size = held.vocab_size()
        self.bytes_at = next(i for i in range(size) if held.is_byte(i))
        self.text = [held.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (held.is_byte(i) or held.is_control(i) or held.is_unknown(i) or held.is_unused(i)) and self.text[i]]
        score = {i: held.get_score(i) for i in plain}
        plain.sort(key=lambda i: (-score[i], i))
        rank = {self.text[i]: k for k, i in enumerate(plain)}
        place = {self.text[i]: i for i in plain}
        self.order = np.zeros(size, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        reached, joins = [], []
        for k, i in enumerate(plain):
            self.order[i] = k
            if len(self.text[i]) == 1:
                reached.append(i)
                continue
            whole, last = merge_order(list(self.text[i]), rank)
            if whole == [self.text[i]] and last[0] in place and last[1] in place:
                self.left[i], self.right[i] = place[last[0]], place[last[1]]
                joins.append((self.left[i] << 32 | self.right[i], k))
                reached.append(i)
        joins.sort()
        self.join_keys = np.array([j for j, _ in joins], dtype=np.int64)
        self.join_rank = np.array([k for _, k in joins], dtype=np.int64)
        self.known = np.array(sorted({ord(self.text[i]) for i in reached if len(self.text[i]) == 1}), dtype=np.int64)
        chars, single = self.known, set(self.known.tolist())
        usable = [i for i in reached if len(self.text[i]) <= LONGEST and single.issuperset(map(ord, self.text[i]))]
        self.ids = np.array(usable, dtype=np.int64)
        self.lengths = np.array([len(self.text[i]) for i in usable], dtype=np.int64)
        table = np.zeros((len(usable), LONGEST), dtype=np.uint16)
        for k, i in enumerate(usable):
            table[k, : self.lengths[k]] = np.searchsorted(chars, [ord(c) for c in self.text[i]]) + 1
        self.low = _keys(table)
        filled = table.copy()
        filled[np.arange(LONGEST)[None, :] >= self.lengths[:, None]] = 0xFFFF
        self.high = _keys(filled)

    def stays(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces ``a`` and ``b`` side by side are left as they are, for arrays of pairs.

        Undoes the later merge on the seam step by step: if a pair across the seam would have merged before the merge
        that was undone, the pieces do not stay.
        """
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << 40)
        out = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            keys = x << 32 | y
            at = np.minimum(np.searchsorted(self.join_keys, keys), max(len(self.join_keys) - 1, 0))
            merges = (self.join_keys[at] == keys) & (self.join_rank[at] < limit[live]) if len(self.join_keys) else np.zeros(len(live), bool)
            out[live[merges]] = False
            live, x, y = live[~merges], x[~merges], y[~merges]
            split_x, split_y = self.left[x] != x, self.left[y] != y
            go = split_x | split_y
            live, x, y, split_x, split_y = live[go], x[go], y[go], split_x[go], split_y[go]
            first = split_x & (~split_y | (self.order[x] > self.order[y]))
            limit[live] = np.where(first, self.order[x], self.order[y] + 1)
            a[live] = np.where(first, self.right[x], x)
            b[live] = np.where(first, y, self.left[y])
        return out


def _keys(table: np.ndarray) -> list[np.ndarray]:
    """Columns of sixteen characters as four numbers that sort alike."""
    wide = table.astype(np.uint64)
    return [wide[:, k] << np.uint64(48) | wide[:, k + 1] << np.uint64(32) | wide[:, k + 2] << np.uint64(16) | wide[:, k + 3] for k in range(0, LONGEST, 4)]


def _bounds(sorted_keys: list[np.ndarray], wanted: list[np.ndarray], above: bool) -> np.ndarray:
    """Binary search of all ``wanted`` keys at once: the first place not below (or, ``above``, beyond) each."""
    n = len(sorted_keys[0])
    low, high = np.zeros(len(wanted[0]), dtype=np.int64), np.full(len(wanted[0]), n, dtype=np.int64)
    for _ in range(max(1, int(n).bit_length())):
        mid = np.minimum((low + high) >> 1, n - 1)
        less = np.zeros(len(mid), dtype=bool)
        tied = np.ones(len(mid), dtype=bool)
        for have, want in zip(sorted_keys, wanted):
            value = have[mid]
            less |= tied & (value < want)
            tied &= value == want
        less |= tied if above else False
        open_ = low < high
        low = np.where(open_ & less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    return low


def suffix_order(quads: np.ndarray, n: int) -> np.ndarray:
    """Suffix array by the first sixteen characters: ranks of four are paired to ranks of eight, those to sixteen."""
    key, step = quads, 4
    while True:
        order = np.argsort(key[:n])
        if step == LONGEST:
            return order
        held = key[order]
        rank = np.zeros(n + LONGEST, dtype=np.uint64)
        rank[order] = np.cumsum(np.concatenate(([True], held[1:] != held[:-1]))).astype(np.uint64)
        key = rank[:n] << np.uint64(32) | rank[step:step + n]
        step *= 2


def encode_words(model: PieceModel, words: list[str]) -> list[list[int]]:
    """Ids of each word: all occurrences of all pieces from the suffix array of the words put one after another, sorted by
    where they end, then relaxed from left to right; the piece that ends a prefix is the one its predecessor leaves alone."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    points = np.frombuffer("\x00".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    n = len(points)
    at = np.minimum(np.searchsorted(model.known, points), len(model.known) - 1)
    symbol = np.where(model.known[at] == points, at + 1, 0)
    padded = np.concatenate((symbol, np.zeros(LONGEST, dtype=np.int64))).astype(np.uint64)
    quads = np.zeros(n + LONGEST, dtype=np.uint64)
    quads[:n + LONGEST - 3] = padded[:-3] << np.uint64(48) | padded[1:-2] << np.uint64(32) | padded[2:-1] << np.uint64(16) | padded[3:]
    suffixes = suffix_order(quads, n)
    ordered = [quads[suffixes + k] for k in range(0, LONGEST, 4)]
    first, last = _bounds(ordered, model.low, False), _bounds(ordered, model.high, True)
    times = last - first
    where = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
    start = suffixes[where]
    piece = np.repeat(model.ids, times)
    end = start + np.repeat(model.lengths, times)
    del ordered, quads, padded, suffixes, where
    # Fresh starts: the first character of a word and any behind a character without a piece.
    fresh = np.concatenate(([True], symbol[:-1] == 0))
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) if n else np.zeros(0, np.int64)
    level = end - run_start[start]
    by = np.argsort(level, kind="stable")
    start, end, piece, level = start[by], end[by], piece[by], level[by]
    cuts = np.searchsorted(level, np.arange(1, (int(level[-1]) if len(level) else 0) + 2))
    ending = np.full(n + 1, -1, dtype=np.int64)  # piece that ends the encoding of the run up to here
    began = np.zeros(n + 1, dtype=np.int64)
    for s, e in zip(cuts[:-1], cuts[1:]):
        before, own, to = ending[start[s:e]], piece[s:e], end[s:e]
        free = fresh[start[s:e]]
        ok = free.copy()
        pairs, back = np.unique((before << 32 | own)[~free], return_inverse=True)
        ok[~free] = model.stays(pairs >> 32, pairs & 0xFFFFFFFF)[back] if len(pairs) else False
        if not len(pairs) or level[s] <= LONGEST:  # a run that is one piece as a whole
            ok |= free
        ending[to[ok]] = own[ok]
        began[to[ok]] = start[s:e][ok]
    out = []
    at = 0
    for word, size in zip(words, sizes.tolist()):
        ids: list[int] = []
        here = at + size
        while here > at:
            if symbol[here - 1] == 0:
                ids.extend(model.bytes_at + b for b in reversed(word[here - 1 - at].encode("utf-8", "surrogatepass")))
                here -= 1
            else:
                ids.append(int(ending[here]))
                here = int(began[here])
        out.append(ids[::-1])
        at += size + 1
    return out


WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Encoder:
    """Encodes texts; ids of words met before are kept for the task, up to a bound."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.seen: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = [WORDS.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.seen) > KEPT_WORDS:
            self.seen.clear()
        new = list({w for own in split for w in own if w not in self.seen})
        group, held = [], 0
        for k, word in enumerate(new):
            group.append(word)
            held += len(word)
            if held > MATCHED or k + 1 == len(new):
                self.seen.update(zip(group, (struct.pack(f"<{len(ids)}I", *ids) for ids in encode_words(self.model, group))))
                group, held = [], 0
        return [b"".join(map(self.seen.__getitem__, own)) for own in split]


def encode_texts(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", model: str = MODEL) -> DataFrame:
    """Piece ids of every description: ``gid, ids`` (little-endian unsigned 32-bit numbers).

    The ids are those of the model's own encoder: a blank is put before the text, blanks become the visible space, a
    character without a piece becomes one id for each byte. Null and empty descriptions have no ids. Null or repeated
    ids and equal rows are rows like any other; other columns are not read; an empty table gives an empty one.
    """
    held = PieceModel(model)  # a few MB of tables, fixed by the vocabulary, sent with the plan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held)
        for batch in text_batches(batches, text_col):
            ids = encoder(texts_of(batch, text_col))
            yield pa.RecordBatch.from_arrays([batch.column(id_col).cast(pa.int64()), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    return features.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, ids binary")


def decode_texts(encoded: DataFrame, ids_col: str = "ids", text_col: str = "zona_desc", model: str = MODEL) -> DataFrame:
    """``encoded`` with the texts behind ``ids`` as ``zona_desc``; null ids count as none. Bytes that are no UTF-8 become
    U+FFFD, ids of control pieces nothing. Visible spaces become blanks, the one put in front goes."""
    held = PieceModel(model)
    first = held.bytes_at
    raw = [t.replace(SPACE, " ").encode("utf-8") for t in held.text]
    raw[:first] = [b""] * first
    raw[first:first + 256] = [bytes([b]) for b in range(256)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for ids in batch.column(ids_col).to_pylist():
                text = b"".join(map(raw.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist())).decode("utf-8", "replace")
                texts.append(text[1:] if text.startswith(" ") else text)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, `{text_col}` string")
