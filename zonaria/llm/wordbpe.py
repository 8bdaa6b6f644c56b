"""BPE encoding and decoding by speculation: longest matches are proposed, pairs of neighbours verified, the rest merged."""
from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches, texts_of

MODEL = "word_bpe_49k.json"
#: Ends every word in the tables here; no byte is written as this character.
END = "\n"
NEVER = 1 << 40
#: Characters up to which a plain search for the lowest rank is faster than a heap.
SHORT = 48
#: Distinct words whose ids a task keeps from batch to batch.
KEPT_WORDS = 200_000
#: Bytes of ids that are decoded at once.
DECODED = 1 << 20


def ranges_of(held: np.ndarray) -> str:
    """The code points that are true in ``held`` as the inside of a character class."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], held.astype(np.int8), [0]))))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()))


def vocabulary(model: str) -> tuple[dict, list[str]]:
    """The vocabulary file and its tokens as they are written, by id (empty for unused ids)."""
    import public_tokenizers

    with open(model if "/" in model else public_tokenizers.path(model), encoding="utf-8") as file:
        held = json.load(file)
    ids = held["model"]["vocab"] | {t["content"]: t["id"] for t in held["added_tokens"]}
    names = [""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        names[i] = token
    return held, names


class WordBpe:
    """A vocabulary of the ``tokenizers`` library (lower-cased words, byte-level pair merging with word ends) as tables.

    Character classes and lower case are asked of the library once, so that they are those of its version of Unicode.
    ``id_of`` holds the tokens that merging can reach; ``left``, ``right`` and ``time`` say from which tokens, and by which
    merge, each was made; ``joins`` are all merges as sorted pairs.
    """

    def __init__(self, model: str = MODEL):
        from tokenizers import Regex, normalizers

        held, self.name = vocabulary(model)
        kinds = [n["type"] for n in held["normalizer"]["normalizers"]]
        split, level = held["pre_tokenizer"]["pretokenizers"]
        bpe = held["model"]
        suffix = bpe["end_of_word_suffix"]
        if (kinds != ["NFC", "Replace", "Lowercase"] or not (split["invert"] and split["behavior"] == "Removed") or level["add_prefix_space"] or not suffix
                or bpe["dropout"] or bpe["ignore_merges"] or held["decoder"] or held["post_processor"]):
            raise ValueError(f"{model} is not a vocabulary of lower-cased words with word ends")
        self._text(split["pattern"]["Regex"], [t["content"] for t in held["added_tokens"]], Regex, normalizers)
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self._merges(bpe["vocab"], bpe["merges"], suffix)

    def _text(self, pattern: str, special: list[str], Regex, normalizers) -> None:
        points = [i for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
        every = "".join(map(chr, points))

        def members(kind: str) -> np.ndarray:
            held = np.zeros(0x110000, dtype=bool)
            marked = normalizers.Replace(Regex(kind), "\x00").normalize_str(every)
            held[points] = np.frombuffer(marked.encode("utf-32-le"), dtype="<u4") == 0
            return held

        classes = {kind: members(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")}
        # The same pattern for texts below each bound: small classes are matched several times faster.
        self.words = []
        for bound in (0x80, 0x100, 0x10000, 0x110000):
            own = pattern
            for kind, held in classes.items():
                own = own.replace(kind, ranges_of(held[:bound]))
            self.words.append((re.compile(f"[^\0-\\U{bound - 1:08x}]"), re.compile(own)))
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        lowered = normalizers.Lowercase()
        self.lower = {i: low for i in points if (low := lowered.normalize_str(chr(i))) != chr(i).lower()}
        self.lower[ord("Σ")] = "σ"  # the library looks at single characters, Python at the end of the word
        self.odd = re.compile("[" + "".join(map(chr, self.lower)) + "]")

    def _merges(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        whole = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        self.alphabet = {b: chr(b) for b in whole} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(whole)))}
        own = {c + s: c + (END if s else "") for c in self.alphabet.values() for s in ("", suffix)}
        size = len(self.name)
        self.left, self.right, self.time = np.arange(size), np.arange(size), np.full(size, -1)
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        for k, (a, b) in enumerate(pairs):
            own.setdefault(a + b, own[a] + own[b])
            self.rank.setdefault((vocab[a], vocab[b]), k)
            self.made.append(vocab[a + b])
        self.base = {own[c]: vocab[c] for c in own if len(own[c].rstrip(END)) == 1}
        self.id_of = dict(self.base)
        for token, text in own.items():
            if text not in self.base:
                ids, last = self.merged(text)
                if ids == [vocab[token]]:
                    self.id_of[text] = vocab[token]
                    self.time[ids[0]], self.left[ids[0]], self.right[ids[0]] = last
        for (a, b), k in self.rank.items():
            if max(self.time[a], self.time[b]) >= k:
                raise ValueError("a merge comes before the merges of its parts")
        keys = sorted((a << 32 | b, k) for (a, b), k in self.rank.items())
        self.join_keys, self.join_rank = (np.array(c, dtype=np.int64) for c in zip(*keys))
        self.text_of = {i: text for text, i in self.id_of.items()}

    def split(self, text: str) -> list[str]:
        """The words of ``text`` as the library makes them, without special tokens."""
        if text.isascii():
            return self.words[0][1].findall(text.lower())
        if not unicodedata.is_normalized("NFC", text):
            from tokenizers import normalizers

            text = normalizers.NFC().normalize_str(text)
        if self.odd.search(text):
            text = text.translate(self.lower)
        text = text.lower()
        return next(words for beyond, words in self.words if not beyond.search(text)).findall(text)

    def written(self, word: str) -> str:
        """``word`` in the byte alphabet with its end."""
        return word.encode("utf-8").decode("latin-1").translate(self.alphabet) + END

    def matcher(self):
        """Finds the longest token from left to right, in one pass over any number of words."""
        from ahocorasick import Automaton

        found = Automaton()
        for text, i in self.id_of.items():
            found.add_word(text, (i, len(text)))
        found.make_automaton()
        return found

    def proposed(self, texts: list[str], matcher) -> tuple[np.ndarray, np.ndarray]:
        """The longest tokens from left to right of all ``texts``, and to which text each belongs. Where the last one leaves
        the end of the word over, the longest that take it along stand for it."""
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends, flat, at = [], [], -1
        for end, (i, size) in matcher.iter_long("".join(texts)):
            if end - size > at:  # the end of a word was passed over
                self._close(flat, ends, at + 1)
            flat.append(i)
            ends.append(end)
            at = end
        if at < sum(map(len, texts)) - 1:
            self._close(flat, ends, at + 1)
        last = np.cumsum([len(t) for t in texts]) - 1
        return np.array(flat, dtype=np.int64), np.searchsorted(last, np.array(ends, dtype=np.int64))

    def _close(self, flat: list[int], ends: list[int], end: int) -> None:
        ends.pop()
        text, at = self.text_of[flat.pop()] + END, 0
        while at < len(text):
            to = next(to for to in range(len(text), at, -1) if to != len(text) - 1 and text[at:to] in self.id_of)
            flat.append(self.id_of[text[at:to]])
            ends.append(end - len(text) + to)
            at = to

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves the tokens ``a`` and ``b`` side by side, for arrays of pairs.

        Goes back in time over the tokens at the seam, the later one undone first. A merge across the seam that comes
        before its left part was used up on the left, and not after its right part was on the right, breaks the pair.
        """
        x, y = a.copy(), b.copy()
        gone_x, gone_y = np.full(len(x), NEVER), np.full(len(x), NEVER)
        out, live = np.ones(len(x), dtype=bool), np.arange(len(x))
        while len(live):
            keys = x << 32 | y
            at = np.minimum(np.searchsorted(self.join_keys, keys), len(self.join_keys) - 1)
            rank = np.where(self.join_keys[at] == keys, self.join_rank[at], NEVER)
            broken = (rank < gone_x) & (rank <= gone_y) & (rank < NEVER)
            out[live[broken]] = False
            go = ~broken & (np.maximum(self.time[x], self.time[y]) >= 0)
            x, y, gone_x, gone_y, live = x[go], y[go], gone_x[go], gone_y[go], live[go]
            back = self.time[x] > self.time[y]
            gone_x, gone_y = np.where(back, self.time[x], gone_x), np.where(back, gone_y, self.time[y])
            x, y = np.where(back, self.right[x], x), np.where(back, y, self.left[y])
        return out

    def merged(self, word: str) -> tuple[list[int], tuple[int, int, int] | None]:
        """Exact merging: the pair of lowest rank first, the leftmost of equals. Also the last merge ``(rank, left, right)``.
        In long words pairs wait in a heap and tokens are a linked list, so that they cost n log n."""
        base, rank, made, last = self.base, self.rank, self.made, None
        ids = [base[c] for c in word.rstrip(END)]
        if word.endswith(END):
            ids[-1] = base[word[-2:]]
        if len(ids) <= SHORT:
            ranks = [rank.get(p, NEVER) for p in zip(ids, ids[1:])]
            while ranks and (best := min(ranks)) < NEVER:
                i, new = ranks.index(best), made[best]
                last = best, ids[i], ids[i + 1]
                ids[i:i + 2] = [new]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get((ids[i - 1], new), NEVER)
                if i < len(ranks):
                    ranks[i] = rank.get((new, ids[i + 1]), NEVER)
            return ids, last
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(k, i, ids[i], ids[i + 1]) for i in range(n - 1) if (k := rank.get((ids[i], ids[i + 1]), NEVER)) < NEVER]
        heapq.heapify(heap)
        while heap:
            k, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            last, new = (k, a, b), made[k]
            ids[i], ids[j] = new, -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (k := rank.get((new, ids[j]), NEVER)) < NEVER:
                    heapq.heappush(heap, (k, i, new, ids[j]))
            if (p := before[i]) >= 0 and (k := rank.get((ids[p], new), NEVER)) < NEVER:
                heapq.heappush(heap, (k, p, ids[p], new))
        return [i for i in ids if i >= 0], last

    def encode_words(self, words: list[str], matcher) -> list[bytes]:
        """Ids of each word. Proposals of all words are checked at once; words with a broken pair are merged exactly."""
        texts = [self.written(w) for w in words]
        flat, owner = self.proposed(texts, matcher)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, back = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        wrong = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)[back] if len(pairs) else np.zeros(0, bool)
        packed = flat.astype("<u4").tobytes()
        cuts = (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        out = [packed[s:e] for s, e in zip(cuts, cuts[1:])]
        for k in np.unique(owner[inside[wrong]]).tolist():
            ids = self.merged(texts[k])[0]
            out[k] = struct.pack(f"<{len(ids)}I", *ids)
        return out


class Encoder:
    """Encodes texts; ids of words met before are kept for the task, up to a bound."""

    def __init__(self, model: WordBpe):
        self.model = model
        self.matcher = model.matcher()
        self.seen: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        model = self.model
        special = {s: np.array([i], dtype="<u4").tobytes() for s, i in model.special.items()}
        split = []
        for text in texts:
            if "<|" in text:  # special tokens are found in the raw text; what stands between them is normalised by itself
                split.append([p for k, part in enumerate(model.special_at.split(text)) for p in ([special[part]] if k % 2 else model.split(part))])
            else:
                split.append(model.split(text))
        if len(self.seen) > KEPT_WORDS:
            self.seen.clear()
        new = list({w for own in split for w in own if w not in self.seen and isinstance(w, str)})
        self.seen.update(zip(new, model.encode_words(new, self.matcher)))
        self.seen.update((i, i) for i in special.values())
        return [b"".join(map(self.seen.__getitem__, own)) for own in split]


def encode_words(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", model: str = MODEL) -> DataFrame:
    """Token ids of every description: ``gid, ids`` (little-endian unsigned 32-bit numbers).

    The ids are those of the ``tokenizers`` library without added special tokens, truncation or padding; special tokens
    that stand in a text get their own ids. Null and empty descriptions, and those of white space alone, have no ids.
    Null or repeated ids and equal rows are rows like any other; other columns are not read; an empty table gives an
    empty one. Words of any length are merged in n log n.
    """
    held = WordBpe(model)  # a few MB of tables, fixed by the vocabulary, sent with the plan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held)
        for batch in text_batches(batches, text_col):
            ids = encoder(texts_of(batch, text_col))
            yield pa.RecordBatch.from_arrays([batch.column(id_col).cast(pa.int64()), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    return features.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, ids binary")


def decode_words(encoded: DataFrame, ids_col: str = "ids", text_col: str = "zona_desc", model: str = MODEL) -> DataFrame:
    """``encoded`` with the texts behind ``ids`` as ``zona_desc``. The vocabulary names no decoder, so a text is the written
    tokens (bytes as characters, word ends spelled out) with one blank between, special tokens included. Null ids count
    as none; an id beyond the vocabulary raises an error, an unused one is left out."""
    _, names = vocabulary(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, ids_col, DECODED):
            texts = [" ".join([t for t in map(names.__getitem__, np.frombuffer(ids or b"", dtype="<u4").tolist()) if t]) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, `{text_col}` string")
