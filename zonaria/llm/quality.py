"""Quality rules for zone descriptions: repetition and length, and how well public vocabularies take the text."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches, texts_of
from .packing import VOCABULARY, byte_encoder

PIECES = "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20
#: So many tokens let a text reach all the entropy that is asked of it; a longer text is held to no more.
RICH = 1_024

# Per script the lowest and highest letters per token, the highest share of bytes without a piece, and the
# lowest token entropy as a share of what the number of tokens allows. The bands are wide: prose of any language that the
# vocabularies cover lies well inside; encoded data, words strewn with symbols, byte noise and a few tokens over and over
# lie outside.
BANDS = {
    "latin": (1.40, 12.0, 0.20, 0.35),
    "cyrillic": (0.50, 8.0, 0.30, 0.35),
    "greek": (0.40, 8.0, 0.60, 0.35),
    "semitic": (0.35, 8.0, 0.60, 0.35),
    "indic": (0.20, 8.0, 0.95, 0.30),
    "han_kana": (0.25, 6.0, 0.80, 0.30),
    "hangul": (0.25, 6.0, 0.90, 0.30),
    "other": (0.20, 12.0, 1.00, 0.30),
}
#: Upper ends of code point ranges and the script of each; letters alone are counted.
RANGES = (
    (0x40, None), (0x5A, "latin"), (0x60, None), (0x7A, "latin"), (0xBF, None), (0x24F, "latin"), (0x36F, None), (0x3FF, "greek"),
    (0x52F, "cyrillic"), (0x58F, "other"), (0x7FF, "semitic"), (0x8FF, "semitic"), (0xDFF, "indic"), (0x10FF, "other"),
    (0x11FF, "hangul"), (0x1DFF, "other"), (0x1EFF, "latin"), (0x1FFF, "greek"), (0x2E7F, None), (0x303F, None), (0x30FF, "han_kana"),
    (0x318F, "hangul"), (0xABFF, "han_kana"), (0xD7FF, "hangul"), (0xF8FF, None), (0xFAFF, "han_kana"), (0x10FFFF, "other"),
)
SCRIPTS = tuple(BANDS)
_ENDS = np.array([end for end, _ in RANGES])
_KINDS = np.array([SCRIPTS.index(s) if s else -1 for _, s in RANGES])


def piece_characters(model: str = PIECES) -> np.ndarray:
    """Sorted code points that the piece vocabulary has; any other becomes one token for each byte."""
    import public_tokenizers
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=model if "/" in model else public_tokenizers.path(model))
    return np.array(sorted({ord(p) for i in range(pieces.vocab_size()) if len(p := pieces.id_to_piece(i)) == 1 and not pieces.is_control(i)}))


def repeated(owner: np.ndarray, ids: np.ndarray, width: int, rows: int) -> np.ndarray:
    """Words per row that stand in a window of ``width`` words found twice or more in that row."""
    out = np.zeros(rows, dtype=np.int64)
    n = len(ids) - width + 1
    if n <= 0:
        return out
    code = np.zeros(n, dtype=np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    for k in range(width):
        code = code * np.uint64(0x94D049BB133111EB) + mixed[k:k + n]
    whole = np.flatnonzero(owner[:n] == owner[width - 1:])
    code = (code[whole] * np.uint64(0x9E3779B97F4A7C15)) ^ ((owner[whole].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
    by = np.argsort(code)
    same = code[by][1:] == code[by][:-1]
    twice = np.zeros(len(code), dtype=bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    depth = np.zeros(len(ids) + 1, dtype=np.int64)
    at = whole[twice]
    np.add.at(depth, at, 1)
    np.add.at(depth, at + width, -1)
    covered = np.cumsum(depth[:-1]) > 0
    return np.bincount(owner[covered], minlength=rows)


class Measures:
    """The vocabularies of one task, and the figures of a batch of texts. Words are tokenised once per batch."""

    def __init__(self, vocabulary: str = VOCABULARY, model: str = PIECES):
        self.encoder = byte_encoder(vocabulary)
        self.known = piece_characters(model)

    def tokens(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of each word behind a space, one after another, and how many each has."""
        each = [self.encoder.encode_ordinary(" " + w.decode()) for w in words]
        return np.array([t for own in each for t in own], dtype=np.int64), np.array([len(own) for own in each], dtype=np.int64)

    def of(self, texts: list[str]) -> dict[str, np.ndarray]:
        rows = len(texts)
        raw = [t.encode() for t in texts]
        split = [t.split() for t in raw]
        n_words = np.array([len(w) for w in split], dtype=np.int64)
        owner = np.repeat(np.arange(rows), n_words)
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for own in split for w in own], dtype=np.int64)
        distinct = list(number)
        texts_of_words = [w.decode() for w in distinct]
        chars = np.array([len(w) for w in texts_of_words], dtype=np.int64)
        points = np.frombuffer("".join(texts_of_words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        word_of = np.repeat(np.arange(len(distinct)), chars)
        lost = ~np.isin(points, self.known)
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        lost_bytes = np.bincount(word_of, weights=lost * width, minlength=len(distinct))
        all_bytes = np.bincount(word_of, weights=width, minlength=len(distinct))
        script = _KINDS[np.searchsorted(_ENDS, points)]
        letters = np.zeros((len(distinct), len(SCRIPTS)))
        np.add.at(letters, (word_of[script >= 0], script[script >= 0]), 1)

        def total(values: np.ndarray) -> np.ndarray:
            return np.bincount(owner, weights=values[ids], minlength=rows) if len(ids) else np.zeros(rows)

        flat, each = self.tokens(distinct)
        starts = np.cumsum(each) - each
        n_tokens = total(each)
        of_word = each[ids]
        at = np.repeat(starts[ids] - (np.cumsum(of_word) - of_word), of_word) + np.arange(of_word.sum())
        pairs = np.repeat(owner, of_word) * (1 << 17) + flat[at]
        pairs, count = np.unique(pairs, return_counts=True)
        row = pairs >> 17
        share = count / np.maximum(n_tokens, 1)[row]
        entropy = -np.bincount(row, weights=share * np.log2(share), minlength=rows).astype(np.float64)  # of no tokens: integers
        by_script = np.stack([total(letters[:, k]) for k in range(len(SCRIPTS))], axis=1)
        return {
            "n_words": n_words,
            "word_chars": total(chars).astype(np.int64),
            "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in raw], dtype=np.int64),
            "n_dup_lines": np.array([_repeated_lines(t) for t in texts], dtype=np.int64),
            "n_repeat_words": repeated(owner, ids, WINDOW, rows),
            "chars_per_token": total(letters.sum(axis=1)) / np.maximum(n_tokens, 1),
            "byte_share": total(lost_bytes) / np.maximum(total(all_bytes), 1),
            "entropy": entropy,
            "entropy_share": entropy / np.log2(np.clip(n_tokens, 2, RICH)),
            "script": np.where(by_script.sum(axis=1) > 0, by_script.argmax(axis=1), SCRIPTS.index("other")),
        }


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.encode().split(b"\n") if line.split()] if "\n" in text else ()
    return len(lines) - len(set(lines))


def passes(m: dict[str, np.ndarray]) -> np.ndarray:
    """The first rule that each text of a batch breaks, empty for none."""
    low, high, most_bytes, least = (np.array([BANDS[s][k] for s in SCRIPTS])[m["script"]] for k in range(4))
    return np.select(
        [failed(m), m["chars_per_token"] < low, m["chars_per_token"] > high, m["byte_share"] > most_bytes, m["entropy_share"] < least],
        ["base", "short_tokens", "long_tokens", "bytes", "entropy"], "")


def failed(m: dict[str, np.ndarray]) -> np.ndarray:
    """The base rules: too few words, or too many of them in repeated windows."""
    return (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])


def accepted(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", vocabulary: str = VOCABULARY, model: str = PIECES) -> DataFrame:
    """The features whose description :func:`rated` keeps, with all their columns; no row is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures(vocabulary, model)
        for batch in text_batches(batches, text_col):
            yield batch.filter(pa.array(passes(measures.of(texts_of(batch, text_col))) == ""))

    return features.mapInArrow(run, features.schema)


def rated(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", vocabulary: str = VOCABULARY, model: str = PIECES) -> DataFrame:
    """Every description with its figures and the verdict ``kept``.

    ``gid``; of the words (runs of anything but ASCII white space) ``n_words``, ``word_chars``; ``n_symbols`` of
    ``#*$%&|<>``; ``n_dup_lines``, lines with a word that equal an earlier line; ``n_repeat_words``, words in windows of
    five found twice or more; ``base_failed`` for under ten words or over 20 % repeated words. Then the fertility of
    public vocabularies: ``chars_per_token`` (letters, as symbols and digits make tokens of their own) and ``entropy`` (bits; ``entropy_share`` of the most possible) of the byte-level
    vocabulary's tokens of the words, ``byte_share`` of the bytes for which the piece vocabulary has no piece, and the
    ``script`` of most letters, whose bands (``BANDS``) a kept description fits. ``reason`` names the first rule broken.

    Null and empty descriptions have no words and fail the base rules. Null or repeated ids and equal rows are rows like
    any other; other columns are not read; an empty table gives an empty one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measures = Measures(vocabulary, model)
        for batch in text_batches(batches, text_col):
            m = measures.of(texts_of(batch, text_col))
            why, base = passes(m), failed(m)
            script = m.pop("script")
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).cast(pa.int64()), *[pa.array(v) for v in m.values()], pa.array([SCRIPTS[s] for s in script], pa.string()), pa.array(base),
                 pa.array(why == ""), pa.array([w or None for w in why.tolist()], pa.string())],
                names=[id_col, *m, "script", "base_failed", "kept", "reason"])

    return features.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars_per_token double, "
             "byte_share double, entropy double, entropy_share double, script string, base_failed boolean, kept boolean, reason string")
