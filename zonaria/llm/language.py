"""Language of zone descriptions: nearest of several centroids per language over TF-IDF weighted character n-grams."""
from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, texts_of

#: Hashed n-gram features (pairs and triples of characters), centroids per language, and the bound on the labelled rows
#: from which the centroids of one language are fitted. Document frequencies come from all labelled rows.
FEATURES, CENTROIDS, SAMPLE = 8_192, 3, 600
ROUNDS = 12
#: A text farther from its centroid than this quantile of the fitted texts, stretched, is marked as rejected.
QUANTILE, STRETCH = 0.99, 1.25
BATCH = 1 << 20
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Inverse document frequencies, unit centroids with their languages, and the farthest accepted distance of each."""

    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    reach: np.ndarray


def letters_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.frombuffer(bytes(chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=np.uint8).astype(bool)


def counts_of(texts: list[str], letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-gram counts of each text (lower case; everything but letters is one blank), and whether it has a letter."""
    rows = len(texts)
    lowered = [f" {t.lower()} " for t in texts]
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    known = letter[points]
    owner = np.repeat(np.arange(rows, dtype=np.int64), sizes)
    some = np.bincount(owner[known], minlength=rows) > 0
    kept = known | np.concatenate(([True], known[:-1]))  # of a run of blanks only the first stays
    points, owner = np.where(known, points, 32)[kept].astype(np.uint32), owner[kept]
    out = np.zeros((rows, FEATURES), dtype=np.float32)
    half = FEATURES // 2
    if len(points) > 2:
        pair = points[:-1] * np.uint32(0x9E3779B1) + points[1:] * np.uint32(0x85EBCA77)
        triple = pair[:-1] * np.uint32(0xC2B2AE3D) + points[2:] * np.uint32(0x27D4EB2F)
        for code, width, base in ((pair, 1, 0), (triple, 2, half)):
            code = ((code ^ (code >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - half.bit_length() + 1)).astype(np.int64) + base
            inside = owner[:-width] == owner[width:]
            out += np.bincount((owner[:-width] * FEATURES + code)[inside], minlength=rows * FEATURES).reshape(rows, FEATURES)
    return out, some


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts times inverse document frequency."""
    vectors = np.log1p(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def document_frequencies(examples: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all ``examples`` each feature occurs: tasks send one row per feature, whatever their rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, total = letters_table(), np.zeros(FEATURES + 1, dtype=np.int64)
        for batch in text_batches(batches, text_col, BATCH):
            counts, some = counts_of(texts_of(batch, text_col), letter)
            total[:-1] += (counts[some] > 0).sum(axis=0)
            total[-1] += some.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1)), pa.array(total)], names=["feature", "n"])

    rows = examples.select(text_col).mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(FEATURES + 1, dtype=np.int64)
    for row in rows:
        out[row.feature] = row.n
    return out[:-1], int(out[-1])


def fitted(vectors: np.ndarray, centroids: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the vectors farthest apart: unit centroids, and the distance each accepts."""
    centre = vectors.mean(axis=0)
    chosen = [centre / max(np.linalg.norm(centre), 1e-12)]
    while len(chosen) < min(centroids, len(vectors)):
        near = np.max(vectors @ np.array(chosen).T, axis=1)
        chosen.append(vectors[int(np.argmin(near))])
    middle = np.array(chosen, dtype=np.float32)
    for _ in range(ROUNDS):
        nearest = np.argmax(vectors @ middle.T, axis=1)
        sums = np.array([vectors[nearest == k].sum(axis=0) if (nearest == k).any() else middle[k] for k in range(len(middle))])
        moved = (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        if np.allclose(moved, middle, atol=1e-6):
            break
        middle = moved
    likeness = vectors @ middle.T
    nearest = np.argmax(likeness, axis=1)
    apart = 1 - likeness[np.arange(len(vectors)), nearest]
    reach = np.array([STRETCH * np.quantile(apart[nearest == k], QUANTILE) if (nearest == k).any() else 1.0 for k in range(len(middle))])
    return middle, reach.astype(np.float64)


def learn(examples: DataFrame, text_col: str = "zona_desc", label_col: str = "idioma", centroids: int = CENTROIDS, sample: int = SAMPLE) -> LanguageModel:
    """Fit the model on labelled descriptions; rows without a label or a letter teach nothing.

    Document frequencies cover all rows. The centroids of a language are fitted on about ``sample`` of its rows, chosen
    by a hash of the text's checksum and length, so that a language with a third of all rows costs no more than another.
    """
    known = examples.where(F.col(label_col).isNotNull()).select(F.col(label_col).alias("idioma"), F.col(text_col).alias("texto"))
    frequency, rows = document_frequencies(known, "texto")
    idf = (np.log((1 + rows) / (1 + frequency)) + 1).astype(np.float32)
    share = known.groupBy("idioma").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    shares = {r.idioma: min(1.0, r.share) for r in share.collect()}
    if not shares:
        return LanguageModel(idf, np.zeros((0, FEATURES), np.float32), [], np.zeros(0))
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "texto"), F.lit(1_000_000))
    wanted = F.element_at(F.create_map(*[F.lit(x) for kv in shares.items() for x in kv]), F.col("idioma"))
    some = known.where(drawn < wanted * 1_000_000).distinct()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters_table()
        for batch in text_batches(batches, "texto", BATCH):
            counts, good = counts_of(texts_of(batch, "texto"), letter)
            made = weighted(counts, idf)
            at = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([batch.column("idioma").take(pa.array(at)), pa.array([made[i].tobytes() for i in at], pa.binary())], names=["idioma", "vector"])

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        held = np.array([np.frombuffer(v, dtype=np.float32) for v in sorted(set(table.column("vector").to_pylist()))])
        middle, reach = fitted(held, centroids)
        return pa.table({"idioma": [key[0].as_py()] * len(middle), "centroid": pa.array([m.tobytes() for m in middle], pa.binary()), "reach": reach})

    fits = some.mapInArrow(vectors, "idioma string, vector binary").groupBy("idioma").applyInArrow(fit, "idioma string, centroid binary, reach double").collect()
    fits.sort(key=lambda r: (r.idioma, r.centroid))
    return LanguageModel(idf, np.array([np.frombuffer(r.centroid, dtype=np.float32) for r in fits]).reshape(-1, FEATURES), [r.idioma for r in fits], np.array([r.reach for r in fits]))


def identify(features: DataFrame, model: LanguageModel, id_col: str = "gid", text_col: str = "zona_desc") -> DataFrame:
    """Language of every description: ``gid, idioma, score, distance, rejected``.

    ``idioma`` is the language of the nearest centroid by cosine, ``score`` the cosine held to 0..1, ``distance`` one minus
    the cosine, and ``rejected`` tells that the distance is beyond what the centroid's own texts show: the name is then a
    guess. Texts that are null, empty or without a letter get ``und`` with score 0, as does every text if nothing was
    learned. Equal similarities go to the language first in order. Null or repeated ids are rows like any other; other
    columns are not read; an empty table gives an empty one. The project's features have no language field of their own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters_table()
        for batch in text_batches(batches, text_col, BATCH):
            counts, good = counts_of(texts_of(batch, text_col), letter)
            rows = len(good)
            if model.languages:
                likeness = weighted(counts, model.idf) @ model.centroids.T
                best = np.argmax(likeness, axis=1)
                cosine = np.clip(likeness[np.arange(rows), best].astype(float), 0.0, 1.0)
                names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), good.tolist())]
                far = (1 - cosine > model.reach[best]) | ~good
            else:
                cosine, names, far = np.zeros(rows), [UNKNOWN] * rows, np.ones(rows, dtype=bool)
            score = np.where(good, cosine, 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(id_col).cast(pa.int64()), pa.array(names), pa.array(score), pa.array(1 - score), pa.array(far)],
                                             names=[id_col, "idioma", "score", "distance", "rejected"])

    return features.select(id_col, text_col).mapInArrow(run, f"`{id_col}` long, idioma string, score double, distance double, rejected boolean")
