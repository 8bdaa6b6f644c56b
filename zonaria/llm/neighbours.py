"""Nearest vectors: a neighbour graph by NN-descent over Spark joins, searched greedily.

The project has no record with a vector, so the operator is general: any table with an id and an array of numbers.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored

#: Neighbours of a node in the graph; rounds of descent; size of the groups from which the first neighbours come, and how
#: many such groupings (the first at random, the others by signs of random projections).
DEGREE, ROUNDS, GROUP, GROUPINGS = 24, 6, 64, 4
#: Descent ends when a round changes less than this share of all neighbours.
SETTLED = 0.002
#: Candidates that a search keeps, how many of them it expands at once, how many it measures exactly, and its most rounds.
BEAM, EXPANDED, EXACT, STEPS = 192, 96, 48, 40
EDGE = "u long, w long, d float, fresh boolean"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows with an id and a vector that is not null or zero and has finite components only: ``id, v`` (doubles)."""
    v = F.col(vector_col).cast("array<double>")
    good = F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(good).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def coded(nodes: DataFrame) -> DataFrame:
    """``id, code``: each vector as a scale and one byte for each component, which is what the graph is built with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for v in batch.column("v").to_pylist():
                v = np.array(v)
                scale = np.float32(max(np.abs(v).max() / 127, 1e-30))
                codes.append(scale.tobytes() + np.clip(np.rint(v / scale), -127, 127).astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(codes, pa.binary())], names=["id", "code"])

    return nodes.select("id", "v").mapInArrow(run, "id long, code binary")


def decoded(codes: pa.Array) -> np.ndarray:
    """Vectors of a column of codes, one to a row; shorter ones count as zero beyond their end."""
    held = codes.to_pylist()
    width = max((len(c) for c in held), default=4) - 4
    out = np.zeros((len(held), width), dtype=np.float32)
    if all(len(c) == width + 4 for c in held):
        raw = np.frombuffer(b"".join(held), dtype=np.int8).reshape(len(held), width + 4)
        return raw[:, 4:].astype(np.float32) * np.ascontiguousarray(raw[:, :4]).view("<f4")
    for k, c in enumerate(held):
        out[k, : len(c) - 4] = np.frombuffer(c[4:], dtype=np.int8) * np.frombuffer(c[:4], dtype="<f4")
    return out


def whole_runs(batches: Iterator[pa.RecordBatch], key: str, least: int = 4096) -> Iterator[pa.Table]:
    """Tables that end where a run of equal keys ends; the rows come sorted by ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def blocks(table: pa.Table, key: str, most: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of runs of a key as padded matrices with the mask of the real ones, some hundred runs at once."""
    keys = table.column(key).to_numpy()
    starts = np.concatenate(([0], np.flatnonzero(np.diff(keys)) + 1))
    sizes = np.diff(np.append(starts, len(keys)))
    for k in range(0, len(starts), most):
        s, n = starts[k:k + most], sizes[k:k + most]
        at = np.arange(n.max())[None, :]
        real = at < n[:, None]
        yield np.where(real, s[:, None] + at, 0), real


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :] - 2 * a @ np.swapaxes(b, -1, -2), 0)


def _pairs(run_key: str, only_fresh: bool):
    """Within each run of a key, the pairs that come closer than the ``reach`` of their first member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, run_key):
            ids = table.column("w").to_numpy()
            reach = table.column("reach").to_numpy()
            fresh = table.column("fresh").to_numpy(zero_copy_only=False)
            vectors = decoded(table.column("code").combine_chunks())
            for at, real in blocks(table, run_key):
                apart = squared(vectors[at], vectors[at])
                ok = real[:, :, None] & real[:, None, :] & (ids[at][:, :, None] != ids[at][:, None, :]) & (apart < reach[at][:, :, None])
                if only_fresh:
                    ok &= fresh[at][:, :, None] | fresh[at][:, None, :]
                g, i, j = np.nonzero(ok)
                u, w, d = ids[at[g, i]], ids[at[g, j]], apart[g, i, j].astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w), pa.array(d), pa.array(np.ones(len(u), dtype=bool))], names=["u", "w", "d", "fresh"])

    return run


def nearest_each(edges: DataFrame, most: int, expanded: int = 0) -> DataFrame:
    """The ``most`` nearest different neighbours of each node; an edge known before stays as it was. With ``expanded``, a
    column ``front`` marks the nearest so many of the fresh ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "u"):
            u, w = table.column("u").to_numpy(), table.column("w").to_numpy()
            d = table.column("d").to_numpy()
            fresh = table.column("fresh").to_numpy(zero_copy_only=False)
            by = np.lexsort((fresh, w, u))
            by = by[np.concatenate(([True], (u[by][1:] != u[by][:-1]) | (w[by][1:] != w[by][:-1])))]
            by = by[np.lexsort((w[by], d[by], u[by]))]
            start = np.concatenate(([0], np.flatnonzero(np.diff(u[by])) + 1))
            place = np.arange(len(by)) - np.repeat(start, np.diff(np.append(start, len(by))))
            by = by[place < most]
            out = table.take(pa.array(by))
            if expanded:
                node, open_ = u[by], fresh[by]
                seen = np.cumsum(open_)
                start = np.concatenate(([0], np.flatnonzero(np.diff(node)) + 1))
                before = np.repeat(seen[start] - open_[start], np.diff(np.append(start, len(by))))
                out = out.append_column("front", pa.array(open_ & (seen - before <= expanded)))
            yield out.combine_chunks().to_batches()[0]

    return edges.repartition("u").sortWithinPartitions("u").mapInArrow(run, EDGE + (", front boolean" if expanded else ""))


def first_edges(codes: DataFrame, count: int, degree: int) -> DataFrame:
    """Neighbours within groups of about ``GROUP`` nodes: one grouping at random, the others by signs of projections.
    A larger group is split at random, so that near copies without number never meet in one task."""
    bits = max(0, int(np.log2(max(count, 1) / GROUP)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = decoded(batch.column("code"))
            for t in range(1, GROUPINGS):
                plane = np.random.default_rng(t).normal(size=(max(4096, vectors.shape[1]), max(bits, 1)))[: vectors.shape[1]]
                signs = (vectors @ plane > 0)[:, :bits]
                key = (signs << np.arange(bits)).sum(axis=1).astype(np.int64) if bits else np.zeros(len(vectors), np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("code"), pa.array(np.full(len(key), t)), pa.array(key)], names=["id", "code", "grouping", "key"])

    groups = max(1, count // GROUP)
    signs = codes.mapInArrow(keys, "id long, code binary, grouping long, key long")
    crowd = signs.groupBy("grouping", "key").agg(F.ceil(F.count("*") / (2 * GROUP)).alias("parts"))
    split = signs.join(crowd, ["grouping", "key"]).select("id", "code", F.xxhash64("grouping", "key", F.pmod(F.xxhash64("id", "grouping"), "parts")).alias("g"))
    loose = codes.select("id", "code", F.xxhash64(F.lit(0), F.pmod(F.xxhash64("id", F.lit(0)), F.lit(groups))).alias("g"))
    rows = split.unionByName(loose).select("g", F.col("id").alias("w"), "code", F.lit(3.0e38).cast("float").alias("reach"), F.lit(True).alias("fresh"))
    return nearest_each(rows.repartition("g").sortWithinPartitions("g").mapInArrow(_pairs("g", False), EDGE), degree)


def both_ways(graph: DataFrame, degree: int) -> DataFrame:
    """Neighbours of each node and, of those that count it as theirs, as many, drawn by a hash: ``v, w, fresh``."""
    back = (graph.select(F.col("w").alias("v"), F.col("u").alias("w"), "fresh")
            .withColumn("draw", F.row_number().over(W.partitionBy("v").orderBy(F.col("fresh").desc(), F.xxhash64("v", "w")))).where(F.col("draw") <= degree).drop("draw"))
    return graph.select(F.col("u").alias("v"), "w", "fresh").unionByName(back).groupBy("v", "w").agg(F.max("fresh").alias("fresh"))


def neighbour_graph(codes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """NN-descent: ``u, w, d`` with the ``degree`` nearest found of each node (``d`` is the squared distance of the codes).

    Each round joins the neighbours of a node, in both directions, with each other: two neighbours of one node are likely
    neighbours of each other. Pairs in which neither is new were met before and are not met again.
    """
    count = codes.count()
    graph = stored(first_edges(codes, count, degree))
    for _ in range(rounds):
        reach = graph.groupBy("u").agg(F.max("d").alias("far"), F.count("*").alias("n")).select(
            F.col("u").alias("w"), F.when(F.col("n") < degree, F.lit(3.0e38)).otherwise(F.col("far")).cast("float").alias("reach"))
        lists = both_ways(graph, degree).join(codes.withColumnRenamed("id", "w").join(reach, "w"), "w").select("v", "w", "code", "reach", "fresh")
        met = lists.repartition("v").sortWithinPartitions("v").mapInArrow(_pairs("v", True), EDGE)
        before = graph.select("u", "w", "d", F.lit(False).alias("fresh"))
        graph = stored(nearest_each(before.unionByName(met), degree))
        if graph.where("fresh").count() <= SETTLED * degree * max(count, 1):
            break
    return graph.select("u", "w", "d")


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = ((decoded(batch.column("asked")) - decoded(batch.column("code"))) ** 2).sum(axis=1).astype(np.float32)
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("w"), pa.array(near), pa.array(np.ones(len(near), dtype=bool))], names=["u", "w", "d", "fresh"])


def search(queries: DataFrame, codes: DataFrame, graph: DataFrame, beam: int = BEAM, expanded: int = EXPANDED, degree: int = DEGREE) -> DataFrame:
    """Greedy search for each of ``queries`` (``u``, nodes of the graph): ``u, w, d`` with up to ``beam`` candidates.

    A query starts from its own neighbours; in each step its nearest candidates that are not yet expanded hand in their
    neighbours, until all it keeps are expanded. ``fresh`` marks those still to expand.
    """
    links = stored(both_ways(graph.withColumn("fresh", F.lit(True)), degree).select(F.col("v").alias("at"), "w"))
    asked = stored(queries.join(codes.withColumnRenamed("id", "u"), "u").withColumnRenamed("code", "asked"))
    state = stored(nearest_each(asked.select("u").join(graph, "u").select("u", "w", "d", F.lit(True).alias("fresh")), beam, expanded))
    for _ in range(STEPS):
        front = state.where("front").select("u", F.col("w").alias("at"))
        if front.isEmpty():
            break
        reached = front.join(links, "at").where("u <> w").select("u", "w").distinct()
        met = reached.join(codes.withColumnRenamed("id", "w"), "w").join(asked, "u").mapInArrow(_measured, EDGE)
        done = state.select("u", "w", "d", (F.col("fresh") & ~F.col("front")).alias("fresh"))
        state = stored(nearest_each(done.unionByName(met), beam, expanded))
    return state.select("u", "w", "d")


def nearest(vectors: DataFrame, wanted: str, id_col: str = "id", vector_col: str = "vector", k: int = 10) -> DataFrame:
    """The ``k`` nearest vectors found of each row for which ``wanted`` (SQL on the table's columns) holds:
    ``query_id, rank, vec_id, score`` by Euclidean distance in double precision, ties to the smaller id.

    Approximate: the graph and the search decide which candidates are measured, on the original vectors. Equal vectors are
    one node, of which the ``k + 1`` smallest ids take part, so that masses of copies cost nothing and the answer stays
    exact among them. Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
    an id; of rows that repeat an id and vector one counts. With fewer than ``k`` candidates all are returned; an empty
    table gives none. Vectors of unequal length count as padded with zeros.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, id_col, vector_col).distinct())
    members = rows.withColumn("turn", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("turn") <= k + 1)
    heads = rows.groupBy("v").agg(F.min("id").alias("id"))
    nodes = stored(heads.select("id", "v"))
    members = stored(members.join(nodes.withColumnRenamed("id", "node"), "v").select("node", "id"))
    codes = stored(coded(nodes))
    asking = stored(usable(vectors.where(wanted), id_col, vector_col).distinct().join(nodes.withColumnRenamed("id", "u"), "v").select(F.col("id").alias("query_id"), "u", "v"))
    graph = neighbour_graph(codes)
    found = search(asking.select("u").distinct(), codes, graph)
    near = found.withColumn("turn", F.row_number().over(W.partitionBy("u").orderBy("d", "w"))).where(F.col("turn") <= EXACT).select("u", "w")
    near = near.unionByName(asking.select("u", F.col("u").alias("w")).distinct())
    apart = F.sqrt(F.aggregate(F.zip_with("v", "other", lambda a, b: F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x * x))
    scored = (asking.join(near, "u").join(nodes.select(F.col("id").alias("w"), F.col("v").alias("other")), "w")
              .select("query_id", "w", apart.alias("score")).join(members.withColumnRenamed("node", "w"), "w").where("id <> query_id"))
    ranked = scored.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
