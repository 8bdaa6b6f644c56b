"""Shapes that cross themselves: edges meet in cells of their own shape, not each with each."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.buffers import edges_of, flat
from .overlay import group_starts, whole_groups

#: Points up to which a shape is tested where it stands; larger ones are dealt to cells.
FEW = 1_000


def _proper(ax, ay, bx, by, cx, cy, dx, dy) -> np.ndarray:
    """Whether segments a-b and c-d cross inside both."""
    def side(px, py, qx, qy, rx, ry):
        return np.sign((qx - px) * (ry - py) - (qy - py) * (rx - px))

    return (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) < 0) & (side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) < 0)


def crossed_groups(group: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """The groups in which two segments cross properly. Segments of a group are in order of their lower end; each meets the
    next, the next but one and so on, as long as these begin below its upper end."""
    low, high = np.minimum(y0, y1), np.maximum(y0, y1)
    by = np.lexsort((low, group))
    group, x0, y0, x1, y1, low, high = (v[by] for v in (group, x0, y0, x1, y1, low, high))
    left, right = np.minimum(x0, x1), np.maximum(x0, x1)
    found, live, step = [], np.arange(len(group)), 1
    while len(live):
        live = live[live + step < len(group)]
        other = live + step
        go = (group[other] == group[live]) & (low[other] < high[live])
        live, other = live[go], other[go]
        near = (left[live] < right[other]) & (left[other] < right[live])
        a, b = live[near], other[near]
        crossed = np.unique(group[a[_proper(x0[a], y0[a], x1[a], y1[a], x0[b], y0[b], x1[b], y1[b])]])
        if len(crossed):
            found.append(crossed)
            live = live[~np.isin(group[live], crossed)]
        step += 1
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=group.dtype)


def crossing_shapes(df: DataFrame, key: str, geom: str = "geom") -> DataFrame:
    """Keys of the shapes of which two edges cross properly.

    Shapes of up to ``FEW`` edges are tested where they stand, all of a batch at once. The edges of larger ones go to the
    cells that they run through, of a grid over the box of their shape with about as many cells as edges, so that edges
    meet only their neighbours whatever the size of the shape. Null and empty shapes cross nothing; a null key is left out.
    Give it stored shapes rather than derived ones: they are read twice.
    """
    shapes = df.select(F.col(key).alias("k"), F.col(geom).alias("g")).where("k IS NOT NULL AND g IS NOT NULL")
    sized = shapes.withColumn("n", F.aggregate(F.flatten("g"), F.lit(0), lambda n, ring: n + F.size(ring)))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x0, y0, x1, y1, row = edges_of(flat(batch.column("g")))
            yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(crossed_groups(row, x0, y0, x1, y1)))], names=["k"])

    few = sized.where(F.col("n") <= FEW).select("k", "g").mapInArrow(test, f"k {shapes.schema['k'].dataType.simpleString()}")
    boxed = sized.where(F.col("n") > FEW).withColumn("b", G.bbox(F.col("g")))
    boxed = boxed.withColumn("step", F.greatest(F.col("b.xmax") - F.col("b.xmin"), F.col("b.ymax") - F.col("b.ymin")) / F.ceil(F.sqrt("n")))
    edges = boxed.where("step > 0").select("k", "step", F.explode(G.edges(F.col("g"))).alias("e")).select("k", "step", "e.*")

    def row(y):
        return F.floor(y / F.col("step"))

    def at(y):
        """x of the edge at height y, kept on the edge."""
        x = F.col("x0") + (y - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
        return F.when(F.col("y0") == F.col("y1"), F.col("x0")).otherwise(F.least(F.greatest(x, F.least("x0", "x1")), F.greatest("x0", "x1")))

    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    rows = edges.withColumn("cy", F.explode(F.sequence(row(low), row(high))))
    a, b = at(F.greatest(low, F.col("cy") * F.col("step"))), at(F.least(high, (F.col("cy") + 1) * F.col("step")))
    level = F.col("y0") == F.col("y1")
    ends = rows.withColumns({"a": F.when(level, F.least("x0", "x1")).otherwise(F.least(a, b)), "b": F.when(level, F.greatest("x0", "x1")).otherwise(F.greatest(a, b))})
    # One cell more on either side: the x at a border of rows is rounded.
    cells = ends.withColumn("cx", F.explode(F.sequence(F.floor(F.col("a") / F.col("step") - 1e-6), F.floor(F.col("b") / F.col("step") + 1e-6))))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["k", "cx", "cy"]):
            starts = group_starts(table, ["k", "cx", "cy"])
            group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
            crossed = crossed_groups(group, *(table.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")))
            yield from table.select(["k"]).take(pa.array(starts[crossed])).to_batches()

    dealt = cells.select("k", "cx", "cy", "x0", "y0", "x1", "y1").repartition("k", "cx", "cy").sortWithinPartitions("k", "cx", "cy")
    crossed = dealt.mapInArrow(meet, f"k {edges.schema['k'].dataType.simpleString()}")
    return few.unionByName(crossed).distinct().withColumnRenamed("k", key)
