"""What the text operators share: the shared folder, batches of bounded size, words, connected components."""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from ..session import shared_folder

SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = "[^\\x20\\x09-\\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as compressed Parquet in the shared folder and read back, so that a lost executor
    costs no recomputation and no later step repeats the work. Shuffle files of the write go as soon as it ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one hold at most ``limit`` bytes (a single longer text stands alone)."""
    for batch in batches:
        sizes = np.nan_to_num(np.array(pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=float)).astype(np.int64)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def grouped_with(rows: DataFrame, key: Column, answers: DataFrame, answer_key: str, use: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType | str) -> DataFrame:
    """``use(rows, answers)`` for each key, on one exchange of both tables. Keys of ``answers`` alone are left out."""
    left = rows.select(key.cast("long").alias("key"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    right = answers.select(F.col(answer_key).cast("long").alias("key"), F.struct(*answers.columns).alias("answer"))
    both = left.withColumn("answer", F.lit(None).cast(right.schema["answer"].dataType)).unionByName(right.withColumn("row", F.lit(None).cast(left.schema["row"].dataType)))
    empty = to_arrow_schema(schema if isinstance(schema, StructType) else DataType.fromDDL(schema))

    def side(table: pa.Table, name: str) -> pa.Table:
        held = table.column(name).filter(pa.compute.is_valid(table.column(name))).combine_chunks()
        return pa.Table.from_batches([pa.RecordBatch.from_struct_array(c) for c in (held.chunks if isinstance(held, pa.ChunkedArray) else [held])])

    def run(table: pa.Table) -> pa.Table:
        own = side(table, "row")
        return use(own, side(table, "answer")) if own.num_rows else empty.empty_table()

    return both.groupBy("key").applyInArrow(run, schema)


def signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """Connected components of ``links`` (two long columns): ``node, root`` with the smallest node as root.

    Alternates two star steps: every node hands its larger neighbours, then its smaller ones, to the smallest
    neighbour. No step lists pairs within a group, the number of links never grows, and the rounds are logarithmic
    in the length of the longest chain. Each round is stored in the shared folder.
    """
    links = stored(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()

    before = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                                               F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("l"))
                 .select("l.a", "l.b").where("a <> b").distinct())
        links = stored(small)
        now = state(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label[a], label[b])
        np.minimum.at(new, label[b], label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
