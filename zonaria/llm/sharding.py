"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: The ring is cut into so many equal cells, and every shard owns so many points on it (fixed sizes, whatever the data).
CELL_BITS = 14
VIRTUAL = 64


def ring(spark, shards: int, virtual: int = VIRTUAL, bits: int = CELL_BITS) -> list[int]:
    """Owner of each cell of the ring: the shard of the next virtual node clockwise, ties to the smaller shard."""
    rows = (spark.range(shards * virtual).select(F.floor(F.col("id") / virtual).cast("int").alias("shard"), "id")
            .select(F.shiftrightunsigned(F.xxhash64(F.lit("ring"), "shard", "id"), 64 - bits).alias("cell"), "shard")
            .groupBy("cell").agg(F.min("shard").alias("shard")).collect())
    owner = {r.cell: r.shard for r in rows}
    size, out, last = 1 << bits, [0] * (1 << bits), owner[min(owner)]
    for cell in range(size - 1, -1, -1):
        last = owner.get(cell, last)
        out[cell] = last
    return out


def spans(counts: dict[int, int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """``cell, first, end, shard, base``: which ranks of each cell go to which shard, and the first place there.

    Capacities differ by one at most and add up to the number of rows. Walking clockwise, each cell fills its owner;
    what finds it full is carried on to the next cell and enters that cell's owner if it has room left after its own.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out, size = [], len(owner)
    waiting: list[list[int]] = []  # cell, first, end
    own_left = [0] * shards
    for cell, n in counts.items():
        own_left[owner[cell]] += n

    def place(cell: int, first: int, end: int, shard: int) -> None:
        if end > first:
            out.append((cell, first, end, shard, used[shard]))
            used[shard] += end - first
            room[shard] -= end - first

    for lap in range(2):
        for cell in range(size):
            shard = owner[cell]
            if lap == 0 and (n := counts.get(cell, 0)):
                taken = min(n, room[shard])
                place(cell, 0, taken, shard)
                own_left[shard] -= n
                if taken < n:
                    waiting.append([cell, taken, n])
            spare = room[shard] - (max(0, own_left[shard]) if lap == 0 else 0)
            while waiting and spare > 0:
                head = waiting[0]
                taken = min(spare, head[2] - head[1])
                place(head[0], head[1], head[1] + taken, shard)
                head[1] += taken
                spare -= taken
                if head[1] == head[2]:
                    waiting.pop(0)
        if not waiting:
            break
    return out


def shard_rows(features: DataFrame, id_col: str = "gid", text_col: str = "zona_desc", shards: int = 8, virtual: int = VIRTUAL) -> DataFrame:
    """Spread features over ``shards`` shards: ``gid, size, text_crc32, law, shard, slot, grown_shard``.

    ``law`` is ``rows``: the shards' counts differ by one at most. Each row lies on a hash ring at the hash of its id; it
    belongs to the next virtual node clockwise unless that node's shard is full, then it goes on clockwise. ``size`` is
    the UTF-8 length of the description plus one, ``text_crc32`` its checksum, ``slot`` the place in the shard, gapless
    from 0. ``grown_shard`` is null: a bounded load cannot promise that a further shard only takes rows.

    Only counts of ring cells (a fixed number) reach the driver. Rows are placed by rank within their cell; the position
    is taken from the id and the text's checksum, so rows that share an id still spread, and equal rows are
    interchangeable. Null ids and null texts (size 1, checksum 0) are rows like any other; an empty table gives none.
    """
    size = 1 << CELL_BITS
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = features.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("point", F.xxhash64(F.lit("row"), id_col, "text_crc32")).withColumn("cell", F.shiftrightunsigned("point", 64 - CELL_BITS).cast("int"))
    counts = {r.cell: r["count"] for r in rows.groupBy("cell").count().collect()}
    owner = ring(features.sparkSession, shards, virtual)
    placed = spans(counts, owner, shards)
    table = features.sparkSession.createDataFrame(placed, "cell int, first long, end long, shard int, base long")
    ranked = rows.withColumn("rank", (F.row_number().over(W.partitionBy("cell").orderBy("point", id_col, "text_crc32", "size")) - 1).cast("long"))
    here = ranked.join(F.broadcast(table), "cell").where("rank >= first AND rank < end")  # at most cells + shards * virtual rows
    return here.select(id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
