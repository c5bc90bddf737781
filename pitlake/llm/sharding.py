"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` cells. Each shard has ``vnodes`` virtual nodes on it; a
key belongs to the first node clockwise from its cell. A shard that is full passes what
it can't hold on clockwise. Capacities add up to the number of rows and differ by one at
most, so counts are balanced exactly, and only the overflow leaves its home shard.

Only counts per cell (``CELLS`` numbers at most) reach the driver. Rows are ranked within
their cell. A key that repeats, or rows without a ``doc_id`` and with equal texts, can make
a cell hot: such a cell is cut into parts of the usual size by a number of the row, of which
there are ``2 * CELLS`` in all at most, so no task ranks much more than ``1 / CELLS`` of all rows.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pitlake.llm.common import written

CELLS = 4096

#: A cell with so many times its usual share of the rows is cut into parts.
HOT = 4

_SEGMENT = T.StructType(
    [
        T.StructField("cell", T.IntegerType(), False),
        T.StructField("part", T.IntegerType(), False),
        T.StructField("first", T.LongType(), False),
        T.StructField("end", T.LongType(), False),
        T.StructField("shard", T.IntegerType(), False),
        T.StructField("slot0", T.LongType(), False),
    ]
)


def ring(n_shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise; a node's place depends on its shard and number only."""
    nodes = []
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "big") % CELLS, shard))
    return sorted(set(nodes))


def place(counts: dict[tuple[int, int], int], n_shards: int, vnodes: int) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (cell, part, first rank, end rank, shard, first slot) that cover every row of every part of a cell.

    First each shard admits the rows of its own cells, clockwise, up to its capacity.
    Then what is left of each cell walks clockwise to the next shards that have room.
    """
    nodes = ring(n_shards, vnodes)
    places = [c for c, _ in nodes]
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    slots = [0] * n_shards
    segments, left = [], []

    def admit(cell: tuple[int, int], first: int, end: int, shard: int) -> int:
        took = min(room[shard], end - first)
        if took:
            segments.append((*cell, first, first + took, shard, slots[shard]))
            slots[shard] += took
            room[shard] -= took
        return first + took

    for cell in sorted(counts):
        at = bisect.bisect_left(places, cell[0]) % len(nodes)
        if (done := admit(cell, 0, counts[cell], nodes[at][1])) < counts[cell]:
            left.append((cell, done, at))
    for cell, done, at in left:
        while done < counts[cell]:
            at = (at + 1) % len(nodes)
            done = admit(cell, done, counts[cell], nodes[at][1])
    return segments


def shard_documents(docs: DataFrame, n_shards: int = 16, vnodes: int = 64) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``n_shards`` shards.

    Returns doc_id, size, text_crc32, law, shard, slot, grown_shard. Null texts count as
    empty. Rows with equal doc_id are told apart by checksum and size; fully equal rows,
    however many, get different slots. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
    )
    spot = F.when(F.col("doc_id").isNull(), F.xxhash64(F.col("text_crc32"), F.col("size"))).otherwise(
        F.xxhash64(F.col("doc_id"))
    )
    base = base.withColumn("spot", spot).withColumn("cell", F.pmod(F.shiftright("spot", 20), F.lit(CELLS)).cast("int"))
    base = written(base.withColumn("row", F.monotonically_increasing_id()), "ring")
    counts = {r["cell"]: r["n"] for r in base.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    usual = max(1, -(-sum(counts.values()) // CELLS)) * HOT
    hot = {cell: -(-n // usual) for cell, n in counts.items() if n > usual}
    if hot:
        sizes = spark.createDataFrame(list(hot.items()), "cell int, parts int")  # CELLS rows at most
        base = base.join(F.broadcast(sizes), "cell", "left")
        base = base.withColumn("part", F.coalesce(F.pmod(F.xxhash64("row"), F.col("parts")), F.lit(0)).cast("int"))
    else:
        base = base.withColumn("part", F.lit(0))
    parts = {(cell, 0): n for cell, n in counts.items() if cell not in hot}
    if hot:
        cut = base.where("parts IS NOT NULL").groupBy("cell", "part").agg(F.count("*").alias("n"))
        parts |= {(r["cell"], r["part"]): r["n"] for r in cut.collect()}
    segments = spark.createDataFrame(place(parts, n_shards, vnodes), _SEGMENT)
    order = Window.partitionBy("cell", "part").orderBy("spot", "doc_id", "text_crc32", "size", "row")
    rows = base.withColumn("rank", F.row_number().over(order).cast("long") - 1)
    # At most 3 * CELLS + n_shards segments, whatever the input: a bounded broadcast.
    hit = (rows["cell"] == segments["cell"]) & (rows["part"] == segments["part"]) & (rows["rank"] >= segments["first"]) & (rows["rank"] < segments["end"])
    return rows.join(F.broadcast(segments), hit).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
