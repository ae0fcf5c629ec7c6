"""Minimum-cost-flow resharding: from old shard sizes and new capacities to the transfers that move the fewest bytes.

Old and new shards are the two sides of a flow network: an old shard supplies its bytes, a new one
takes its capacity, staying in place costs nothing and moving costs one per byte. The flow says how
many bytes go from where to where. Inside an old shard documents lie in blocks, large documents
first, so a shard is a line of bytes; the flow cuts it into stretches, one per destination, the part
that stays first. A document goes where its middle lies; the cuts fall among the smallest
documents, so shards differ from their capacity by a few small documents at most.

Only sums per block and per shard are gathered; their number is set by the parameters, not by the data.
"""

from __future__ import annotations

from collections import deque
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import stored
from tramline.session import scratch_dir

OLD_SHARDS = 20
SHARDS = 24
SUB_BLOCKS = 64  # blocks of an old shard for each size class
CLASSES = 8  # size classes for each doubling


def transfers(sizes: list[int], capacities: list[int]) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one at least cost (successive shortest paths).

    Shard numbers in common mean the same place. The capacities must hold the sizes.
    """
    if sum(capacities) < sum(sizes):
        raise ValueError("the new shards can't hold the old ones")
    n, m = len(sizes), len(capacities)
    source, sink = n + m, n + m + 1
    to, room, cost, at = [], [], [], [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, amount: int, price: int) -> None:
        for x, y, r, c in ((a, b, amount, price), (b, a, 0, -price)):
            at[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)

    for i, s in enumerate(sizes):
        edge(source, i, s, 0)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, sizes[i], int(i != j))
    for j, c in enumerate(capacities):
        edge(n + j, sink, c, 0)
    while True:
        far, by, queue, waits = [None] * (n + m + 2), {}, deque([source]), {source}
        far[source] = 0
        while queue:
            a = queue.popleft()
            waits.discard(a)
            for e in at[a]:
                b = to[e]
                if room[e] and (far[b] is None or far[a] + cost[e] < far[b]):
                    far[b], by[b] = far[a] + cost[e], e
                    if b not in waits:
                        queue.append(b)
                        waits.add(b)
        if far[sink] is None:
            break
        path, b = [], sink
        while b != source:
            path.append(by[b])
            b = to[by[b] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return {(i, to[e] - n): room[e ^ 1] for i in range(n) for e in at[i] if e % 2 == 0 and room[e ^ 1]}


def equal_capacities(total: int, n: int) -> list[int]:
    return [total // n + (k < total % n) for k in range(n)]


def _destination(flow: dict[tuple[int, int], int], old: Column, middle: Column) -> Column:
    """New shard by the place in the old one: the stretch that stays, then the others by number."""
    out = F.lit(None).cast("int")
    for i in sorted({i for i, _ in flow}, reverse=True):
        parts = sorted(((j, b) for (k, j), b in flow.items() if k == i), key=lambda p: (p[0] != i, p[0]))
        ends = list(accumulate(b for _, b in parts))
        stretch = F.lit(parts[-1][0])
        for (j, _), end in reversed(list(zip(parts[:-1], ends[:-1], strict=True))):
            stretch = F.when(middle < end, j).otherwise(stretch)
        out = F.when(old == i, stretch).otherwise(out)
    return out.cast("int")


def plan(docs: DataFrame, old_shard: Column | None = None, old_shards: int = OLD_SHARDS, shards: int = SHARDS,
         capacities: list[int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text, old shard, size, block, new shard and slot: doc_id, text, old, size, text_crc32, shard, slot.

    ``old_shard``: where a row lies now (0 to ``old_shards`` - 1); by default the hash of its id. A row's
    size is its text's UTF-8 bytes plus 8 (null: 8). Null ids have a hash as well; rows that repeat are
    rows of their own, and which of two equal rows comes first makes no difference. Slots count a
    shard's rows from 0: block by block, in a block by id. An empty table gives no rows.
    """
    old = (old_shard if old_shard is not None else F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(old_shards))).cast("int")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), old.alias("old"))
    rows = rows.withColumn("size", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long"))
    rows = rows.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    rows = rows.withColumn("class", -F.floor(F.log2("size") * CLASSES).cast("int"))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SUB_BLOCKS)).cast("int"))
    block = ["old", "class", "sub"]
    blocks = stored(rows.groupBy(*block).agg(F.sum("size").alias("bytes")), "blocks")
    sizes = {r["old"]: r["n"] for r in blocks.groupBy("old").agg(F.sum("bytes").alias("n")).collect()}
    supply = [sizes.get(i, 0) for i in range(old_shards)]
    flow = transfers(supply, capacities or equal_capacities(sum(supply), shards))
    line = W.partitionBy("old").orderBy("class", "sub")  # blocks: a number set by the parameters
    before = blocks.select(*block, (F.sum("bytes").over(line) - F.col("bytes")).alias("before"))
    inside = W.partitionBy(*block).orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)

    def placed(source: DataFrame, columns: list[str]) -> DataFrame:
        at = F.coalesce(F.sum("size").over(inside), F.lit(0))
        found = source.select(*columns, at.alias("at")).join(before, block)
        return found.withColumn("shard", _destination(flow, F.col("old"), F.col("before") + F.col("at") + F.col("size") / 2))

    narrow = ["doc_id", "old", "size", "text_crc32", "class", "sub"]
    counts = placed(rows.select(*narrow), narrow).groupBy("shard", *block).agg(F.count(F.lit(1)).alias("rows"))
    order = W.partitionBy("shard").orderBy("old", "class", "sub")
    first = stored(counts.select("shard", *block, (F.sum("rows").over(order) - F.col("rows")).alias("first")), "slots")
    by_id = W.partitionBy(*block, "shard").orderBy("doc_id", "text_crc32", "size")
    out = placed(rows, [*narrow, "text"]).withColumn("rank", F.row_number().over(by_id) - 1)
    return (out.join(first, ["shard", *block])
            .select("doc_id", "text", "old", "size", "text_crc32", "shard", (F.col("first") + F.col("rank")).cast("long").alias("slot")))


def rewrite(planned: DataFrame, path: str) -> None:
    """Writes each new shard's rows as files of its own folder; a task's blocks go to one shard or two."""
    planned.write.partitionBy("shard").parquet(path)


def resharded(docs: DataFrame, **options) -> DataFrame:
    """Writes the new shards below the shared folder and gives the digest of the files: doc_id, size, text_crc32, shard, slot."""
    path = scratch_dir(docs.sparkSession, "shards")
    rewrite(plan(docs, **options).drop("text_crc32", "size", "old"), path)
    found = docs.sparkSession.read.schema("doc_id long, text string, slot long, shard int").parquet(path)
    return found.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
                        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
                        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
