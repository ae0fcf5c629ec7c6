"""Helpers shared by the operators: tables, scratch storage, hot cells, connected components."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import scratch_dir


_HELD: dict = {}


def release() -> None:
    """Hands memory that a worker has freed back to the system; workers live on and take the next operator's tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def held(of: str, key: object, make: Callable[[], object]):
    """What an operator keeps in a worker between tasks; it takes the place of what another one kept."""
    if _HELD.get("of") != (of, key):
        _HELD.clear()
        release()
        _HELD.update(of=(of, key), state=make())
    return _HELD["state"]


def released(of: str, run: Callable) -> Callable:
    """``run`` over the batches of a task, or on one group, with no other operator's state in the worker and its own memory handed back."""
    if inspect.isgeneratorfunction(run):
        def task(batches):
            held(of, None, lambda: None)
            yield from run(batches)
            release()
    else:
        def task(part):
            held(of, None, lambda: None)
            found = run(part)
            release()
            return found
    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again, so lineage ends in shared files."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's shuffle partitions; they set how finely the operators deal out their buckets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_hot_cells(members: DataFrame, cell: list[str], key: str, most: int) -> DataFrame:
    """Members of cells with at most ``most`` rows as they are, larger cells as pairs of blocks.

    A cell of m rows gets nb = ceil(m / most) blocks by hash of ``key``; every unordered pair
    of blocks (``block_i`` <= ``block_j``) is a task unit of its own that holds the rows of both.
    Each pair of rows meets in exactly one unit if ``block`` decides: within (i, i) both rows
    are of block i, within (i, j) only pairs across the blocks count.
    """
    sizes = members.groupBy(*cell).agg(F.count(F.lit(1)).alias("_m"))
    joined = members.join(sizes, cell)
    nb = F.ceil(F.col("_m") / F.lit(most)).cast("int")
    block = F.pmod(F.xxhash64(F.col(key)), nb.cast("long")).cast("int")
    out = joined.withColumn("_nb", nb).withColumn("block", block)
    out = out.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
    return (out.withColumn("block_i", F.least("block", "_other"))
            .withColumn("block_j", F.greatest("block", "_other")).drop("_m", "_nb", "_other")
            .repartition(*cell, "block_i", "block_j"))  # else the join's partitioning by cell alone would be kept


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) of every node of an edge list ``a``, ``b``.

    Alternates the large-star and small-star steps of Kiveris et al. on stored edge tables until
    nothing changes. Minima are partial aggregates; the joins that hand a minimum back to the
    edges of a hub are plain equi-joins, which adaptive execution splits when a hub is hot.
    Null ends and self loops are ignored. An empty edge list gives no rows.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                        .alias("e")).select("e.a", "e.b")

    def mark(e: DataFrame):
        row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .distinct(), "edges")
    seen = mark(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        sym = both(now)
        least = sym.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = sym.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        now = stored(small, "edges")
        mark_now = mark(now)
        if mark_now == seen:
            break
        seen = mark_now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
