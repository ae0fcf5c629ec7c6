"""Embedding near-dedup by collision-counting projections.

Unit vectors with cosine >= 0.98 are at most 0.2 apart, so on a random axis their projections differ
by about 0.2 / sqrt(dim) at most. Each label is cut into cells by the first axes; a vector is at home
in one cell and also visits every cell that its window reaches downwards, from the upper to the lower side of
axes. Two vectors meet in the cell that is on the lower side wherever their homes differ, and are counted there alone.
Inside a cell the projections on ``PROJECTIONS`` more axes are sorted one by one, each vector's window is
looked up in the sorted order, and collisions are counted per pair. Pairs with at least
``needed()`` collisions are verified by their cosine in double precision.

Recall is set by two documented numbers: ``REACH`` (half a window on a cell axis, in deviations of a
pair at the limit) and ``RECALL`` (share of pairs at the limit that reach the needed count). Closer
pairs do better. How many axes cut a label follows from its number of distinct vectors alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import connected_components, split_hot_cells, stored

COSINE = 0.98
CELL = 512  # distinct vectors counted against each other in one task
REACH = 2.0
PROJECTIONS = 24
WINDOW = 1.5  # half a counting window, in the same deviations
RECALL = 0.999
SAMPLE = 2000  # vectors that set where the cell axes are cut
AXES = 40  # most axes that cut a label
SEED = 3


def deviation(dim: int, cosine: float = COSINE) -> float:
    """Deviation of the projected difference of two unit vectors at the limit."""
    return math.sqrt(2 - 2 * cosine) / math.sqrt(dim)


def needed(projections: int = PROJECTIONS, window: float = WINDOW, recall: float = RECALL) -> int:
    """Largest count that a pair at the limit reaches with probability ``recall``."""
    p = 2 * NormalDist().cdf(window) - 1
    reached, k = 0.0, projections
    while k > 0:
        reached += math.comb(projections, k) * p ** k * (1 - p) ** (projections - k)
        if reached >= recall:
            return k
        k -= 1
    return 0


@lru_cache(maxsize=8)
def axes(dim: int) -> np.ndarray:
    """Random unit axes: the first ``AXES`` cut cells, the others count."""
    a = np.random.default_rng(SEED).standard_normal((dim, AXES + PROJECTIONS))
    return a / np.linalg.norm(a, axis=0)


def collisions(p: np.ndarray, reach: float) -> np.ndarray:
    """Per pair, on how many columns of ``p`` one lies in the other's window."""
    n = len(p)
    counts = np.zeros((n, n), np.uint8)
    for k in range(p.shape[1]):
        order = np.argsort(p[:, k], kind="stable")
        sorted_ = p[order, k]
        low, high = np.searchsorted(sorted_, p[:, k] - reach), np.searchsorted(sorted_, p[:, k] + reach, "right")
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        counts += (place >= low.astype(np.int32)[:, None]) & (place < high.astype(np.int32)[:, None])
    return counts


def _read(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (float64 bytes), key (label and vector): x and key are null where nothing can link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            xs, keys = [], []
            for label, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                x = np.array(v, np.float64) if v is not None and label is not None and None not in v else np.zeros(0)
                with np.errstate(over="ignore", invalid="ignore"):
                    good = len(x) and np.isfinite(x).all() and x.any()
                xs.append((x + 0.0).tobytes() if good else None)
                keys.append(xxhash.xxh3_128_digest(repr(label).encode() + b"|" + xs[-1]) if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(xs, pa.binary()), pa.array(keys, pa.binary())],
                                             names=["vec_id", "label", "x", "key"])

    return vectors.mapInArrow(run, "vec_id long, label string, x binary, key binary")


def unit(raw: bytes) -> np.ndarray:
    x = np.frombuffer(raw, np.float64)
    x = x / np.abs(x).max()
    return x / np.linalg.norm(x)


def _cells(reps: DataFrame, cuts: dict[int, np.ndarray]) -> DataFrame:
    """Rows (label, dim, cell, home) of each distinct vector: its own cell and those its windows reach downwards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {n: [] for n in ("label", "dim", "cell", "home", "rep", "copies", "x")}
            for r in b.to_pylist():
                x = unit(r["x"])
                dim = len(x)
                p = x @ axes(dim)[:, :r["cut"]] - cuts.get(dim, np.zeros(AXES))[:r["cut"]]
                home = sum(1 << int(k) for k in np.flatnonzero(p >= 0))
                reach = [home]
                for k in np.flatnonzero((p >= 0) & (p <= REACH * deviation(dim))):
                    reach += [c ^ 1 << int(k) for c in reach]
                for c in reach:
                    for n, v in zip(rows, (r["label"], dim, c, home, r["rep"], r["copies"], r["x"]), strict=True):
                        rows[n].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("label", pa.string()), ("dim", pa.int32()), ("cell", pa.int64()), ("home", pa.int64()),
                ("rep", pa.int64()), ("copies", pa.int64()), ("x", pa.binary())]))

    return reps.mapInArrow(run, "label string, dim int, cell long, home long, rep long, copies long, x binary")


def _unit_links(part: pd.DataFrame) -> pd.DataFrame:
    """Of a task: per vector how many others it links to (kind 0), and edges that connect them (kind 1).

    A pair counts in the cell of the sides that both homes have in common, so other cells that both visit don't count it again.
    """
    part = part.sort_values("rep", ignore_index=True)
    raw = np.stack([np.frombuffer(x, np.float64) for x in part["x"]])
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    units = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    dim = units.shape[1]
    counts = collisions(units @ axes(dim)[:, AXES:], WINDOW * deviation(dim))
    block, home = part["block"].to_numpy(), part["home"].to_numpy()
    i, j = part["block_i"].iloc[0], part["block_j"].iloc[0]
    ask = np.triu(counts >= needed(), 1) & (home[:, None] & home[None, :] == part["cell"].iloc[0])
    if i != j:
        ask &= block[:, None] != block[None, :]
    a, b = np.nonzero(ask)
    cosine = np.concatenate([(units[a[k:k + 50_000]] * units[b[k:k + 50_000]]).sum(axis=1) for k in range(0, len(a), 50_000)] or [np.zeros(0)])
    a, b = a[cosine >= COSINE], b[cosine >= COSINE]
    copies, rep = part["copies"].to_numpy(), part["rep"].to_numpy()
    links = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
    parent = list(range(len(rep)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k, m in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(k), root(m)
        parent[max(x, y)] = min(x, y)
    some = np.flatnonzero(links)
    edges = [(1, int(rep[k]), int(rep[root(k)])) for k in range(len(rep)) if root(k) != k]
    return pd.DataFrame([*zip([0] * len(some), rep[some].tolist(), links[some].astype(np.int64).tolist(), strict=True), *edges],
                        columns=["kind", "a", "b"])


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, n_links, component_id, kept of every row.

    Vectors are compared only within equal labels. A null label, a null, zero or empty vector, and
    one with null or non-finite components links with nothing. Equal vectors are one vector with
    copies; vectors of different lengths don't link. A null id stays alone. Ids that repeat count as
    one node. Other columns are not read.
    """
    rows = stored(_read(vectors.select(F.col(id_col).cast("long"), F.col(label_col).cast("string"),
                                       F.col(vector_col).cast("array<double>"))), "vectors")
    known = rows.where("key is not null and vec_id is not null")
    reps = known.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                    F.first("label").alias("label"), F.first("x").alias("x"))
    reps = stored(reps.withColumn("dim", (F.octet_length("x") / 8).cast("int")), "distinct-vectors")
    sample = reps.select("x").orderBy(F.xxhash64("x")).limit(SAMPLE).collect()
    cuts: dict[int, np.ndarray] = {}  # of the lengths in the sample; vectors of others are cut at 0
    for dim in {len(r["x"]) // 8 for r in sample}:
        cuts[dim] = np.median(np.stack([unit(r["x"]) for r in sample if len(r["x"]) == 8 * dim]) @ axes(dim)[:, :AXES], axis=0)
    cut = reps.groupBy("label", "dim").agg(F.least(F.lit(AXES), F.greatest(F.lit(1), F.ceil(F.log2(F.count(F.lit(1)) / CELL)) + 1)).cast("int").alias("cut"))
    cells = _cells(reps.join(cut, ["label", "dim"]).select("label", "rep", "copies", "x", "cut"), cuts)
    tasks = split_hot_cells(cells, ["label", "dim", "cell"], "rep", CELL)
    found = stored(tasks.groupBy("label", "dim", "cell", "block_i", "block_j").applyInPandas(_unit_links, "kind int, a long, b long"), "vector-links")
    links = found.where("kind = 0").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("near"))
    component = connected_components(found.where("kind = 1").select("a", "b"))
    labels = (reps.select("key", "rep", "copies").join(links, "rep", "left")
              .join(component.withColumnRenamed("node", "rep"), "rep", "left")
              .select("key", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    alone = F.col("vec_id").isNull() | F.col("component_id").isNull()
    return (rows.select("vec_id", "key").join(labels, "key", "left")
            .select(F.col("vec_id").alias(id_col), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                    F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
good AS (
  SELECT * FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
    AND len(list_filter(x, lambda e: e <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN n USING (vec_id)
"""
