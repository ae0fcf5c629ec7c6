"""N-gram Jaccard join: an exact self-join in the Jaccard metric by pivots, windows and recursion.

Documents are sets of distinct five-word shingles, d(x, y) = 1 - |x & y| / |x | y|, links are d <= 0.2.
Nearly all documents are at distance 1 from each other, so document pivots cannot part the whole
corpus; the join therefore works on two levels of pivots.

* Level 1: every shingle s is a pivot {s}. A document is equally near to the pivots of all its
  shingles (1 - 1/|x|) and at distance 1 from all others; the tie goes to the rarest shingle, which
  makes its Voronoi region. Two documents within 0.2 share at least ceil(0.8 |x|) shingles, so a
  document is replicated, as a boundary document, to the pivots of its rarest
  |x| - ceil(0.8 |x|) + 1 shingles and to no other: two linked documents meet in a region.
  Regions with one document vanish, regions with the same documents are joined once.
* Level 2: overlapping regions make a cell, a closed world for its documents. In a cell documents
  are the pivots: links to pivots are found, each document gets its nearest pivot's region and is
  replicated to those that the triangle inequality doesn't exclude (d(x, q) <= d(x, p) + 2 * 0.2),
  and regions are joined recursively. Where distances are too even for regions to shrink, the
  pivots leave and the rest goes on as one region. Every linked pair of the cell is found.

Equal sets are one document with its number of copies. A cell above ``CELL`` documents or ``ENTRIES``
shingles is cut into blocks: each block is joined as above, and each pair of blocks is a task of its
own. Tasks give a row per document that has links, with their number, never the pairs.
Shingles are 64-bit hashes of whole words' hashes; sets are told apart by 128 bits. Between the deals a set
goes by 64 of them, its key, after a look that no two sets have the same one (else other keys are taken);
its size and its document are joined to it again at its boundary, so a shingle's bucket gets eight bytes and
a count per set, and hashes, keys, counts and frequencies as columns of their own, which pack well.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import connected_components, partitions, released, stored

SHINGLE = 5
PERCENT = 80  # linked: 100 * intersection >= PERCENT * union
CELL = 1024  # documents of a block
ENTRIES = 2_000_000  # shingles of a block, longer single documents excepted
PIVOTS = 8
BUCKET = 1_000_000  # shingles dealt to one task
HOT_SHARE = 0.01  # of all documents; at most 1 / HOT_SHARE such shingles per shingle of a mean document
HOT_BASE = 1 << 30  # rank of frequent shingles: behind all others
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes: A-Z lower-cased, words parted by ASCII white space; short texts are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    one = xxhash.xxh3_64_intdigest
    h = np.array([one(w) for w in words], np.uint64)
    n = len(h) - width + 1
    s = np.zeros(n, np.uint64)
    for k in range(width):
        s = (s ^ (s >> np.uint64(29))) * FACTORS[k % 5] + h[k:k + n] * FACTORS[(k + 1) % 5]
    s ^= s >> np.uint64(32)
    return np.unique(s * FACTORS[1] ^ (s >> np.uint64(31)))


def signature(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def set_key(sig: bytes, seed: int = 0) -> int:
    """A set's key of 64 bits, signed."""
    return int.from_bytes(sig[:8] if not seed else xxhash.xxh3_64_digest(sig, seed=seed), "little", signed=True)


def at_least(share_of: np.ndarray | int):
    """Least intersection with a set of this size: ceil(PERCENT / 100 * n)."""
    return (share_of * PERCENT + 99) // 100


# --- pass 1: sizes, signatures, frequent shingles ---------------------------------------------------------

def _summaries(docs: DataFrame) -> DataFrame:
    """kind 0: id, shingles, signature of a row and its first half. kind 1: a shingle frequent within a batch, and in how many sets of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, sigs, seen = b.column(0).to_pylist(), [], [], {}
            for t in b.column(1).to_pylist():
                s = shingles(t)
                ns.append(len(s))
                sigs.append(signature(s) if len(s) else None)
                if len(s):
                    seen[sigs[-1]] = s
            yield _batch([0] * len(ids), ids, ns, sigs)
            if seen:
                total = np.sort(np.concatenate(list(seen.values())))
                first = np.flatnonzero(np.append(True, total[1:] != total[:-1]))
                count = np.diff(np.append(first, len(total)))
                hot = count >= max(3, HOT_SHARE * len(seen) / 2)
                yield _batch([1] * int(hot.sum()), total[first[hot]].view(np.int64).tolist(), count[hot].tolist(), [None] * int(hot.sum()))

    def _batch(kind, key, n, sig):
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
                                           pa.array(sig, pa.binary()),
                                           pa.array([x and set_key(x) for x in sig], pa.int64())],
                                          names=["kind", "key", "n", "sig", "half"])

    return docs.mapInArrow(released("jaccard join", run), "kind int, key long, n long, sig binary, half long")


# --- pass 2: document frequencies ------------------------------------------------------------------------

def _packed(kept: dict[str, list], at: int, half: np.ndarray, owner: np.ndarray, **columns: np.ndarray) -> None:
    """Adds a row: the sets in order, how many entries each has, and the entries' columns."""
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    kept["bucket"].append(at)
    kept["docs"].append(half[owner[first]].tobytes())
    kept["sizes"].append(np.diff(np.append(first, len(owner))).astype(np.uint32).tobytes())
    for name, values in columns.items():
        kept[name].append(values.tobytes())


def _unpacked(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets of all rows, and the set of each entry."""
    half = np.concatenate([np.frombuffer(x, np.int64) for x in part["docs"]])
    return half, np.repeat(np.arange(len(half)), np.concatenate([np.frombuffer(x, np.uint32) for x in part["sizes"]]))


def _to_buckets(docs: DataFrame, hot: np.ndarray, buckets: int, seed: int) -> DataFrame:
    """Shingles by bucket of their hash; a frequent one is dealt by its set as well, so it has no bucket of its own."""
    def flush(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        half, flat = np.fromiter(sets, np.int64, len(sets)), np.concatenate(list(sets.values()))
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets.values()])
        salt = (half.view(np.uint64) >> np.uint64(16))[owner]
        is_hot = hot[np.minimum(np.searchsorted(hot, flat), max(0, len(hot) - 1))] == flat if len(hot) else np.zeros(len(flat), bool)
        bucket = ((flat + np.where(is_hot, salt, np.uint64(0))) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, owner, flat = bucket[order], owner[order], flat[order]
        ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1
        rows, at = {"bucket": [], "docs": [], "sizes": [], "hashes": []}, 0
        for end in ends:
            _packed(rows, int(bucket[at]), half, owner[at:end], hashes=flat[at:end])
            at = end
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in ("docs", "sizes", "hashes"))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, held = {}, 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = shingles(t) if i is not None else ()
                if not len(s):
                    continue
                key = set_key(signature(s), seed)
                if key in sets:
                    continue
                sets[key] = s
                held += len(s)
                if held >= BUCKET // 2:
                    yield from flush(sets)
                    sets, held = {}, 0
        if sets:
            yield from flush(sets)

    return docs.mapInArrow(released("jaccard join", run), "bucket int, docs binary, sizes binary, hashes binary")


def _from_bucket(hot: np.ndarray, hot_rank: np.ndarray, buckets: int):
    """In a bucket: one entry per set and shingle, its frequency over sets, sent on to the set's bucket if shared."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        half, owner = _unpacked(part)
        flat = np.concatenate([np.frombuffer(x, np.uint64) for x in part["hashes"]])
        stands = np.zeros(len(half), bool)  # the same set comes once per run of a task
        stands[np.unique(half, return_index=True)[1]] = True
        keep = stands[owner]
        flat, owner = flat[keep], owner[keep]
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
        df = np.repeat(np.diff(np.append(first, len(flat))), np.diff(np.append(first, len(flat)))).astype(np.uint32)
        if len(hot):
            place = np.minimum(np.searchsorted(hot, flat), len(hot) - 1)
            df = np.where(hot[place] == flat, HOT_BASE + hot_rank[place], df).astype(np.uint32)
        shared = df > 1
        flat, owner, df = flat[shared], owner[shared], df[shared]
        to = half[owner] % buckets
        order = np.lexsort((owner, to))
        flat, owner, df, to = flat[order], owner[order], df[order], to[order]
        rows, at = {"bucket": [], "docs": [], "sizes": [], "hashes": [], "dfs": []}, 0
        for end in (np.flatnonzero(np.append(to[1:] != to[:-1], True)) + 1 if len(to) else ()):
            _packed(rows, int(to[at]), half, owner[at:end], hashes=flat[at:end], dfs=df[at:end])
            at = end
        return pd.DataFrame(rows)

    return run


def _boundary(parts: tuple[pd.DataFrame, pd.DataFrame]) -> pd.DataFrame:
    """Of each set with a shared shingle in its window: the window's shared shingles (regions) and all shared ones."""
    part, sets = parts
    rows = {"doc": [], "half": [], "regions": [], "shared": []}
    if not len(part):
        return pd.DataFrame(rows, dtype=object)
    sets = sets.sort_values("half")
    doc, half, size = (sets[c].to_numpy(np.int64) for c in ("doc", "half", "n"))
    keys, owner = _unpacked(part)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in part["hashes"]])
    key = np.searchsorted(half, keys)[owner]
    order = np.lexsort((hashes, np.concatenate([np.frombuffer(x, np.uint32) for x in part["dfs"]]), key))
    hashes, key = hashes[order], key[order]
    at = 0
    for end in (np.flatnonzero(np.append(key[1:] != key[:-1], True)) + 1 if len(key) else ()):
        n = int(size[key[at]])
        own = hashes[at:end]
        window = n - int(at_least(n)) + 1 - (n - len(own))  # what the unshared, rarest shingles leave of it
        if window > 0:
            rows["doc"].append(int(doc[key[at]]))
            rows["half"].append(int(half[key[at]]))
            rows["regions"].append(own[:window].view(np.int64))
            rows["shared"].append(np.sort(own).tobytes())
        at = end
    return pd.DataFrame(rows, dtype=object)


def _boundaries(part: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    return released("jaccard join", _boundary)((part, sets))


def _keyed(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with keys that differ for all their sets, and the seed of the keys."""
    seed = 0
    while True:
        seen = rows.where("sig is not null").select("sig", "half").distinct().agg(F.count(F.lit(1)).alias("sets"), F.countDistinct("half").alias("keys")).first()
        if seen["sets"] == seen["keys"]:
            return rows, seed
        seed += 1
        rows = rows.withColumn("half", F.udf(partial(_key, seed), "long")("sig"))


def _key(seed: int, sig: bytes | None) -> int | None:
    return sig and set_key(bytes(sig), seed)


# --- cells -------------------------------------------------------------------------------------------------

class Links:
    """All links among the documents of a task, as a matrix."""

    def __init__(self, n: np.ndarray, shared: list[bytes]):
        self.n = n
        self.size = np.array([len(s) // 8 for s in shared])
        self.start = np.cumsum(self.size) - self.size
        hashes, codes = np.unique(np.frombuffer(b"".join(shared), np.uint64), return_inverse=True)
        self.codes = codes.astype(np.int32)
        self.mark = np.zeros(len(hashes), bool)
        self.linked = np.zeros((len(n), len(n)), bool)

    def compare(self, members: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        """Distances of members (rows) and pivots (columns); links among them are kept."""
        size = self.size[members]
        begin = np.cumsum(size) - size
        codes = self.codes[np.repeat(self.start[members] - begin, size) + np.arange(size.sum())]
        out = np.empty((len(members), len(pivots)))
        for k, p in enumerate(pivots):
            own = self.codes[self.start[p]:self.start[p] + self.size[p]]
            self.mark[own] = True
            both = np.add.reduceat(self.mark[codes], begin, dtype=np.int64)
            self.mark[own] = False
            union = self.n[members] + self.n[p] - both
            hit = members[100 * both >= PERCENT * union]
            self.linked[p, hit] = self.linked[hit, p] = True
            out[:, k] = 1 - both / union
        return out

    def join(self, members: np.ndarray, pivots: int = PIVOTS) -> None:
        """Finds all links among ``members``: pivots, Voronoi regions, windows, recursion."""
        limit = 1 - PERCENT / 100
        todo = [members]
        while todo:
            region = todo.pop()
            if len(region) <= 2 * pivots:
                if len(region) > 1:
                    self.compare(region, region)
                continue
            chosen = region[::len(region) // pivots][:pivots]
            d = self.compare(region, chosen)
            stays = ~np.isin(region, chosen)
            rest, d = region[stays], d[stays]
            home = d.argmin(axis=1)
            near = d <= d.min(axis=1)[:, None] + 2 * limit + 1e-9
            regions = [rest[near[:, q]] for q in np.unique(home)]
            todo += regions if sum(map(len, regions)) <= 1.5 * len(rest) else [rest]

    def roots(self) -> np.ndarray:
        """The first document that each one is connected with."""
        root = np.full(len(self.n), -1)
        for i in range(len(root)):
            reached = np.array([i]) if root[i] < 0 else np.zeros(0, int)
            while len(reached):
                root[reached] = i
                reached = np.flatnonzero(self.linked[reached].any(axis=0) & (root < 0))
        return root


def _unit(part: pd.DataFrame) -> pd.DataFrame:
    """Of a block or a pair of blocks: each document with links, the first one it is connected with, and how many rows it links with."""
    part = part.sort_values(["n", "doc", "half"], ignore_index=True)
    links = Links(part["n"].to_numpy(np.int64), part["shared"].tolist())
    every, block = np.arange(len(part)), part["block"].to_numpy()
    if part["i"].iloc[0] == part["j"].iloc[0]:
        links.join(every)
    elif (block != block[0]).any():
        links.compare(every[block == block[0]], every[block != block[0]])
    np.fill_diagonal(links.linked, False)
    some = links.linked.any(axis=1)
    counts = links.linked @ part["copies"].to_numpy(np.int64)
    return pd.DataFrame({"doc": part["doc"][some], "half": part["half"][some], "root": part["doc"].to_numpy()[links.roots()[some]], "links": counts[some]})


def _linked(members: DataFrame) -> DataFrame:
    """doc, half, root, links of the members (cell, blocks, doc, half, n, copies, shared) of cells; a row per task that found links."""
    block = F.pmod(F.xxhash64("doc", "half"), F.col("blocks").cast("long")).cast("int")
    units = members.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = units.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("other", "blocks")
    return units.repartition("cell", "i", "j").groupBy("cell", "i", "j").applyInPandas(_unit, "doc long, half long, root long, links long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id, n_links of every row; n_links counts the other rows it is linked with.

    Texts without words (null, empty, blank) have 0 shingles and stand alone. Rows with equal sets
    are linked; a null id takes the component of its set's other rows, or null, and a set that has
    only null ids is linked with equal sets alone. Rows that repeat an id are one node of a component,
    but count as the rows they are in n_links. Texts are read whole, however long. Other columns are
    not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    seen = stored(_summaries(texts), "shingle-sets")
    rows = seen.where("kind = 0").select(F.col("key").alias("doc_id"), "n", "sig", "half")
    rows, seed = _keyed(rows)
    sets = rows.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n"), F.max("half").alias("half"),
                                                              F.count(F.lit(1)).alias("copies"))
    total = rows.agg(F.sum("n").alias("shingles")).first()["shingles"] or 0
    if not total:
        return rows.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    frequent = (seen.where("kind = 1").groupBy("key").agg(F.sum("n").alias("df"))
                .join(sets.agg((F.count(F.lit(1)) * HOT_SHARE).alias("least")), F.col("df") >= F.col("least"))
                .select("key", "df").toPandas())
    hot = frequent["key"].to_numpy(np.int64).view(np.uint64)
    by_hash = np.argsort(hot)
    hot, hot_rank = hot[by_hash], frequent["df"].to_numpy(np.int64)[by_hash].clip(max=HOT_BASE - 1)

    buckets = max(partitions(spark), -(-total // BUCKET))
    back = _to_buckets(texts, hot, buckets, seed).groupBy("bucket").applyInPandas(
        released("jaccard join", _from_bucket(hot, hot_rank, buckets)), "bucket int, docs binary, sizes binary, hashes binary, dfs binary")
    stated = sets.where("doc is not null").select(F.pmod("half", F.lit(buckets).cast("long")).cast("int").alias("bucket"), "doc", "half", "n")
    cores = stored(back.groupBy("bucket").cogroup(stated.groupBy("bucket")).applyInPandas(
        _boundaries, "doc long, half long, regions array<bigint>, shared binary"), "boundaries")

    member = cores.select(F.explode("regions").alias("region"), "doc")
    regions = (member.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.min("doc").alias("least"),
                                            F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("all")).where("m > 1")
               .groupBy("m", "least", "all").agg(F.min("region").alias("region")))
    overlaps = member.join(regions.select("region", "least"), "region").select(F.col("doc").alias("a"), F.col("least").alias("b")).distinct()
    cells = connected_components(overlaps).withColumnRenamed("component", "cell")
    known = cells.join(sets.select("doc", "half", "n", "copies"), cells["node"] == F.col("doc")).drop("node")
    sizes = known.groupBy("cell").agg(F.ceil(F.greatest(F.count(F.lit(1)) / CELL, F.sum("n") / ENTRIES)).cast("int").alias("blocks"))
    members = cores.select("doc", "half", "shared").join(known.join(sizes, "cell"), ["doc", "half"])
    units = stored(_linked(members), "links")
    found = connected_components(units.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    counts = units.groupBy("doc", "half").agg(F.sum("links").alias("links"))

    labels = (sets.join(found, sets["doc"] == found["node"], "left").join(counts, ["doc", "half"], "left")
              .select("sig", F.coalesce("component", "doc").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    alone = F.col("sig").isNull()
    return (rows.drop("half").join(labels, "sig", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links")))


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN size USING (doc_id) JOIN least ON least.x = doc_id LEFT JOIN degree ON degree.x = doc_id
"""
