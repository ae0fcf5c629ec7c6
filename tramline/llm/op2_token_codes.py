"""Token-id output as directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of every id,
level k the chunk k of those ids that have one. A bitmap per level says whether an id continues on
the next level, and a rank directory counts the ones before every 512th bit, so the place on the
next level is one directory entry plus at most eight words of popcount. Any token is read with one
step per level; nothing before it is decoded.

Files: Parquet rows of one segment each (about a million ids, cut between documents), with the
documents' ids and ends and the code bytes. ``shard`` is a range of document ids.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import partitions
from tramline.llm.tokens import tokenizer_path, word_ids
from tramline.session import scratch_dir

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
SEGMENT = 1 << 20
MAGIC = b"DAC1"
STEP = 512  # bits between entries of a rank directory


def dac_encode(ids: np.ndarray) -> bytes:
    """Header (magic, levels, count), then per level: count, chunks, bitmap, rank directory."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (STEP // 8), np.uint8)])
        ones = np.bitwise_count(bits).reshape(-1, STEP // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class DacReader:
    """Views into the bytes of one segment; ``ids[i]`` reads token i."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token segment")
        n_levels, self.n = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // STEP)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, blocks * STEP // 8, at + 8 + n)
            at += 8 + n + blocks * STEP // 8
            self.levels.append((chunks, bits, np.frombuffer(data, "<u4", blocks, at)))
            at += 4 * blocks

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            start = i // STEP * (STEP // 8)
            i = int(ranks[i // STEP]) + int(np.bitwise_count(bits[start:byte]).sum()) + int(bits[byte] & (1 << bit) - 1).bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id of the segment, level by level from the last."""
        upper = np.zeros(0, np.uint32)
        for chunks, bits, _ in reversed(self.levels):
            now = chunks.astype(np.uint32)
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            now[more] |= upper << np.uint32(8)
            upper = now
        return upper


FILE_SCHEMA = ("shard int, segment int, first_token long, n_tokens long, min_doc_id long, max_doc_id long, "
               "doc_ids array<bigint>, doc_ends array<bigint>, code binary")


def _cuts(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """Ends of n ranges of ids with about equally many documents each."""
    if n < 2:
        return []
    found = docs.select(F.col(id_col).cast("double").alias("x")).approxQuantile("x", [k / n for k in range(1, n)], 0.1 / n)
    return sorted({int(x) for x in found})


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                 shards: int | None = None, segment: int = SEGMENT,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every text, appends ``end_id`` and writes the ids in ascending id order.

    A null text is an empty document (its only id is ``end_id``). A null id comes first; repeated
    ids stay as rows of their own, ordered by their ids' bytes. Texts are encoded where they are
    read, so the one shuffle moves two bytes per id, dealt by ranges of ``id_col``; each range is
    sorted and coded as a stream of segments. Other columns are not read.
    """
    file = tokenizer_path(vocabulary)
    n = shards or partitions(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cuts = _cuts(docs, "doc_id", n)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = word_ids(file), struct.pack("<I", end_id)
        for b in batches:
            ids = b.column(0).to_pylist()
            codes = [_narrow(words.encode(t or "") + end) for t in b.column(1).to_pylist()]
            shard = [0 if i is None else bisect_right(cuts, i) for i in ids]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), b.column(0), pa.array(codes, pa.binary())],
                                             names=["shard", "doc_id", "ids"])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # State of the shard in hand; a partition may hold several shards one after the other.
        shard, number, first, ids, ends, parts, held = None, 0, 0, [], [], [], 0

        def flush():
            known = [i for i in ids if i is not None]
            row = {"shard": shard, "segment": number, "first_token": first, "n_tokens": held,
                   "min_doc_id": min(known, default=None), "max_doc_id": max(known, default=None),
                   "doc_ids": list(ids), "doc_ends": list(ends), "code": dac_encode(np.concatenate(parts))}
            return pa.RecordBatch.from_pylist([row], schema=SEGMENTS)

        for b in batches:
            for s, i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if parts and (s != shard or held >= segment):
                    yield flush()
                    number, first, ids, ends, parts, held = number + 1, first + held, [], [], [], 0
                if s != shard:
                    shard, number, first = s, 0, 0
                new = _wide(raw)
                held += len(new)
                ids.append(i)
                ends.append(held)
                parts.append(new)
        if parts:
            yield flush()

    coded = docs.mapInArrow(encode, "shard int, doc_id long, ids binary")
    (coded.repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(code, FILE_SCHEMA).write.option("compression", "zstd").parquet(path))


SEGMENTS = pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int64()),
                      ("min_doc_id", pa.int64()), ("max_doc_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_ends", pa.list_(pa.int64())), ("code", pa.binary())])


def _narrow(ids: bytes) -> bytes:
    """Two bytes an id on the way if all fit, else four; the last byte tells which."""
    wide = np.frombuffer(ids, "<u4")
    return wide.astype("<u2").tobytes() + b"\x02" if wide.max() < 1 << 16 else ids + b"\x04"


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[:-1], "<u2" if raw[-1] == 2 else "<u4").astype(np.uint32)


def read_tokens(spark: SparkSession, path: str, starts_only: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (binary) of every document in the files.

    Where shards begin is the running sum of one total per shard, held on the driver; the number of
    shards is fixed when the files are written.
    """
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    begin, at = {}, 0
    for r in sorted(files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()):
        begin[r["shard"]], at = at, at + r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, base = DacReader(r["code"]).all().astype("<u4"), begin[r["shard"]] + r["first_token"]
                from_ = [0, *r["doc_ends"][:-1]]
                bodies = [ids[i:j].tobytes() for i, j in zip(from_, r["doc_ends"], strict=True)]
                n = pa.array([len(x) // 4 for x in bodies], pa.int64())
                out = [pa.array(r["doc_ids"], pa.int64()), pa.array([base + i for i in from_], pa.int64()), n]
                last = pa.array([zlib.crc32(x) for x in bodies], pa.int64()) if starts_only else pa.array(bodies, pa.binary())
                yield pa.RecordBatch.from_arrays([*out, last], names=["doc_id", "start", "n_tokens", "last"])

    out = files.select("shard", "first_token", "doc_ids", "doc_ends", "code").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, last {'long' if starts_only else 'binary'}")
    return out.withColumnRenamed("last", "ids_crc32" if starts_only else "ids")


def token_of(spark: SparkSession, path: str, doc_id: int, k: int) -> int:
    """Token ``k`` of a document: the row group is found by its id range, the token by one step per level."""
    rows = (spark.read.schema(FILE_SCHEMA).parquet(path)
            .where((F.col("min_doc_id") <= doc_id) & (F.col("max_doc_id") >= doc_id))
            .where(F.array_contains("doc_ids", F.lit(doc_id).cast("long"))).orderBy("shard", "segment").limit(1).collect())
    if not rows:
        raise KeyError(doc_id)
    at = rows[0]["doc_ids"].index(doc_id)
    first = rows[0]["doc_ends"][at - 1] if at else 0
    if not 0 <= k < rows[0]["doc_ends"][at] - first:
        raise IndexError(k)
    return DacReader(rows[0]["code"])[first + k]


def token_codes(docs: DataFrame, **options) -> DataFrame:
    """Writes the files below the shared folder and gives doc_id, start, n_tokens, ids_crc32 read back from them."""
    path = scratch_dir(docs.sparkSession, "token-codes")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path, starts_only=True)
