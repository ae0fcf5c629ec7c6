"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The bytes of all pre-tokens of some texts that aren't known yet form one linked list with edges
between the pre-tokens. Each pair of neighbours whose bytes are a token waits in the
bucket of that token's merge rank. A bitmap over the ranks, with bitmaps over its words above it,
gives the lowest rank in use by find-first-set at each level; a bucket is taken whole, from left to right.
A merge changes two pairs and leaves their old entries behind, which are skipped when they come up.
Should a merge make a pair of a lower rank, the rest of the bucket waits until that pair has been merged.
So n bytes take O(n log n) steps however long a pre-token is, and many short ones share the bitmap's work.
"""

from __future__ import annotations

import array
import base64
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import held
from tramline.llm.tokens import tokenizer_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MEMO = 800_000  # short words and pre-tokens kept per worker, about 150 MB
SHIFT = 8  # a bitmap word has 2 ** SHIFT bits; 50,000 ranks then take two levels
WIDTH, LOW = 1 << SHIFT, (1 << SHIFT) - 1
SHORT = 32  # characters of a pre-token that is kept
LONG = 1 << 18  # bytes of pre-tokens merged together whose links are packed in arrays
BITS = 24  # of a rank in a key of two
GROUP = 1 << 19  # characters of texts whose new pre-tokens are merged together
BLOCK = 1 << 20  # characters cut into pre-tokens at once
BATCH = 8 << 20  # bytes of output that are handed on together
#: A space after anything but white space always begins a pre-token, whatever stands around it.
CUT = regex.compile(r"(?<=\S) ")
#: Without these, each space and line end follows something else and so begins a pre-token.
WIDE = re.compile(r"\s[ \n]")


class RankQueue:
    """Positions by merge rank; ``pop`` gives the lowest rank's leftmost position."""

    def __init__(self, size: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while not self.levels or len(self.levels[-1]) > 1:
            size = (size + WIDTH - 1) >> SHIFT
            self.levels.append([0] * max(size, 1))
        self.down = self.levels[::-1]

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
            return
        self.buckets[rank] = [position]
        for words in self.levels:
            at = rank >> SHIFT
            before = words[at]
            words[at] = before | 1 << (rank & LOW)
            if before:
                return
            rank = at

    def pop(self) -> tuple[int, int] | None:
        """(rank, position), or None when nothing waits."""
        rank = 0
        for words in self.down:
            word = words[rank]
            if not word:
                return None
            rank = (rank << SHIFT) + (word & -word).bit_length() - 1
        bucket = self.buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self.buckets[rank]
        bit = rank
        for words in self.levels:
            at = bit >> SHIFT
            words[at] ^= 1 << (bit & LOW)
            if words[at]:
                break
            bit = at
        return rank, bucket[0]

    def take(self) -> tuple[int, list[int]] | None:
        """(rank, all its positions from left to right), or None when nothing waits."""
        rank = 0
        for words in self.down:
            word = words[rank]
            if not word:
                return None
            rank = (rank << SHIFT) + (word & -word).bit_length() - 1
        bit = rank
        for words in self.levels:
            at = bit >> SHIFT
            words[at] ^= 1 << (bit & LOW)
            if words[at]:
                break
            bit = at
        return rank, sorted(self.buckets.pop(rank))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class ByteBpe:
    """Encodes and decodes with one rank table; holds the queue and the memo of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.bigrams = np.full(1 << 16, -1, np.int64)  # rank by two bytes
        for token, rank in ranks.items():
            if len(token) == 2:
                self.bigrams[token[0] << 8 | token[1]] = rank
        self.memo: dict[str, bytes] = {}  # ids of words: what stands between two spaces, with the first one
        self.parts: dict[str, bytes] = {}  # ids of pre-tokens in words of several and at the head of a text

    @cached_property
    def pairs(self) -> dict[int, int]:
        """Rank of two neighbouring tokens that are a token together, by the first one's rank << BITS | the second one's."""
        ranks = self.ranks
        return {a << BITS | b: rank for token, rank in ranks.items() for k in range(1, len(token))
                if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None}

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as little-endian unsigned 32-bit integers. None of them is empty."""
        joined = b"".join(pieces)
        get, n = self.pairs.get, len(joined)
        buckets, push, take = self.queue.buckets, self.queue.push, self.queue.take
        edge = bytearray(n + 1)  # 1 where a pre-token begins, and at the end
        at = 0
        for piece in pieces:
            edge[at] = 1
            at += len(piece)
        edge[n] = 1
        column = list if n < LONG else (lambda values: array.array("i", values))
        after = column(range(1, n + 2))  # where the part at i ends, which is where the next one begins
        before = column(range(-1, n))
        name = column(map(self.bytes.__getitem__, joined))  # the rank of the part at i
        code = np.frombuffer(joined, np.uint8).astype(np.int64)
        first = np.append(np.where(np.frombuffer(edge, np.uint8)[1:n] == 1, -1, self.bigrams[code[:-1] << 8 | code[1:]]), [-1, -1])
        waiting = column(first.tolist())  # the rank at which the pair at i waits
        order = np.argsort(first, kind="stable")
        order = order[np.searchsorted(first[order], 0):]
        for positions in np.split(order, np.flatnonzero(np.diff(first[order])) + 1) if len(order) else ():
            leftmost, *others = positions.tolist()
            push(waiting[leftmost], leftmost)
            buckets[waiting[leftmost]].extend(others)
        while True:
            entry = take()
            if entry is None:
                break
            rank, positions = entry
            for done, i in enumerate(positions, 1):
                if waiting[i] != rank:
                    continue  # stale: a merge took one of the two parts since
                least = rank
                j = after[i]
                k = after[i] = after[j]
                name[i] = rank
                waiting[j] = waiting[i] = -1
                if not edge[k]:
                    before[k] = i
                    if (new := get(rank << BITS | name[k])) is not None:
                        waiting[i] = new
                        bucket = buckets.get(new)
                        if bucket is None:
                            push(new, i)
                        else:
                            bucket.append(i)  # it is taken whole, and sorted then
                        if new < least:
                            least = new
                if not edge[i]:
                    j = before[i]
                    waiting[j] = -1
                    if (new := get(name[j] << BITS | rank)) is not None:
                        waiting[j] = new
                        bucket = buckets.get(new)
                        if bucket is None:
                            push(new, j)
                        else:
                            bucket.append(j)
                        if new < least:
                            least = new
                if least < rank:
                    for other in positions[done:]:
                        push(rank, other)
                    break
        ids, starts, i = array.array("I"), [], 0
        while i < n:
            if edge[i]:
                starts.append(4 * len(ids))
            ids.append(name[i])
            i = after[i]
        if sys.byteorder != "little":
            ids.byteswap()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]

    def _blocks(self, text: str) -> Iterator[str]:
        """Stretches of about ``BLOCK`` characters, cut where a pre-token begins in any case."""
        at = 0
        while len(text) - at > BLOCK:
            cut = CUT.search(text, at + BLOCK)
            if not cut:
                break
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:] if at else text

    def _cut(self, text: str) -> list[str]:
        """The text before its first space or line end, then what follows each of them, without the space; the whole text where they don't part pre-tokens."""
        return [text] if WIDE.search(text) else text.replace("\n", " \n").split(" ")

    def _ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; a word that is known isn't cut into pre-tokens again, and the new pre-tokens are merged together."""
        memo, parts, find = self.memo, self.parts, self.pattern.findall
        cuts = [self._cut(text) for text in texts]
        heads = [find(cut.pop(0)) for cut in cuts]
        fresh = set(chain.from_iterable(cuts))
        if len(parts) + len(memo) > MEMO:
            parts.clear()
            memo.clear()
        fresh.difference_update(memo)
        parted = {word: find(word if word[:1] == "\n" else " " + word) for word in fresh}
        found, merged = {}, []
        for piece in set(chain.from_iterable(chain(heads, parted.values()))).difference(parts):
            data = piece.encode()
            whole = self.ranks.get(data)
            if whole is not None:
                found[piece] = whole.to_bytes(4, "little")
            else:
                merged.append((piece, data))
        if merged:
            found.update(zip([piece for piece, _ in merged], self.merge([data for _, data in merged]), strict=True))
        for pieces in chain(heads, (pieces for pieces in parted.values() if len(pieces) > 1)):
            for piece in pieces:
                if piece not in parts:
                    parts[piece] = found[piece]
        for word, pieces in parted.items():
            memo[word] = b"".join(map(parts.__getitem__, pieces)) if len(pieces) > 1 else parts[pieces[0]] if pieces[0] in parts else found[pieces[0]]
        for head, cut in zip(heads, cuts, strict=True):
            yield b"".join(chain(map(parts.__getitem__, head), map(memo.__getitem__, cut)))
        for kept, new in ((parts, found), (memo, fresh)):
            for long in [x for x in new if len(x) > SHORT]:
                kept.pop(long, None)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(b"".join(self._ids([block])) for block in self._blocks(text))

    def encode_each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text, with the new pre-tokens of about ``GROUP`` characters merged together."""
        held, size = [], 0
        for text in texts:
            if size + len(text) > GROUP:
                yield from self._ids(held)
                held, size = [], 0
            if len(text) > GROUP:
                yield self.encode(text)
            else:
                held.append(text)
                size += len(text)
        yield from self._ids(held)

    def decode(self, ids: bytes) -> bytes:
        values = array.array("I", ids)
        if sys.byteorder != "little":
            values.byteswap()
        return b"".join(map(self.tokens.__getitem__, values))


def byte_bpe(path: str) -> ByteBpe:
    return held("byte BPE", path, lambda: ByteBpe(load_ranks(path)))


def _by_row(column: pa.Array, convert: Callable[[Iterable], Iterable[bytes]], keep: pa.Array) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """What ``convert`` makes of each value with the rows of ``keep`` it belongs to, in runs of about ``BATCH`` bytes."""
    done, first, size = [], 0, 0
    for k, value in enumerate(convert(value.as_py() for value in column)):
        done.append(value)
        size += len(value)
        if size > BATCH:
            yield keep.slice(first, k + 1 - first), done
            done, first, size = [], k + 1, 0
    if done:
        yield keep.slice(first), done


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids (binary: little-endian unsigned 32-bit integers) of every row's whole text.

    A null text counts as empty: no ids. Ids of rows may be null or repeat; each row gives one row. An empty
    table gives no rows. Other columns are not read. Very long texts are cut into pre-tokens about a million
    characters at a time; a text and its ids must fit one Spark value (2 GB). No shuffle.
    """
    path = tokenizer_path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for b in batches:
            for keys, ids in _by_row(b.column(1), lambda texts: bpe.encode_each(text or "" for text in texts), b.column(0)):
                yield pa.RecordBatch.from_arrays([keys, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                                                 names=[id_col, "n_tokens", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} long, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """All columns of ``encoded`` and ``decoded`` (binary), the bytes that its column ``ids`` stands for; null ids give empty bytes."""
    path = tokenizer_path(vocabulary)
    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    at = [f.name for f in fields].index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for b in batches:
            rows = pa.StructArray.from_arrays(b.columns, names=b.schema.names)
            for kept, texts in _by_row(b.column(at), lambda column: (bpe.decode(ids or b"") for ids in column), rows):
                yield pa.RecordBatch.from_arrays([*kept.flatten(), pa.array(texts, pa.binary())], names=[*b.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return encoded.select([f.name for f in fields]).mapInArrow(run, f"{schema}, decoded binary")


def digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the bytes decoded from them."""
    return decode(encode(docs, vocabulary), vocabulary).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def texts(spark: SparkSession, encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` with ``text``: the decoded bytes as UTF-8."""
    return decode(encoded, vocabulary).withColumn("text", F.col("decoded").cast("string")).drop("decoded")
