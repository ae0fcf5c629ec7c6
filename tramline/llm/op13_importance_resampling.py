"""Importance resampling towards a target: documents whose word runs look like the target's are drawn more often.

An untrained pre-tokeniser (a regular-expression Split over ASCII-lowered text) gives words with offsets.
Windows over neighbouring offset pairs give the word runs, whose CRC buckets are kept per document in
shared files. Bucket histograms of the corpus and the target give each bucket a gain; a document's
weight is the mean of its buckets' gains, and Gumbel noise from its id turns the highest scores into a draw without
replacement. Places are dealt by score ranges, so no task sorts more than its share.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

from tramline.llm.common import held, partitions, stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
MEMO = 400_000  # words kept per worker, about 100 MB
BLOCK = 1 << 20  # characters pre-tokenised at once
BATCH = 8 << 20  # bytes of output that are handed on together
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = regex.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


class WordRuns:
    """Buckets of all runs of one and two words of a text; holds the memo of one worker."""

    def __init__(self, buckets: int):
        self.cut = Split(Regex(WORD), "removed", invert=True)
        self.buckets = buckets
        self.words: dict[str, tuple[bytes, int, int]] = {}

    def word(self, text: str) -> tuple[bytes, int, int]:
        """UTF-8, CRC, and the CRC with one space behind, from which a run goes on."""
        data = text.encode()
        return data, zlib.crc32(data), zlib.crc32(data + b" ")

    def _blocks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK:
            gap = GAP.search(text, at + BLOCK)
            if not gap:
                break
            yield text[at:gap.start()]
            at = gap.start()
        yield text[at:]

    def features(self, text: str) -> tuple[int, np.ndarray]:
        """(number of words, bucket of every run); runs go on over the ends of blocks."""
        memo, crc32 = self.words, zlib.crc32
        n, open_run, found = 0, None, []
        for block in self._blocks(text.encode().lower().decode()):  # of bytes, lower() changes A-Z only
            cut = self.cut.pre_tokenize_str(block)
            words = []
            for piece, _ in cut:
                entry = memo.get(piece)
                if entry is None:
                    if len(memo) > MEMO:
                        memo.clear()
                    entry = self.word(piece)
                    if len(piece) < 40:
                        memo[piece] = entry
                words.append(entry)
            if not words:
                continue
            n += len(words)
            singles = [w[1] for w in words]
            starts = [w[2] for w in words]
            doubles = [crc32(w[0], start) for start, w in zip(starts, words[1:])]
            if open_run is not None:
                doubles.append(crc32(words[0][0], open_run))
            open_run = starts[-1]
            found.append(np.array(singles + doubles, np.uint32) % self.buckets)
        return n, (np.concatenate(found) if found else np.empty(0, np.uint32)).astype("<u2")


def _runs(buckets: int) -> WordRuns:
    return held("word runs", buckets, lambda: WordRuns(buckets))


def run_buckets(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, runs (binary: one little-endian unsigned 16-bit bucket per run) of every row's whole text."""
    if not 0 < buckets <= 65_536:
        raise ValueError("buckets must fit 16 bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _runs(buckets)

        def batch(keys: list, words: list, parts: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.int64()), pa.array(parts, pa.binary())],
                                              names=[id_col, "n_words", "runs"])

        for b in batches:
            keys, words, parts, size = [], [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                n, found = runs.features(text.as_py() or "")
                keys.append(key)
                words.append(n)
                parts.append(found.tobytes())
                size += len(parts[-1])
                if size > BATCH:
                    yield batch(keys, words, parts)
                    keys, words, parts, size = [], [], [], 0
            yield batch(keys, words, parts)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} long, n_words long, runs binary")


def histogram(runs: DataFrame, buckets: int) -> np.ndarray:
    """Runs per bucket: one array per task, then one row per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for value in b.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer() or b"", "<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    for r in runs.select("runs").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]  # at most one row per bucket
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of each of B buckets, in doubles."""
    b = len(corpus)
    above, below = float(corpus.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * above / ((float(s) + 1) * below)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weights(runs: DataFrame, gain: np.ndarray, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, n_words, n_features and the floored mean gain of its runs (none: 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, weight = [], []
            for value in b.column(2):
                found = np.frombuffer(value.as_buffer() or b"", "<u2")
                n.append(len(found))
                weight.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())],
                                             names=[id_col, "n_words", "n_features", "weight"])

    return runs.mapInArrow(run, f"{id_col} long, n_words long, n_features long, weight long")


def ranked(scored: DataFrame, percent: int, min_words: int, id_col: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``: places 1, 2, 3... of the first ``percent`` % of rows with ``min_words``, by score, then id; else null.

    Rows go to score ranges and are numbered inside them; a range's first place is the sum of the sizes before it.
    """
    order = [F.desc("able"), F.desc("score"), F.asc(id_col), F.asc("n_features"), F.asc("weight")]
    able = (F.col("n_words") >= min_words).cast("int")
    dealt = stored(scored.withColumn("able", able).repartitionByRange(partitions(scored.sparkSession), *order)
                   .sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "op13-ranges")
    part = F.shiftright("place", 33).cast("int")
    first, n, starts = 0, 0, []
    for r in dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("able").alias("able")).orderBy("part").collect():
        starts.append((r["part"], first))  # one row per range
        first += r["n"]
        n += r["able"]
    before = F.broadcast(scored.sparkSession.createDataFrame(starts, "part int, before long"))
    place = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (dealt.withColumn("part", part).join(before, "part").withColumn("place", place)
            .withColumn("rank", F.when(F.col("place") <= percent * n // 100, F.col("place"))).drop("part", "before", "place", "able"))


def importance_scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS,
                      seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_features, weight, score, rank of every row.

    A null text has no words: 0 features, weight 0, never drawn. A null id takes part with the empty string in place of the id;
    equal scores go to the smaller id, null first, and rows that share an id to the one with fewer features. Other columns
    are not read. A text may be as long as a Spark value. An empty table gives no rows; an empty target gives each bucket the same
    treatment with t = T = 0. Two bytes per run are written to shared storage, as texts are read once only.
    """
    runs = stored(run_buckets(docs, buckets, id_col, text_col), "op13-runs")
    ids = target.select(F.lit(None).cast("long").alias(id_col), F.col(text_col))
    gain = gains(histogram(runs, buckets), histogram(run_buckets(ids, buckets, id_col, text_col), buckets))
    salted = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(salted, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weights(runs, gain, id_col).withColumn("score", F.col("weight") + noise)
    return ranked(scored, percent, min_words, id_col).select(id_col, "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose id was drawn, all columns; rows that share an id share its fate, null ids are not drawn."""
    id_col = options.get("id_col", "doc_id")
    drawn = importance_scores(docs, target, **options).where("rank is not null").select(F.col(id_col).cast(docs.schema[id_col].dataType))
    return docs.join(drawn.distinct(), id_col, "left_semi").select(docs.columns)


ORACLE = r"""
WITH text AS (
  SELECT 0 AS side, row_number() OVER () AS r, text FROM documents UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM text),
feature AS (
  SELECT side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feature)),
-- CRC-32, four bits at a time; the fixed values are the remainders of the numbers 0 to 15
crc AS (
  SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, len(h)),
      lambda k: (strpos('0123456789ABCDEF', substr(h, CASE WHEN k % 2 = 0 THEN k + 2 ELSE k END, 1)) - 1)::BIGINT)),
    lambda c, x: xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,
                              3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][1 + (xor(c, x) & 15)]::BIGINT)),
    4294967295::BIGINT) % 10000 AS bucket FROM hexed),
hit AS (SELECT side, r, bucket FROM feature JOIN crc USING (f)),
total AS (SELECT count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM hit),
bucket AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM hit GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((bucket.t + 1)::DOUBLE * (total.s + 10000)::DOUBLE / ((bucket.s + 1)::DOUBLE * (total.t + 10000)::DOUBLE)))::BIGINT AS g
  FROM bucket, total),
mean AS (SELECT r, count(*) AS n, sum(g)::BIGINT AS g FROM hit JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
doc AS (SELECT doc_id, row_number() OVER () AS r FROM documents),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
    CASE WHEN n IS NULL THEN 0 WHEN g < 0 THEN -((-g + n - 1) // n) ELSE g // n END AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM doc JOIN words ON words.r = doc.r AND side = 0 LEFT JOIN mean ON mean.r = doc.r),
final AS (
  SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM scored),
able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM final WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN place <= (25 * n) // 100 THEN place END AS rank
FROM final LEFT JOIN able USING (doc_id)
"""
