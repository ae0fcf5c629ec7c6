"""Benchmark decontamination by latent semantic retrieval.

The texts are cut into words twice: once to store each word's benchmark term (two bytes), from which
both statistics are summed, and once for the search.

1. document frequencies of the benchmark's terms over all passages;
2. a sketch Z = C W of the passages' Gram matrix C = A'A (A: passages by terms, TF-IDF rows of
   length one; W: a random matrix), summed over the tasks as a tree. The Nystroem form
   Z (W'Z)^-1 Z' of the sketch gives C's leading eigenvectors, which are A's right singular vectors:
   a randomised SVD in one pass. Benchmark items take part as passages that together weigh as much
   as the corpus.
3. windows of every text, projected to the latent space, against all items by cosine. Candidates are
   compared word by word: longest common subsequence against the item and, where a column gives the
   item's answer, of the answer against the same place. Without one the item's subsequence decides.

An item is searched in a text only if the whole text holds enough of its words for the subsequence
asked for, and at a window only if the place around it does; both bounds are exact, so they drop no
leak. Words outside the benchmark play no part in the search, however many or common they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import release, released, stored

WORD = re.compile(r"[^\W_]+")
#: One-byte letters in lower case, which is one byte again, and spaces for what isn't part of a word.
FOLD = "".join(c.lower() if WORD.fullmatch(c) else " " for c in map(chr, range(256))).encode("latin-1")
PRODUCT = 1 << 18  # multiplications of one matrix product; larger ones would start threads that wait more than they work
TOGETHER = 4000  # terms of passages multiplied at once, so that their rows stay in the processor's cache


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 14  # benchmark terms are hashed into so many (at most 1 << 15: ids are stored in two bytes)
    rank: int = 64
    oversample: int = 16
    passage: int = 32  # words of a passage in the statistics
    window: int = 24
    stride: int = 8
    cosine: float = 0.3  # least latent cosine of a candidate
    lcs: float = 0.7  # least common subsequence over the item's words
    answer: float = 0.6  # the same for the answer's words, of items with an answer
    seed: int = 11


def words_of(text: str | None) -> list[str]:
    """Matches of ``WORD`` in lower case; texts of one-byte letters are folded and cut without the pattern."""
    try:
        return (text or "").encode("latin-1").translate(FOLD).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORD.findall(text.lower())


def lcs_length(a: list[str], b: list[str]) -> int:
    """Longest common subsequence by bit-parallel rows over ``a``."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for w in b:
        hit = places.get(w)
        if hit:
            u = row & hit
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


class Items:
    """The stated benchmark: its items' words, terms and answers. Items without words are left out."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]], s: Settings):
        self.ids, self.words, self.answers = [], [], []
        for i, text, answer in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
            if words := words_of(text):
                self.ids.append(i)
                self.words.append(words)
                self.answers.append(words_of(answer))
        self.term = {w: zlib.crc32(w.encode("utf-8", "surrogatepass")) % s.features for ws in self.words for w in ws}

    def rows(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.words), len(idf)), np.float32)
        for k, ws in enumerate(self.words):
            f = np.unique([self.term[w] for w in ws])
            out[k, f] = idf[f] / max(1e-9, np.sqrt((idf[f] ** 2).sum()))
        return out


def _summed(parts: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Sum of one binary float64 matrix per task, as a tree over the executors; the driver gets one matrix."""
    return (parts.rdd.map(lambda r: np.frombuffer(r[0], np.float64)).treeReduce(np.add, depth=3)).reshape(shape)


def _flat(texts: list, term: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Term of every word (-1: not in the benchmark) and the number of words of each text."""
    get, ids, sizes = term.get, [], []
    for t in texts:
        ws = words_of(t)
        ids.append(np.array(list(map(get, ws, repeat(-1))), np.int32))
        sizes.append(len(ws))
    return np.concatenate(ids) if ids else np.zeros(0, np.int32), np.array(sizes, np.int64)


def _passages(sizes: np.ndarray, length: int) -> np.ndarray:
    """Passage number of every word; passages end with their text."""
    starts = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) - np.repeat(starts, sizes)
    first = np.concatenate([[0], np.cumsum(-(-sizes // length))[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    return np.repeat(first, sizes) + at // length


def _groups(texts: list, most: int = 400_000) -> Iterator[list]:
    """Texts in runs of about ``most`` characters, so that no batch of long texts is held as words at once."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t or "")
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


def term_ids(docs: DataFrame, items: Items) -> DataFrame:
    """Term of every word of all texts, two bytes each, and the texts' sizes; a row is one run of texts."""
    term = docs.sparkSession.sparkContext.broadcast(items.term)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for texts in _groups(b.column(0).to_pylist()):
                f, sizes = _flat(texts, term.value)
                yield pa.RecordBatch.from_arrays([pa.array([f.astype(np.int16).tobytes()], pa.binary()),
                                                  pa.array([sizes.astype(np.int32).tobytes()], pa.binary())], names=["terms", "sizes"])

    return docs.select("text").mapInArrow(released("decontamination", run), "terms binary, sizes binary")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for b in batches:
        for terms, sizes in zip(b.column(0), b.column(1), strict=True):
            yield np.frombuffer(terms.as_buffer(), np.int16).astype(np.int64), np.frombuffer(sizes.as_buffer(), np.int32).astype(np.int64)


def frequencies(terms: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """Passages with each term, and the number of passages, over all texts (``term_ids``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(s.features + 1)
        for f, sizes in _runs(batches):
            counts[-1] += (-(-sizes // s.passage)).sum()
            p, known = _passages(sizes, s.passage), f >= 0
            pairs = np.unique(p[known] * s.features + f[known])
            counts[:-1] += np.bincount(pairs % s.features, minlength=s.features)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], names=["part"])

    total = _summed(terms.mapInArrow(released("decontamination", run), "part binary"), (1, s.features + 1))[0]
    return total[:-1], int(total[-1])


def latent_space(terms: DataFrame, items: Items, idf: np.ndarray, rare: float, s: Settings) -> np.ndarray:
    """Leading right singular vectors (terms by rank) of all passages and the weighted items."""
    width = s.rank + s.oversample
    omega = np.random.default_rng(s.seed).standard_normal((s.features, width)).astype(np.float32)
    shared = terms.sparkSession.sparkContext.broadcast(idf.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        omega = np.random.default_rng(s.seed).standard_normal((s.features, width)).astype(np.float32)
        z, energy = np.zeros((s.features, width)), 0.0
        for f, sizes in _runs(batches):
            p, known = _passages(sizes, s.passage), f >= 0
            pairs = np.unique(p[known] * s.features + f[known])
            if not len(pairs):
                continue
            row, col = np.divmod(pairs, s.features)
            n = int(row[-1]) + 1
            square = np.bincount(row, weight[col] ** 2, n) + rare ** 2 * np.bincount(p[~known], minlength=n)[:n]
            a = (weight[col] / np.sqrt(square)[row]).astype(np.float32)
            energy += float((a ** 2).sum())
            cuts = np.searchsorted(row, np.unique(row[::TOGETHER])).tolist()
            for i, j in zip(cuts, [*cuts[1:], len(row)], strict=True):
                r, c, part = row[i:j], col[i:j], a[i:j]
                used, at = np.unique(r, return_index=True)
                y = np.add.reduceat(part[:, None] * omega[c], at)
                order = np.argsort(c, kind="stable")
                hit, first = np.unique(c[order], return_index=True)
                place = np.searchsorted(used, r[order])
                z[hit] += np.add.reduceat(part[order, None] * y[place], first)
        last = np.zeros((1, width))
        last[0, 0] = energy
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([z, last]).tobytes()], pa.binary())], names=["part"])

    total = _summed(terms.mapInArrow(released("decontamination", run), "part binary"), (s.features + 1, width))
    z, energy = total[:-1].copy(), total[-1, 0]
    t = items.rows(idf).astype(np.float64)
    z += max(energy, 1.0) / max(1, len(t)) * (t.T @ (t @ omega))
    shift = 1e-8 * np.linalg.norm(z) + 1e-12
    z += shift * omega
    core = omega.T.astype(np.float64) @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max() * 1e-10
    u, _, _ = np.linalg.svd(z @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    return u[:, :s.rank].astype(np.float32)


class Search:
    """Finds leaks of the items in one text."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray, s: Settings):
        self.items, self.s = items, s
        self.vector = np.concatenate([space * idf[:, None], np.zeros((1, space.shape[1]))]).astype(np.float32)
        latent = items.rows(idf) @ space
        self.at_once = max(1, PRODUCT // max(1, self.vector.shape[1] * len(items.ids)))
        self.counts = [list(Counter(ws).items()) for ws in items.words]
        sizes = np.array([len(ws) for ws in items.words])
        self.flat = np.array([items.term[w] for ws in items.words for w in ws])
        self.first = np.cumsum(sizes) - sizes
        self.least = s.lcs * sizes
        self.spare = np.maximum(4, sizes)  # words of the place before and after a window
        self.terms = [np.unique(part) for part in np.split(self.flat, self.first[1:])]
        self.seen = np.zeros(s.features + 1, bool)
        self.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def text(self, text: str | None) -> list[tuple[int, int, int, float, int, float | None]]:
        """Item, words in common, first word of the place, cosine, words of the item, part of the answer if it has one; best per item."""
        s, words = self.s, words_of(text)
        n = len(words)
        if not n:
            return []
        f = np.array(list(map(self.items.term.get, words, repeat(-1))), np.int64)
        able = self._able(f)
        if not len(able):
            return []
        starts = np.unique(np.append(np.arange(0, max(1, n - s.window), s.stride), max(0, n - s.window)))
        near = self._near(f, able, starts)
        pick = np.flatnonzero(near.any(axis=0))
        best: dict[int, tuple] = {}
        latent_items = self.latent[able].T
        padded = np.append(f, np.full(s.window, -1))  # -1 reads the vector of zeros
        for at in range(0, len(pick), self.at_once):
            now = pick[at:at + self.at_once]
            first = starts[now]
            latent = self.vector[padded[first[:, None] + np.arange(s.window)]].sum(1)
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
            cosines = latent @ latent_items
            for w, k in zip(*(x.tolist() for x in np.nonzero((cosines >= s.cosine) & near[:, now].T)), strict=True):
                self._compare(int(able[k]), float(cosines[w, k]), words, int(first[w]), best)
        return [(self.items.ids[k], *v) for k, v in sorted(best.items())]

    def _able(self, f: np.ndarray) -> np.ndarray:
        """Items that have enough of their words anywhere in a text with these terms; no other can share so long a subsequence."""
        self.seen[f] = True
        self.seen[-1] = False  # words outside the benchmark
        able = np.flatnonzero(np.add.reduceat(self.seen[self.flat], self.first, dtype=np.int64) >= self.least)
        self.seen[f] = False
        return able

    def _near(self, f: np.ndarray, able: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per item and window, whether the place around the window holds so many of the item's words as the subsequence asks for."""
        near = np.zeros((len(able), len(starts)), bool)
        for i, k in enumerate(able.tolist()):
            self.seen[self.terms[k]] = True
            held = np.concatenate([[0], np.cumsum(self.seen[f])])  # -1 reads the last: never seen
            self.seen[self.terms[k]] = False
            spare = self.spare[k]
            near[i] = held[np.minimum(starts + self.s.window + spare, len(f))] - held[np.maximum(starts - spare, 0)] >= self.least[k]
        return near

    def _compare(self, k: int, cosine: float, words: list[str], start: int, best: dict[int, tuple]) -> None:
        item, answer, s = self.items.words[k], self.items.answers[k], self.s
        spare = int(self.spare[k])
        a, b = max(0, start - spare), start + s.window + spare
        place = words[a:b]
        here = set(place)
        if sum(n for w, n in self.counts[k] if w in here) < s.lcs * len(item):
            return  # no common subsequence is longer than the item's words that are here at all
        common = lcs_length(item, place)
        if common < s.lcs * len(item):
            return
        part = lcs_length(answer, place) / len(answer) if answer else None
        if (part is None or part >= s.answer) and (k not in best or common > best[k][0]):
            best[k] = (common, a, cosine, len(item), part)


FOUND = "doc_id long, item_id long, lcs_words int, place int, cosine double, item_words int, answer_share double"


def model(docs: DataFrame, benchmark: DataFrame, s: Settings, item_col: str, item_text_col: str, answer_col: str | None) -> Search | None:
    """The search over a stated benchmark, which is held whole; None if no item has words."""
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col).cast("long"), F.col(item_text_col).cast("string"), answer).collect()
    items = Items([tuple(r) for r in rows], s)
    if not items.ids:
        return None
    terms = stored(term_ids(docs, items), "terms")
    df, n = frequencies(terms, s)
    idf = np.log((2 + n) / (1 + df))
    rare = float(np.log(2 + n))
    search = Search(items, idf, latent_space(terms, items, idf, rare, s), s)
    release()  # the driver lives on as well
    return search


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """One row per leaked item of each contaminated row of ``docs``; clean rows give none.

    Null and empty texts and items are clean. Ids may be null or repeat; other columns are not read.
    ``answer_share`` is null for items without an answer.
    No shuffle of texts: term ids are stored, two tree sums of matrices of fixed size, then one search pass.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    search = model(texts, benchmark, settings, item_col, item_text_col, answer_col)
    if search is None:
        return texts.where("false").select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (p.split() for p in FOUND.split(", ")[1:])])
    shared = docs.sparkSession.sparkContext.broadcast(search)
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.float64()]
    names = [p.split()[0] for p in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *row) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                     for row in shared.value.text(t)]
            columns = zip(*found, strict=True) if found else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts.mapInArrow(released("decontamination", run), FOUND)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), text_col: str = "text",
                        item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a leak, all columns as they are."""
    search = model(docs.select(F.col(text_col).cast("string").alias("text")), benchmark, settings, item_col, item_text_col, None)
    if search is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(search)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([not shared.value.text(t) for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(released("decontamination", run), docs.schema)
