"""Which sources of a language use its words differently, and which words set a source apart.

Terms are counted per (lang, source) on the map side. A group's most divergent terms come from dominance
skybands: a term's value rises with its count in the group and falls with its count in the language, so a
term with at least k others that have no lower group count, no higher language count and an earlier UTF-8
form can't be among the first k. Each partition keeps the terms dominated by fewer than k others, skybands are merged
in salted groups, and what is left is ranked exactly. Sources of a language are compared with each
other in blocks of terms; only one sum per pair of sources leaves a block.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import partitions, stored

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
TALLIES = 400_000  # distinct (group, term) counts held by a task before they are handed on
BLOCK = 4 << 20  # bytes of text cut into terms at once
CELLS = 50_000  # terms times sources compared in one block, more where the block's pairs would outnumber them
ROWS = 200_000  # rows a task gathers before it reduces them to skybands
#: Bytes of terms stay, A-Z in lower case; all others become spaces.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in lists of about ``BLOCK`` bytes."""
    data = text.encode().translate(LETTERS)
    at = 0
    while len(data) - at > BLOCK:
        cut = data.find(b" ", at + BLOCK)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield data[at:].split()


def tallies(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (rows that hold it), and a row with the term '' for every group."""
    schema = "lang string, source string, term string, n long, docs long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                rows = [("".encode(), 0, 0), *((t, c, docs[t]) for t, c in n.items())]
                for at in range(0, len(rows), 50_000):
                    terms, ns, ds = zip(*rows[at:at + 50_000])
                    size = len(terms)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                         pa.array(terms, pa.binary()).cast(pa.string()), pa.array(ns, pa.int64()), pa.array(ds, pa.int64())],
                        names=["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for b in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in b.columns)):
                group = held.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(group[0]), set()
                for terms in terms_of(text):
                    group[0].update(terms)
                    seen.update(terms)
                group[1].update(seen)
                size += len(group[0]) - before
                if size > TALLIES:
                    yield from flush()
                    size = 0
        yield from flush()

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    return docs.select(text).mapInArrow(run, schema).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def skyband(group: np.ndarray, lang: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that fewer than ``k`` others dominate; ``term`` orders distinct terms.

    Rows are visited so that dominators come first. Counting only rows that are still in the running is enough: the first
    k dominators of a row are themselves dominated by fewer than k.
    """
    order = np.lexsort((term, lang, -group))
    lang, term = lang[order], term[order]
    kept = np.empty(0, np.int64)
    for at in range(0, len(order), 512):
        block = np.arange(at, min(at + 512, len(order)))

        def dominated(by: np.ndarray) -> np.ndarray:
            return (lang[by] <= lang[block, None]) & (term[by] < term[block, None])

        count = dominated(kept).sum(1)
        block, count = block[count < k], count[count < k]
        count = count + np.tril(dominated(block), -1).sum(1)
        kept = np.concatenate([kept, block[count < k]])
    return order[kept]


def _joined(found: list[pd.DataFrame]) -> pd.DataFrame:
    """One frame whose strings are plain objects; chunked columns can't be handed back to Spark."""
    rows = pd.concat(found)
    return rows.astype({c: object for c in rows.columns if not pd.api.types.is_numeric_dtype(rows[c])})


def _skybands(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    for _, part in rows.groupby(["lang", "source"], sort=False):
        term = np.unique(part["term"].to_numpy(object), return_inverse=True)[1]  # code points order as UTF-8 does
        found.append(part.iloc[skyband(part["n"].to_numpy(), part["total"].to_numpy(), term, k)])
    return _joined(found) if found else rows


def skybands(kept: DataFrame, k: int = TOP) -> DataFrame:
    """The rows of ``kept`` (lang, source, term, n, total) that can be among their group's first ``k``."""
    fields = "lang string, source string, term string, n long, total long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, floor = [], 0, 0
        for b in batches:
            held.append(b)
            size += len(b)
            if size > floor + ROWS:
                held = [_skybands(_joined(held), k)]
                size = floor = len(held[0])
        if held:
            yield _skybands(_joined(held), k)

    few = max(1, round(partitions(kept.sparkSession) ** 0.5))
    first = (kept.select("lang", "source", "term", "n", "total").mapInPandas(run, fields)
             .withColumn("salt", F.spark_partition_id() % few))
    return first.groupBy("lang", "source", "salt").applyInPandas(lambda rows: _skybands(rows.drop(columns="salt"), k), fields)


def share(count: Column, size: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (size + 2 * terms)) without rounding."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")
    below = (size + 2 * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


def spread(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(key: tuple, terms: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
    """Sums over one block of terms for each pair of sources; block 0 lists every pair."""
    names = sources["source"].to_numpy(object)
    order = np.argsort(names)
    names, base = names[order], sources["base"].to_numpy()[order]
    codes = pd.factorize(terms["term"])[0] if len(terms) else np.empty(0, np.int64)
    p = np.tile(base, (int(codes.max()) + 1 if len(codes) else 0, 1))
    if len(terms):
        p[codes, pd.Index(names).get_indexer(terms["source"])] = terms["p"].to_numpy()
    found = []
    for i in range(len(names) - 1) if len(p) or key[1] == 0 else ():
        gap, size = p[:, i + 1:] - p[:, i:i + 1], p[:, i + 1:] + p[:, i:i + 1]
        found.append(pd.DataFrame({"lang": key[0], "a": names[i], "b": names[i + 1:], "value": (gap * gap // size).sum(0)}))
    if not found:
        return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []}, dtype=object).astype({"value": "int64"})
    return _joined(found)


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank; the definitions stand in the query's contract.

    Null lang, source and text count as ''. Every row is a document, repeated ids and rows included; ids and
    other columns are not read. Groups without terms are compared like others (all their counts are 0); a language
    without kept terms has value 0 for every pair; one with a single source has no pairs. Ties go to the item that is
    earlier in UTF-8. Texts may be as long as a Spark value. An empty table gives no rows.
    """
    counts = stored(tallies(docs), "op11-tallies")
    term = Window.partitionBy("lang", "term")
    kept = stored(counts.where("term <> ''")
                  .withColumns({"total": F.sum("n").over(term), "in_docs": F.sum("docs").over(term),
                                "first": F.row_number().over(term.orderBy("source"))})
                  .where(F.col("in_docs") >= min_docs)
                  .select("lang", "source", "term", "n", "total", F.when(F.col("first") == 1, 1).otherwise(0).alias("first")), "op11-kept")
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.sum("first").alias("v"))
    sources = counts.where("term = ''").select("lang", "source")
    wide = sources.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = stored(sources.join(wide, "lang").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
                    .na.fill(0, ["n_group", "n_lang", "v"])
                    .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") * F.col("n_sources") / F.greatest(F.lit(CELLS), F.col("n_sources") * F.col("n_sources")))).cast("int")), "op11-groups")

    in_group = kept.join(groups, ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks").cast("long")).cast("int").alias("block")
    blocks = in_group.select("lang", block, "source", "term", share(F.col("n"), F.col("n_group"), F.col("v")).alias("p"))
    base = F.when(F.col("v") > 0, share(F.lit(0), F.col("n_group"), F.col("v"))).otherwise(0)
    everywhere = groups.select("lang", "source", base.alias("base"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    sums = (blocks.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block"))
            .applyInPandas(_pair_sums, "lang string, a string, b string, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("way")
    pairs = sums.select("lang", both, "value").select("lang", "way.source", F.lit("pair").alias("part"), "way.item", "value")

    p = share(F.col("n"), F.col("n_group"), F.col("v"))
    q = share(F.col("total"), F.col("n_lang"), F.col("v"))
    apart = (skybands(kept, top).join(groups, ["lang", "source"]).withColumns({"p": p, "q": q}).where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), spread(F.col("p"), F.col("q")).alias("value")))

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (pairs.withColumn("rank", rank)
            .unionByName(apart.withColumn("rank", rank).where(F.col("rank") <= top)))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
tally AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY lang, source, term),
kept AS (SELECT lang, term, sum(n) AS total FROM tally GROUP BY lang, term HAVING sum(docs) >= 10),
size AS (SELECT lang, count(*) AS v, sum(total) AS n_lang FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, kept.term, kept.total, coalesce(tally.n, 0) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN tally USING (lang, source, term)),
s AS (SELECT lang, source, sum(n) AS n_group FROM c GROUP BY lang, source),
x AS (
  SELECT c.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (n_group + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (total + 2)) // (n_lang + 2 * v) AS q
  FROM c JOIN s USING (lang, source) JOIN size USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM x WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
