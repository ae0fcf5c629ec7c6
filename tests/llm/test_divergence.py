"""Source divergence against a plain count, skybands against pairwise dominance."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import EDGES
from tramline.llm import op11_source_divergence as div

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_docs=10, top=10):
    """(lang, source, part, item, value, rank) of rows (lang, source, text)."""
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = [t.translate({c: c + 32 for c in range(65, 91)}) for t in TERM.findall(text or "")]
        n[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    found = set()
    for lang in docs:
        kept = [t for t, d in docs[lang].items() if d >= min_docs]
        total = Counter()
        for (of, _), c in n.items():
            if of == lang:
                total.update(c)

        def share(c):
            size = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (size + 2 * len(kept)) for t in kept}

        p, q = {s: share(c) for (of, s), c in n.items() if of == lang}, share(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, values, last in (("pair", pairs, math.inf), ("term", terms, top)):
                for k, (value, item) in enumerate(sorted(values, key=lambda x: (-x[0], x[1].encode())), 1):
                    if k <= last:
                        found.add((lang, s, part, item, value, k))
    return found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [rng.choice("abcxyzé") * rng.randint(1, 2) + rng.choice(["", "Q", "ß", "日"]) + rng.choice("mnop") for _ in range(150)]
    made = []
    for k in range(400):
        lang, source = rng.choice(["en", "de"]), f"s{min(rng.randrange(9), 5)}"
        own = words[sum(map(ord, source)) % 40:]
        made.append((lang, source, rng.choice([" ", "_", "9"]).join(rng.choice(own[:rng.randint(1, 60)]) for _ in range(rng.randint(0, 30)))))
    return [*made, ("en", "quiet", None), ("fr", "a", "rare"), ("fr", "b", ""), (None, None, "x"), ("it", "only", "uno " * 30), *[("it", "only", "uno")] * 12]


def frame(spark, rows):
    return spark.createDataFrame([(t, s, lang, "x", 1) for lang, s, t in rows], "text string, source string, lang string, term string, n long")


def test_equals_plain_count(spark, rows, monkeypatch):
    want = plain(rows)
    assert {tuple(r) for r in div.source_divergence(frame(spark, rows)).collect()} == want
    assert {w[4] for w in want if w[0] == "fr"} == {0} and not any(w[2] == "pair" for w in want if w[0] == "it")
    monkeypatch.setattr(div, "TALLIES", 50)
    monkeypatch.setattr(div, "CELLS", 60)
    monkeypatch.setattr(div, "BLOCK", 20)
    monkeypatch.setattr(div, "ROWS", 40)
    assert {tuple(r) for r in div.source_divergence(frame(spark, rows).repartition(5), min_docs=3, top=4).collect()} == plain(rows, 3, 4)


def test_edge_rows(spark, docs):
    texts = docs([*EDGES, *EDGES, *EDGES])
    assert {tuple(r) for r in div.source_divergence(texts, min_docs=3).collect()} == plain([("en", "s", t) for _, t in EDGES * 3], 3)
    assert div.source_divergence(docs([])).count() == 0


def test_large_counts_stay_exact(spark):
    row = spark.createDataFrame([(8 * 10**17, 9 * 10**17, 10**6)], "n long, size long, v long").select(
        div.share(div.F.col("n"), div.F.col("size"), div.F.col("v")).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (8 * 10**17 + 2) // (9 * 10**17 + 2 * 10**6)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband_is_what_fewer_than_k_dominate(k):
    rng = np.random.default_rng(k)
    for size in (0, 1, 40, 1300):
        group, lang, term = rng.integers(0, 30, size), rng.integers(0, 40, size), rng.permutation(size)
        by = (group[None] >= group[:, None]) & (lang[None] <= lang[:, None]) & (term[None] < term[:, None])
        assert sorted(div.skyband(group, lang, term, k)) == np.flatnonzero(by.sum(1) < k).tolist()


def test_equals_sql(spark):
    con = duckdb.connect()
    path = "/root/testdata/sf0.001/documents.parquet"
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.execute(div.ORACLE)
    names = [d[0] for d in want.description]
    got = div.source_divergence(spark.read.parquet(path))
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
