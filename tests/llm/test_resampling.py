"""Importance resampling against a plain version and its SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from tests.llm.conftest import EDGES
from tramline.llm import op13_importance_resampling as res

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PARTS = ["a", "B", "Éa", "é", " ", "  ", "\n", "-", "12", "日本", "\x00", "Σ", "ẞ", "İ", "don't", "_", "x" * 50]


def runs(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(runs(text)[1])
    for text in target:
        t.update(runs(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    found = []
    for i, text in rows:
        n, b = runs(text)
        weight = sum(map(gain, b)) // len(b) if b else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        found.append((i, n, len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in found if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[2]))
    drawn = [(*r[:1], *r[2:], k) for k, r in enumerate(able[:25 * len(able) // 100], 1)]
    left = able[len(drawn):] + [r for r in found if r[1] < 20]
    return drawn + [(*r[:1], *r[2:], None) for r in left]


def test_equals_plain_version(docs, spark):
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 3)
    rows = [(k, " ".join(word() for _ in range(rng.randint(0, 60)))) for k in range(300)] + EDGES + [(None, "a b " * 30), (7, "a b " * 30), (7, "c d " * 40)]
    target = [" ".join(word() for _ in range(50)) for _ in range(5)] + [None, ""]
    got = res.importance_scores(docs(rows), docs(list(enumerate(target))))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain(rows, target)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[4] is not None for r in want) > 40
    kept = res.resampled(docs(rows), docs(list(enumerate(target))))
    drawn = {r[0] for r in want if r[4] is not None} - {None}
    assert kept.columns == docs([]).columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i in drawn)


def test_empty_tables(docs):
    assert res.importance_scores(docs([]), docs([])).count() == 0
    rows = [(k, f"w{k} " * 25) for k in range(8)]
    assert sorted(map(tuple, res.importance_scores(docs(rows), docs([])).collect()), key=str) == sorted(plain(rows, []), key=str)
    assert {r["rank"] for r in res.importance_scores(docs(rows[:3]), docs(rows)).collect()} == {None}


def test_blocks_do_not_change_runs(monkeypatch):
    rng = random.Random(4)
    whole, parted = res.WordRuns(10000), res.WordRuns(10000)
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        n, want = runs(text)
        monkeypatch.setattr(res, "BLOCK", 1 << 20)
        assert (whole.features(text)[0], sorted(whole.features(text)[1].tolist())) == (n, sorted(want)), repr(text)
        monkeypatch.setattr(res, "BLOCK", 5)
        assert sorted(parted.features(text)[1].tolist()) == sorted(want), repr(text)


def test_split_gives_words_with_offsets():
    text = "éa 12b\x00日本x"
    assert [(text[a:b], w) for w, (a, b) in res.WordRuns(10).cut.pre_tokenize_str(text)] == [(w, w) for w in WORD.findall(text)]


def test_gain_of_unused_buckets_is_defined():
    assert np.array_equal(res.gains(np.zeros(4, np.int64), np.zeros(4, np.int64)), np.zeros(4))


def test_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    want = con.execute(res.ORACLE)
    names = [d[0] for d in want.description]
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    got = res.importance_scores(read("documents"), read("benchmark"))
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(want.fetchall(), key=str)
