"""URL filters, resharding and embedding near-dedup against plain versions."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGES
from tramline.llm import op3_url_filters as urls
from tramline.llm import op6_resharding as shards
from tramline.llm import op8_embedding_dedup as vectors
from tramline.llm.common import connected_components

URLS = [None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?q", "http://a.com", "http://x.example.com/en/1#t", "https://b.net/es/?", "https://b.net/ES/",
        "://net/fr/", "http://c.org/a://b", "http://notexample.com/en/", "http://é.COM/é/ü?x", "http://example.com/en/\n1"]


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    after = rest[cut:]
    return host, after[:min([after.find(c) for c in "?#" if c in after], default=len(after))]


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_rules(spark):
    rows = urls.url_verdicts(spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, score string")).collect()
    for r in rows:
        host, path = parse(URLS[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        rule, verdict = ruled(host, path)
        assert r["rule"] == rule and (verdict is None or r["verdict"] == verdict) and r["verdict"] in ("allow", "block")
    assert {r["verdict"] for r in rows if not URLS[r["page_id"]]} == {"block"} and len(rows) == len(URLS)
    assert urls.url_verdicts(spark.createDataFrame([], "page_id long, url string")).count() == 0


def pad(url):
    """START and the URL, with its host in lower case."""
    head, mark, rest = url.partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    return urls.START * urls.ORDER + (low(head) + mark + low(rest[:cut]) + rest[cut:] if mark else url)


def plain_score(url, every, models):
    """The mean log ratio by counts of all orders at hand, one character after the other."""
    alphabet = len({c for u in every for c in pad(u)[urls.ORDER:]})

    def prob(seen, f, i):
        p = 1 / (alphabet + 1)
        for k in range(urls.ORDER + 1):
            context = sum(n for g, n in seen.items() if len(g) == k + 1 and g[:k] == f[i - k:i])
            if k == 0 or context >= urls.SUPPORT:
                p = (seen[f[i - k:i + 1]] + urls.BACK * p) / (context + urls.BACK)
        return p

    f = pad(url)
    logs = [math.log(prob(models["allow"], f, i) / prob(models["block"], f, i)) for i in range(urls.ORDER, len(f))]
    return sum(logs) / len(logs)


def test_grams_of_odd_urls(spark):
    odd = [u for u in URLS if u is not None] + ["http://x.com/" + "é😀\n" * 3, "HTTP://É.Com?Q=A"]
    rows = spark.createDataFrame(list(enumerate(odd)), "k int, url string").select("k", urls.grams(F.col("url")).alias("g")).collect()
    for r in rows:
        f = pad(odd[r["k"]])
        assert r["g"] == [f[i:i + urls.ORDER + 1] for i in range(len(f) - urls.ORDER)]


def test_contexts_beyond_trigrams_long_urls_and_repeated_ids(spark):
    train = [f"http://{a}{k}.com/{a}xyzw{b}" for k in range(60) for a, b in (("q", "1"), ("r", "2"))]
    train += [f"http://{a}{k}.net/es/{a}xyzw{b}" for k in range(60) for a, b in (("q", "2"), ("r", "1"))]
    same_trigrams = ["http://n.org/qxyzw1//rxyzw2//", "http://n.org/qxyzw2//rxyzw1//"]
    assert Counter(zip(*(same_trigrams[0][k:] for k in range(3)))) == Counter(zip(*(same_trigrams[1][k:] for k in range(3))))
    rows = list(enumerate(train)) + [(7, same_trigrams[0]), (7, same_trigrams[1]), (None, same_trigrams[0]), (8, "http://n.org/" + "qxyzw1/" * 60_000)]
    got = urls.url_verdicts(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()
    by_path = {}
    for r in got:
        by_path.setdefault(r["path"][:14], []).append(r["score"])
    good, bad, long = by_path["/qxyzw1//rxyzw"], by_path["/qxyzw2//rxyzw"], by_path["/qxyzw1/qxyzw1"]
    assert len(good) == 2 and len(set(good)) == 1 and len(bad) == len(long) == 1 and good[0] > bad[0] and long[0] > bad[0]


def test_scores_equal_a_plain_model(spark):
    rng = random.Random(1)
    sites = [f"http://{rng.choice(['good', 'fine', 'calm'])}{k}.example.com/de/{k}" for k in range(200)]
    sites += [f"http://{rng.choice(['spam', 'pills', 'bets'])}{k}.other.net/es/{k}" for k in range(200)]
    sites += [f"http://{w}{k}.example.org/de/{k}" for k in range(40) for w in ("good", "spam")]
    got = {r["page_id"]: r for r in urls.url_verdicts(spark.createDataFrame(list(enumerate(sites)), "page_id long, url string")).collect()}
    models = {}
    for name in ("allow", "block"):
        seen = [pad(u) for u in sites if ruled(*parse(u))[1] == name and zlib.crc32(u.encode()) % urls.FOLDS]
        models[name] = Counter(f[i - k:i + 1] for f in seen for i in range(urls.ORDER, len(f)) for k in range(urls.ORDER + 1))
    for k in (0, 250, 400, 401):
        assert got[k]["score"] == pytest.approx(plain_score(sites[k], sites, models), abs=1e-9)
    undecided = [("spam" in sites[k], got[k]["score"]) for k in range(400, 480)]
    assert max(s for spam, s in undecided if spam) < min(s for spam, s in undecided if not spam)
    cut = min(got[k]["score"] for k in range(480) if got[k]["verdict"] == "allow")
    assert all((r["score"] >= cut) == (r["verdict"] == "allow") for k, r in got.items() if k >= 400)


def test_transfers_move_the_fewest_bytes():
    rng = random.Random(2)
    for _ in range(20):
        sizes = [rng.randint(0, 100) for _ in range(rng.randint(1, 8))]
        n = rng.randint(1, 8)
        capacities = shards.equal_capacities(sum(sizes), n)
        flow = shards.transfers(sizes, capacities)
        assert [sum(b for (i, _), b in flow.items() if i == k) for k in range(len(sizes))] == sizes
        assert all(sum(b for (_, j), b in flow.items() if j == k) <= capacities[k] for k in range(n))
        moved = sum(b for (i, j), b in flow.items() if i != j)
        assert moved == sum(sizes) - sum(min(s, c) for s, c in zip(sizes, capacities, strict=False))
    with pytest.raises(ValueError):
        shards.transfers([5], [4])


def test_reshard_places_every_row(docs):
    rng = random.Random(3)
    rows = [(k, "w" * rng.randint(0, 300)) for k in range(3000)] + EDGES
    out = shards.resharded(docs(rows)).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == sorted(
        (str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    total = Counter()
    slots = {}
    for r in out:
        total[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(total) <= set(range(shards.SHARDS)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shards.resharded(docs([])).count() == 0


def test_reshard_is_even(docs):
    rng = random.Random(3)
    out = shards.resharded(docs([(k, "w" * rng.randint(0, 300)) for k in range(6000)])).groupBy("shard").sum("size").collect()
    sizes = [r[1] for r in out]
    assert max(sizes) - min(sizes) < 0.04 * sum(sizes) / len(sizes)


def brute_links(rows):
    good = [(i, lab, np.array(v, float)) for i, lab, v in rows if lab is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, parent = Counter(), {i: i for i, _, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, lab, x) in enumerate(good):
        for j, other, y in good[k + 1:]:
            if lab == other and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= vectors.COSINE:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {(i, links[i], root(i), root(i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("cell", [512, 16])
def test_near_duplicates(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    rng = np.random.default_rng(4)
    rows = []
    for label in range(3):
        for c in range(30):
            centre = rng.standard_normal(32)
            for _ in range(1 + (c % 5) * 2):
                rows.append((len(rows), label, (centre + rng.standard_normal(32) * 0.04 * (c % 3)).tolist()))
    rows += [(len(rows) + k, 1, rows[5][2]) for k in range(30)]
    n = len(rows)
    rows += [(n, None, rows[0][2]), (n + 1, 0, None), (n + 2, 0, [0.0] * 32), (n + 3, 0, [float("nan")] * 32), (n + 4, 0, []),
             (n + 5, 0, [1.0, None]), (n + 6, 0, [float("inf")] * 32), (n + 7, 0, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, cell string")
    got = {tuple(r) for r in vectors.near_duplicates(df).collect()}
    want = brute_links(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(rows) and true * 0.97 <= found <= true
    assert sum(r[2] == w[2] for r, w in zip(sorted(got), sorted(want), strict=True)) >= 0.97 * len(rows)
    assert vectors.near_duplicates(df.where("false")).count() == 0


def test_near_duplicates_twin(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = {tuple(r) for r in vectors.near_duplicates(spark.read.parquet(f"{sf}/embeddings.parquet")).collect()}
    assert got == set(con.execute(vectors.ORACLE).fetchall())


def test_collisions_equal_comparing_all():
    p = np.random.default_rng(5).standard_normal((40, 6))
    plain = (np.abs(p[:, None] - p[None]) <= 0.3).sum(-1)
    assert np.array_equal(vectors.collisions(p, 0.3), plain)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1040)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent if any(n in e for e in edges if e[0] != e[1])}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
