"""Byte-level BPE against the library."""

import array
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tests.llm.conftest import EDGES
from tramline.llm import op12_byte_bpe as bpe
from tramline.llm.tokens import tokenizer_path

PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'LL", "é", "ß", "é", "<|endoftext|>", "12", "½", "_", "...", "\x1c", "\x85", "　",
         "日本", "Σ", "😀", "\r\n", "​", "don't", " the", "привет", "\x00", "aaaa", "zq"]


@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(tokenizer_path(bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(library, text):
    return array.array("I", library.encode_ordinary(text)).tobytes()


def test_ids_equal_the_library(library):
    rng, own = random.Random(3), bpe.byte_bpe(tokenizer_path(bpe.VOCABULARY))
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        assert own.encode(text) == ids_of(library, text), repr(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_very_long_pre_tokens(library):
    rng, own = random.Random(5), bpe.byte_bpe(tokenizer_path(bpe.VOCABULARY))
    for alphabet in ("a", "ab", "etaoins", "=-", "éß", "0123456789"):
        for n in (99, 100, 101, 20_000):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert own.encode(text) == ids_of(library, text)
    assert not own.queue.buckets and not any(map(any, own.queue.levels))


def test_blocks_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 7)
    rng, own = random.Random(6), bpe.ByteBpe(bpe.load_ranks(tokenizer_path(bpe.VOCABULARY)))
    for _ in range(1500):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(5, 40)))
        assert own.encode(text) == ids_of(library, text), repr(text)


def test_queue_gives_lowest_rank_then_leftmost():
    rng, queue = random.Random(1), bpe.RankQueue(300_000)
    entries = [(rng.choice([0, 63, 64, 4095, 4096, 299_999, rng.randrange(300_000)]), k) for k in range(2000)]
    rng.shuffle(entries)
    for entry in entries:
        queue.push(*entry)
    assert [queue.pop() for _ in entries] == sorted(entries) and queue.pop() is None
    assert bpe.RankQueue(1).pop() is None


def test_edge_rows(docs, library):
    rows = [*EDGES, (9, "x" * 5000), (10, "\x00퟿")]
    got = sorted(map(tuple, bpe.digests(docs(rows)).collect()), key=str)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = [(i, len(ids_of(library, t or "")) // 4, sha(ids_of(library, t or "")), sha((t or "").encode())) for i, t in rows]
    assert got == sorted(want, key=str)
    assert bpe.digests(docs([])).count() == 0


def test_decode_keeps_columns(spark, docs, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH", 10)
    encoded = bpe.encode(docs(EDGES)).withColumn("decoded", bpe.F.lit("clash"))
    back = bpe.texts(spark, encoded)
    assert back.columns == ["doc_id", "n_tokens", "ids", "text"]
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t in EDGES), key=str)
    assert bpe.decode(spark.createDataFrame([(None,)], "ids binary")).first()["decoded"] == b""


def test_new_pre_tokens_are_merged_together(library):
    rng, own = random.Random(8), bpe.ByteBpe(bpe.load_ranks(tokenizer_path(bpe.VOCABULARY)))
    texts = [" ".join("".join(rng.choice("etaoinshrdlué") for _ in range(rng.randint(1, 14))) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    searches, take = [], own.queue.take
    own.queue.take = lambda: searches.append(1) or take()
    assert list(own.encode_each(texts)) == [ids_of(library, t) for t in texts]
    assert len(searches) < len(own.memo)  # one by one, each pre-token takes several
    assert not own.queue.buckets and not any(map(any, own.queue.levels))


def test_known_words_are_not_cut_again(library):
    class Counting:
        def __init__(self, pattern):
            self.pattern, self.calls = pattern, 0

        def findall(self, text):
            self.calls += 1
            return self.pattern.findall(text)
    rng, own = random.Random(10), bpe.ByteBpe(bpe.load_ranks(tokenizer_path(bpe.VOCABULARY)))
    own.pattern = Counting(own.pattern)
    vocabulary = ["".join(rng.choice("etaoinshrdlué,.'") for _ in range(rng.randint(0, 9))) for _ in range(80)] + ["x" * 50]
    texts = [" ".join(rng.choices([w or "a" for w in vocabulary], k=60)) for _ in range(40)]
    for text in texts:  # one group each
        assert list(own.encode_each([text])) == [ids_of(library, text)]
    assert own.pattern.calls < 400  # a head for each text, and a word once unless it is long
    assert max(map(len, [*own.memo, *own.parts])) <= bpe.SHORT


def test_ranks_in_any_order():
    rng = random.Random(9)
    for _ in range(300):
        tokens = [bytes([b]) for b in range(256)] + [*{bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(40)}]
        own = bpe.ByteBpe(dict(zip(tokens, rng.sample(range(len(tokens)), len(tokens)), strict=True)))
        pieces = [bytes(rng.choices(b"abc", k=rng.randint(1, 12))) for _ in range(20)]
        want = []
        for piece in pieces:
            parts = [piece[i:i + 1] for i in range(len(piece))]
            while (best := min(((own.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in own.ranks), default=None)):
                parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            want.append(array.array("I", [own.ranks[x] for x in parts]).tobytes())
        assert own.merge(pieces) == want
