"""Token counts, token codes and packing against the library."""

import array
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import EDGES
from tramline.llm import op2_token_codes as codes
from tramline.llm import op4_token_counts as counts
from tramline.llm import op7_packing as packing
from tramline.llm.tokens import WordIds, tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "'LL", "é", "É", "ß", "İ", "e\u0301", "<|endoftext|>", "12", "½", "_", "-", "...", "!", "\x1c",
         "\x85", "\u3000", "\u200a", "日本", "Σ", "😀", "\r\n", "\u200b", "ª", "DON'T", "don't.", "ﬁ", ", ", ". ", "x.,"]


library = lru_cache(Tokenizer.from_file)


def expected(text, file=WORDS):
    return library(file).encode(text or "", add_special_tokens=False).ids


def test_ids_and_counts_equal_the_library():
    rng, words = random.Random(4), WordIds(WORDS)
    path = tokenizer_path(counts.VOCABULARY)
    counter = counts.Counter(path, counts.whole_tokens(path))
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))
        assert words.encode(text) == array.array("I", expected(text)).tobytes(), repr(text)
        assert counter.count(text) == len(expected(text, path)), repr(text)


def test_counts_of_edge_rows(docs):
    got = sorted(map(tuple, counts.token_counts(docs(EDGES)).collect()), key=str)
    path = tokenizer_path(counts.VOCABULARY)
    want = sorted(((i, len((t or "").encode()), n := len(expected(t, path)), n > 512) for i, t in EDGES), key=str)
    assert got == want
    assert counts.token_counts(docs([])).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 0, 65535, 65536, 1 << 24], list(range(3000)), [7] * 1030])
def test_directly_addressable_codes(ids):
    reader = codes.DacReader(codes.dac_encode(np.array(ids, np.uint32)))
    assert reader.all().tolist() == ids and len(reader) == len(ids)
    assert [reader[i] for i in range(len(ids))] == ids


def test_token_files_round_trip(spark, docs, tmp_path):
    path = str(tmp_path / "codes")
    codes.write_tokens(docs(EDGES), path, shards=3, segment=50)
    rows = codes.read_tokens(spark, path).collect()
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [None, 1, 2, 3, 4, 4, 5, 6]
    want = sorted((i or 0, array.array("I", [*expected(t), codes.END_ID]).tobytes()) for i, t in EDGES)
    assert sorted((r["doc_id"] or 0, bytes(r["ids"])) for r in rows) == want
    assert codes.token_of(spark, path, 6, 2) == expected(EDGES[-1][1])[2]
    assert codes.token_codes(docs([])).count() == 0


def test_parts_of_known_chunks_are_not_cut_again():
    words, cut = WordIds(WORDS), []
    tokenize = words.tokenize
    words.tokenize = lambda text: cut.append(text) or tokenize(text)
    text = " ".join(f"{a}{b};" for a in "bdfg" for b in "aeiou")
    assert words.encode(text) == array.array("I", expected(text)).tobytes()
    assert len(cut) <= 20  # the mark isn't cut with each word
    assert words.encode("Ba ba ba;") == array.array("I", expected("ba ba ba;")).tobytes()
    cut.clear()
    assert words.encode("ba: BA: ba") == array.array("I", expected("ba: ba: ba")).tobytes() and cut == []


def test_packing_keeps_every_piece(docs):
    rows = packing.pack(docs(EDGES), capacity=64).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = []
    for i, t in EDGES:
        ids = array.array("I", [*expected(t), packing.END_ID])
        want += [(i, k, s, len(ids[s:s + 64]), zlib.crc32(ids[s:s + 64].tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted(map(str, want)) == sorted(str(tuple(r[:5])) for r in rows)
    assert packing.pack(docs([])).count() == 0


def test_local_search_empties_bins():
    lengths, bins = [6, 4, 5, 5, 3, 3, 2, 2], [[0, 6], [1, 4], [2, 5], [3, 7]]
    after = packing.local_search(lengths, [list(b) for b in bins], 10)
    assert len(after) == 3 and sorted(i for b in after for i in b) == list(range(8))
    assert all(sum(lengths[i] for i in b) <= 10 for b in after)
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(500)]
    packed = packing.local_search(sizes, packing.best_fit(sizes, 100), 100)
    assert sorted(i for b in packed for i in b) == list(range(500)) and max(sum(sizes[i] for i in b) for b in packed) <= 100


def gains(a, b, room):
    """Largest gain that ``b`` can get from ``a``, by all pairs."""
    pairs = [(x, y) for x in range(len(b)) for y in range(x)]
    found = [i for i in a] + [i - j for i in a for j in b] + [i - b[x] - b[y] for i in a for x, y in pairs]
    found += [a[x] + a[y] - j for x in range(len(a)) for y in range(x) for j in b]
    return max((g for g in found if 0 < g <= room), default=0)


def test_local_search_leaves_no_step():
    rng = random.Random(7)
    sizes = [rng.randint(270, 375) for _ in range(400)]  # about three to a sequence, far more than forty bins that aren't full
    packed = packing.local_search(sizes, packing.best_fit(sizes, 1000), 1000)
    assert sorted(i for b in packed for i in b) == list(range(400))
    bins = sorted(([sizes[i] for i in b] for b in packed), key=sum)
    assert max(map(sum, bins)) <= 1000
    assert not any(gains(s, t, 1000 - sum(t)) for x, s in enumerate(bins) for t in bins[x + 1:])


def test_local_search_reads_whole_bins():
    # Only the last two of 62 pieces, 200 + 293, go back for the piece of 500; then the piece of 190 fits beside them.
    sizes = [500, *[3] * 60, 200, 293, 190]
    packed = packing.local_search(sizes, [[0], list(range(1, 63)), [63]], 683)
    assert sorted(sorted(sizes[i] for i in b) for b in packed) == [[*[3] * 60, 500], [190, 200, 293]]


def test_best_step_equals_all_pairs():
    rng = random.Random(5)
    for _ in range(2000):
        a, b = ([rng.randint(1, 30) for _ in range(rng.randint(1, 6))] for _ in "ab")
        room = rng.randint(1, 20)
        gain, go, come = packing._best_step(a, b, room)
        assert gain == gains(a, b, room) == sum(go) - sum(come)
        assert len(packing._Flat({3: b}, {3: 0}, room).takers(a)) == (gain > 0)
