"""Token counts: vocabulary strings proven to encode alone as one token count as one, the rest is merged.

``whole_tokens`` runs offline over the vocabulary and keeps each string that the library cuts into
one pre-token and merges to exactly its own id. Texts are cut into pre-tokens; those in the proven
set count one each without a merge, others are merged by the library's model once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramline.llm.common import held
from tramline.llm.tokens import BYTES, LETTERS, MEMO, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: Unicode white space, as the library's \s; Python's own \s has four control characters more.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Stretches whose ends are always ends of pre-tokens.
STRETCH = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
PLAIN = re.compile(f"( ?[{LETTERS}]+)([.,;:!?]*)")


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings (in byte letters) that stand alone as one pre-token and encode to one id."""
    library = Tokenizer.from_file(path)
    back = {c: b for b, c in enumerate(BYTES)}
    whole = []
    for token, i in library.get_vocab(with_added_tokens=False).items():
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        cut = library.pre_tokenizer.pre_tokenize_str(text)
        if len(cut) == 1 and [t.id for t in library.model.tokenize(cut[0][0])] == [i]:
            whole.append(token)
    return frozenset(whole)


class Counter:
    """Counts tokens of texts; holds the library, the proven strings and the memo of one worker."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.library, self.whole = Tokenizer.from_file(path), whole
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.cut = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.stretches: dict[str, int] = {}
        self.merged: dict[str, int] = {}

    def pre_token(self, piece: str) -> int:
        if piece in self.whole:
            return 1
        n = self.merged.get(piece)
        if n is None:
            n = self.merged[piece] = len(self.library.model.tokenize(piece))
        return n

    def stretch(self, text: str) -> int:
        plain = PLAIN.fullmatch(text)
        if plain:
            word = plain[1] if plain[1].isascii() else "".join(map(BYTES.__getitem__, plain[1].encode()))
            return self.pre_token(word.replace(" ", BYTES[32])) + (self.pre_token(plain[2]) if plain[2] else 0)
        return sum(self.pre_token(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text))

    def part(self, text: str) -> int:
        stretches, memo = STRETCH.findall(text), self.stretches
        if len(memo) > MEMO or len(self.merged) > MEMO:
            memo.clear()
            self.merged.clear()
        try:
            return sum([memo[s] for s in stretches])
        except KeyError:
            for s in stretches:
                if s not in memo:
                    memo[s] = self.stretch(s)
            return sum([memo[s] for s in stretches])

    def count(self, text: str) -> int:
        """Special strings inside the text are one token each and part the text, as the library does."""
        if self.cut is None or not self.cut.search(text):
            return self.part(text)
        return sum(map(self.part, self.cut.split(text))) + len(self.cut.findall(text))


def _counter(path: str, whole: frozenset[str]) -> Counter:
    return held("token counts", path, lambda: Counter(path, whole))


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit of every row.

    A null text counts as empty: 0 bytes, 0 tokens. Ids may be null or repeat; each row gives one
    row. Other columns are not read. No shuffle; memory is one Arrow batch and the worker's memo.
    """
    path = tokenizer_path(vocabulary)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, whole.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = pa.array([counter.count(t) for t in texts], pa.int64())
            size = pa.array([len(t.encode()) for t in texts], pa.int64())
            over = pa.array([x > limit for x in n.to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), size, n, over], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean")
