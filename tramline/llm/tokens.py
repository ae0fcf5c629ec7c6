"""Token ids of whole texts by the tokenizers library, with memoised chunks.

A chunk is a stretch of text between two places where the tokenizer always splits, so a text's ids
are those of its chunks in a row. Invented or natural, prose repeats its words; a chunk is encoded
once per worker and looked up afterwards. The memo is emptied when it is full, which costs time
but never changes an id.
"""

from __future__ import annotations

import array
import re
from collections.abc import Callable

import public_tokenizers
from tokenizers import Tokenizer

from tramline.llm.common import held

MEMO = 1_000_000  # chunks kept per worker, about 150 MB
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Letters whose lower case and composed form are one code point each, then marks. The library's
#: pattern cuts such a chunk into exactly these two pieces.
PLAIN = re.compile(f"([{LETTERS}]+)([!-&(-/:-@\\[-`{{-~]*)")
#: Marks in a row are one piece, so such a text isn't cut before its marks.
RUN = re.compile(f"[.,][ \n](?<![{LETTERS}0-9][.,][ \n])")


def tokenizer_path(name: str) -> str:
    """A file of the public vocabulary folder, or a path as it is."""
    return name if "/" in name else public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = [""] * 256, 256
    for b in range(256):
        table[b] = chr(b if b in shown else extra)
        extra += b not in shown
    return table


BYTES = byte_letters()


def mapped(text: str) -> str:
    return text if text.isascii() and text.isalpha() else "".join(map(BYTES.__getitem__, text.encode()))


def one_byte(text: str) -> bool:
    """Whether all letters are below U+0100."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Chunks(dict):
    """Ids by chunk; those of a chunk that is looked up for the first time are made then."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__({"": b""})
        self.make = make

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.make(chunk)
        return ids


class WordIds:
    """Ids under a lower-casing word tokenizer that drops white space."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.tokenize = self.library.model.tokenize
        self.chunks = Chunks(self.chunk)

    def piece(self, text: str) -> bytes:
        return array.array("I", [t.id for t in self.tokenize(mapped(text))]).tobytes()

    def chunk(self, text: str) -> bytes:
        if text.isalpha() and text.isascii():
            return self.piece(text.lower())
        plain = PLAIN.fullmatch(text)
        if not plain:
            return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        word, marks = plain[1].lower(), plain[2]
        ids = self.chunks.get(word) or self.piece(word)
        return ids + self.chunks[marks] if marks else ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        Spaces and line ends always end a piece. In texts of one-byte letters without special
        strings, case can be folded first, and a full stop or comma after a letter or digit and
        before a space is a piece of its own; words then repeat more often.
        """
        if "<|" not in text and one_byte(text) and not RUN.search(text):
            text = text.lower().replace("\n", " ").replace(", ", " , ").replace(". ", " . ")
        else:
            text = text.replace("\n", " ")
        memo = self.chunks
        if len(memo) > MEMO:
            memo.clear()
        return b"".join(map(memo.__getitem__, text.split(" ")))


def word_ids(path: str) -> WordIds:
    return held("word ids", path, lambda: WordIds(path))
