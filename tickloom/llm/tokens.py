"""Token ids of whole texts by the tokenizers library, each different piece encoded once."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np

# Pieces a worker process keeps at most (some 200 bytes each), and the longest that is kept.
ENTRIES = 1 << 19
LONGEST = 64
# White space and letters of plain text. Plain text has no apostrophe (parts of
# words such as 't are pieces), no < or | (special tokens), no other character beyond ASCII.
SPACE = r" \t\n\r\x0b\x0c"
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[{SPACE}{LETTER}0-9!-&(-;=-@\[-`{{}}~]*")
# Behind a character that is white space nowhere, before one that is white space everywhere.
AFTER_WORD = re.compile(r"(?<=\S)(?=[ \t\n\r\x0b\x0c])")


@dataclass(frozen=True)
class Rules:
    """How a kind of tokenizer file cuts plain text into the pieces that it encodes one by one;
    other text is cut where it may be for certain, and the library does the rest."""

    piece: str
    lower: bool

    def words(self, text: str) -> list[str]:
        if self.lower:  # white space is dropped
            return [word.decode() for word in text.encode().split()]
        return AFTER_WORD.split(text)


WORD_ENDS = Rules(rf"[{LETTER}]+|[0-9]|[^{SPACE}{LETTER}0-9]+", lower=True)
BYTE_LEVEL = Rules(
    rf" ?[{LETTER}]+| ?[0-9]+| ?[^{SPACE}{LETTER}0-9]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+", lower=False
)


def _characters() -> dict[int, int]:
    """Byte-level files write bytes as characters: printable ones as themselves, the rest as
    those from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in printable]
    return {byte: 256 + place for place, byte in enumerate(others)}


CHARACTERS = _characters()


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Coder:
    """The ids of texts: pieces are looked up, and encoded by the library when met first.

    Ids are kept as bytes, so that those of a text are one join. Beyond ``ENTRIES`` pieces the
    older half is forgotten.
    """

    def __init__(self, path: str, rules: Rules):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.rules = rules
        self.piece = re.compile(rules.piece)
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str, odd: set[str]) -> list[str]:
        """Pieces of a text; those that are not plain are added to ``odd``."""
        if PLAIN.fullmatch(text):
            return self.piece.findall(text.lower() if self.rules.lower else text)
        found = []
        for word in self.rules.words(text):
            if PLAIN.fullmatch(word):
                found += self.piece.findall(word.lower() if self.rules.lower else word)
            else:
                odd.add(word)
                found.append(word)
        return found

    def learn(self, some: set[str], odd: set[str]) -> list[str]:
        fresh = some.difference(self.known)
        whole = list(fresh & odd)
        for word, coded in zip(whole, self.tokenizer.encode_batch(whole, add_special_tokens=False)):
            self.known[word] = pack(coded.ids)
        for piece in fresh - odd:
            if piece.isascii() and piece.isprintable():
                written = piece.replace(" ", chr(CHARACTERS[32]))
            else:
                written = piece.encode().decode("latin-1").translate(CHARACTERS)
            self.known[piece] = pack([token.id for token in self.model.tokenize(written)])
        return [piece for piece in fresh if len(piece) > LONGEST]

    def ids(self, texts: list[str | None], end: int) -> Iterator[np.ndarray]:
        """Little-endian 32-bit ids of each text (null: empty) and the end id."""
        if len(self.known) > ENTRIES:
            for piece in list(islice(self.known, len(self.known) // 2)):
                del self.known[piece]
        odd: set[str] = set()
        cut = [self.pieces(text, odd) if text else [] for text in texts]
        long = self.learn(set().union(*cut), odd)
        last = pack([end])
        for some in cut:
            yield np.frombuffer(b"".join([*map(self.known.__getitem__, some), last]), "<u4")
        for piece in long:
            del self.known[piece]


@lru_cache(maxsize=4)
def coder_of(path: str, rules: Rules) -> Coder:
    """The coder of a worker process, built once."""
    return Coder(path, rules)
