"""Splitting texts at places where a byte-level BPE with the usual pattern always begins a new pre-token.

A single space or line feed between two characters that aren't white space always begins a pre-token: the
space goes with what follows, the line feed stands alone. So a text's ids are those of its pieces, one
after the other, and equal pieces need to be encoded once only. Longer runs of white space, and all other white
space, stay inside a piece; special strings hold no space, so the library finds them within a piece.

A piece is kept as a key without the space before it. A key that begins with a space is a text's first piece and
stands for the rest of the key; a key that begins with a line feed stands for itself; any other for " " + key.
"""

from __future__ import annotations

import re
import struct

import numpy as np
import regex

from .common import kept

_CUT = re.compile(r"(?<=\S) (?=\S)")
_PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Marks that form a pre-token of their own behind a word.
_MARKS = frozenset(",.;:!?)")
#: Letters up to here are classed alike by all versions of Unicode; pieces with others go to the library whole.
_LATIN = re.compile("[^\x00-ɏ‘-”]")


def piece_keys(text: str) -> list[str]:
    """Keys of the pieces that make up the text."""
    if not text:
        return []
    if "  " not in text and " \n" not in text and "\n " not in text and "\n\n" not in text and text.replace("\n", "").isprintable():
        cut = text.replace("\n", " \n").split(" ")  # no white space but single spaces and line feeds
    else:
        cut = _CUT.split(text)
    cut[0] = " " + cut[0]
    return cut


def key_text(key: str) -> str:
    return key[1:] if key[:1] == " " else key if key[:1] == "\n" else " " + key


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Lookup(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self, most: int) -> None:
        """Over `most` entries, forgets the long keys, which seldom recur, or else all."""
        if len(self) > most:
            short = {k: v for k, v in self.items() if len(k) <= 8}
            self.clear()
            if len(short) <= most:
                self.update(short)


class PieceEncoder:
    """Encodes texts with the tokenizers library, each piece and pre-token once as long as it is remembered."""

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.known = _Lookup(self.piece_ids)
        self.words = _Lookup(self._word)
        self.most = most

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            letters = word.replace(" ", self.letters[32])
        else:
            letters = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _token(self, token: str) -> bytes:
        """Ids of one pre-token; a word behind a space is kept under its key as a piece."""
        return self.known[token[1:]] if token[:1] == " " and token[1:].isalpha() else self.words[token]

    def piece_ids(self, key: str) -> bytes:
        """Ids of one piece. Its words are remembered, the piece isn't."""
        if key.isascii() or not _LATIN.search(key):  # most pieces are a word, or one with a mark behind it
            if key.isalpha():
                return self._word(" " + key)
            if key[-1:] in _MARKS and key[:-1].isalpha():
                return self.known[key[:-1]] + self.words[key[-1]]
            if key[:1] == "\n" and key[1:].isalpha():
                return self.words["\n"] + self.words[key[1:]]
        text = key_text(key)
        if (not text.isascii() and _LATIN.search(text)) or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._token, _PRE_TOKEN.findall(text)))

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.known.__getitem__, piece_keys(text)))

    def trim(self) -> None:
        self.known.trim(self.most)
        self.words.trim(self.most)


def shared_encoder(path: str) -> PieceEncoder:
    """One encoder for all tasks that a worker process runs, so that later tasks find what earlier ones looked up."""
    return kept(path, lambda: PieceEncoder(path))
