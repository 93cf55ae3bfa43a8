"""Encoding with a public tokenizer file: the library's own steps, remembered per word."""

from __future__ import annotations

import os
import re
from struct import pack

import numpy as np

# Chunks remembered per worker; the memory forgets all when it is full.
PIECES_KEPT = 1_200_000
# Blanks other than single spaces and line feeds; a text with one is split with care.
ODD_BLANKS = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Letters, beside those of ASCII, that are one code point in every normal form; marks that stay apart from letters.
ACCENTED = [chr(c) for c in range(0xC0, 0x100) if chr(c) not in "×÷"]
OTHER_LETTER = re.compile(f"[^A-Za-z{''.join(ACCENTED)}]")
MARKS = ".,!?;:"
LINE_FEED = "Ċ"


class Chunks(dict):
    """Ids of chunks, each a run of characters without spaces; ``space`` stands for the space that belongs before it.

    ``as_bytes`` says that chunks are given as their bytes.

    Most chunks are letters with marks behind, which every step of the tokenizer treats alike; the library's own
    steps cut the others. A chunk with line feeds between other characters, but no other blank, is cut there.
    """

    def __init__(self, encoder: Encoder, space: str, as_bytes: bool = False):
        super().__init__()
        self.encoder, self.space, self.as_bytes = encoder, space, as_bytes
        self.before = "Ġ" if space else ""

    def __missing__(self, chunk: str | bytes) -> bytes:
        if len(self) >= self.encoder.kept:
            self.clear()
        ids = self[chunk] = self.ids_of(chunk.decode() if self.as_bytes else chunk)
        return ids

    def ids_of(self, chunk: str) -> bytes:
        encoder = self.encoder
        word = chunk.rstrip(MARKS)
        if word.isalpha():
            plain = word.lower() if encoder.lower else word
            if plain.isascii() or not OTHER_LETTER.search(plain):
                if len(word) < len(chunk):
                    return self[word.encode() if self.as_bytes else word] + encoder.piece(chunk[len(word):])
                return encoder.letters(self.before + plain)
        elif "\n" in chunk:
            first, *rest = chunk.split("\n")
            if [first, *rest] == chunk.split():
                return encoder.piece(LINE_FEED).join([self[first], *[encoder.first[c] for c in rest]])
        return encoder.chunk(self.space + chunk)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, equal to ``encode(text, add_special_tokens=False)``.

    A text is cut where the tokenizer must cut too, so that each cut piece can be encoded once and remembered: at
    blanks for a tokenizer that drops them, at single spaces between two other characters for byte-level ones that
    keep the space with the word. Other kinds of tokenizers encode whole texts. Strings of added tokens in a text become
    their ids, as the library does by default; what lies between them is encoded apart.
    """

    def __init__(self, path: str, kept: int = PIECES_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.kept = Tokenizer.from_file(path), kept
        self.id_bits = max(1, (self.tokenizer.get_vocab_size(with_added_tokens=True) - 1).bit_length())
        steps = _steps(self.tokenizer.to_str())
        self.lower = "Lowercase" in steps
        added = self.tokenizer.get_added_tokens_decoder()
        plain = not any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values())
        self.added = {t.content: pack("<I", i) for i, t in added.items()}
        self.between = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.start = os.path.commonprefix(list(self.added))
        if plain and steps == ["ByteLevel"]:
            self.part = self._by_space
        elif plain and steps == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            self.part = self._by_blank
        else:
            self.part = self._whole
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in ACCENTED}
        self.pieces: dict[str, bytes] = {}
        self.first, self.later = Chunks(self, ""), Chunks(self, " ")
        self.words = Chunks(self, "", as_bytes=True)

    def encode(self, text: str) -> bytes:
        if self.part == self._whole or not self.added or self.start not in text:
            return self.part(text)
        return b"".join([self.added[x] if x in self.added else self.part(x) for x in self.between.split(text)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= self.kept:
                self.pieces.clear()
            ids = self.pieces[piece] = self._merged(piece)
        return ids

    def _merged(self, piece: str) -> bytes:
        found = [t.id for t in self.tokenizer.model.tokenize(piece)]
        return pack(f"<{len(found)}I", *found)

    def letters(self, word: str) -> bytes:
        """Ids of letters out of ASCII and ``ACCENTED``, the space before them already as the tokenizer writes it."""
        return self._merged(word if word.isascii() else word.translate(self.bytes_of))

    def chunk(self, chunk: str) -> bytes:
        normal = self.tokenizer.normalizer
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal.normalize_str(chunk) if normal else chunk)
        return b"".join([self.piece(piece) for piece, _ in cut])

    def _by_blank(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.encode().split()))

    def _by_space(self, text: str) -> bytes:
        if not text:
            return b""
        if text[0] == " " or "  " in text or " \n" in text or "\n " in text or "\n\n" in text or ODD_BLANKS.search(text):
            chunks = LONE_SPACE.split(text)
        else:
            chunks = text.split(" ")
        return self.first[chunks[0]] + b"".join(map(self.later.__getitem__, chunks[1:]))


def _steps(config: str) -> list[str]:
    """Names of the tokenizer's normalizing and cutting steps, in order."""
    import json

    parsed = json.loads(config)
    if parsed["model"]["type"] != "BPE":
        return ["other"]
    names = []
    for step in (parsed["normalizer"], parsed["pre_tokenizer"]):
        for s in (step or {}).get("normalizers") or (step or {}).get("pretokenizers") or ([step] if step else []):
            names.append(s["type"])
            if s.get("add_prefix_space"):
                names.append("add_prefix_space")
    return names


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, kept: int = PIECES_KEPT) -> Encoder:
    """One encoder per file, size of memory and worker, kept between tasks."""
    if (path, kept) not in _encoders:
        _encoders[path, kept] = Encoder(path, kept)
    return _encoders[path, kept]
