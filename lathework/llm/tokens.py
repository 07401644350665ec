"""Token ids of a public vocabulary, with a cache of chunks for each Python worker."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Sequence
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa

CACHE_CHUNKS = 250_000  # in each of two generations

# The vocabulary's own way to cut a text in small letters, for texts of the characters in PLAIN.
PLAIN = re.compile("[!-~\u00c0-\u024f]+")
PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
SMALL = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")  # a piece as it is
ID = attrgetter("id")

# Kinds of UTF-8 bytes, to cut many texts at once. Letters are a-z, A-Z and \u00c0-\u00ff, whose first byte is C3.
GAP, LETTER, DIGIT, MARK, ODD = range(5)
KINDS = bytes(
    GAP if b in b" \n" else DIGIT if b in b"0123456789" else MARK if b in b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~" else
    LETTER if bytes([b]).isalpha() or 0x80 <= b < 0xC0 or b == 0xC3 else ODD
    for b in range(256)
)


def kinds_of(raw: np.ndarray) -> np.ndarray:
    """The kind of each byte of chunks that end with a blank; all bytes of a chunk with anything odd are odd.

    Odd are apostrophes, which may begin a contraction, the start of a special token, the two signs
    among the letters, and all characters of no other kind.
    """
    kinds = np.frombuffer(bytearray(raw).translate(KINDS), np.uint8)
    for lead, then in (b"<|", b"\xc3\x97", b"\xc3\xb7"):
        at = np.flatnonzero(raw[:-1] == lead)
        kinds[at[raw[at + 1] == then]] = ODD
    if (kinds == ODD).any():
        gaps = np.flatnonzero(kinds == GAP)
        sizes = np.diff(gaps, prepend=-1)
        odd = np.maximum.reduceat(kinds, gaps - sizes + 1) == ODD  # the largest kind
        kinds[np.repeat(odd, sizes) & (kinds != GAP)] = ODD
    return kinds


def small(raw: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """The bytes with small letters, but for odd ones."""
    low = np.frombuffer(bytearray(raw).lower(), np.uint8)
    second = np.flatnonzero(raw[:-1] == 0xC3) + 1
    low[second[raw[second] < 0x9F]] += 32
    return np.where(kinds == ODD, raw, low)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkIds(dict):
    """Ids (as little-endian unsigned 32-bit bytes) of text chunks without blanks.

    The vocabulary splits at white space before anything else, so a text has the ids of its
    chunks one after another. A chunk of plain characters, once normalised, is cut into the
    vocabulary's pieces here, whose ids are looked up one by one; any other one is encoded whole:
    some letters become a letter and a mark, which makes one piece with what follows. When the
    cache is full it becomes the old generation, from which chunks are taken up again.

    Many texts are cut at once, as one array of bytes, and each distinct piece of them is looked up once.
    """

    def __init__(self, path: str, most=CACHE_CHUNKS):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.old = Tokenizer.from_file(path), most, {}
        self.letters = byte_letters()

    def __missing__(self, chunk: str) -> bytes:
        out = self.old.get(chunk)
        if out is None:
            out = self.made(chunk)
        if len(chunk) < 200:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[chunk] = out
        return out

    def made(self, chunk: str) -> bytes:
        if SMALL.fullmatch(chunk):
            return self.tokenized(chunk)
        plain = chunk.lower() if chunk.isascii() else self.tokenizer.normalizer.normalize_str(chunk)
        if "<|" not in chunk and PLAIN.fullmatch(plain):  # no start of a special token
            found = PIECES.findall(plain)
            if found == [chunk]:
                return self.tokenized(chunk)
            return b"".join(map(self.__getitem__, found))
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def tokenized(self, piece: str) -> bytes:
        """Ids of one piece, which the vocabulary spells in letters of its own."""
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", map(ID, self.tokenizer.model.tokenize(letters))).tobytes()

    def of(self, text: str) -> bytes:
        return self.many([text])[0].tobytes()

    def many(self, texts: Sequence[str], end: Sequence[int] = ()) -> list[np.ndarray]:
        """The ids of each text and then ``end``; all are views of one array."""
        whole = [(t + " ").encode() for t in texts]
        raw = np.frombuffer(b"".join(whole), np.uint8)
        kinds = kinds_of(raw)
        solid = kinds != GAP
        cut = kinds == DIGIT
        cut[:1] = True
        cut[1:] |= kinds[1:] != kinds[:-1]
        first = np.flatnonzero(cut & solid)
        bounds = np.append(np.flatnonzero(cut[solid]), np.count_nonzero(solid)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(
            len(first), pa.py_buffer(bounds), pa.py_buffer(small(raw, kinds)[solid])
        ).dictionary_encode()
        found = [self[p] for p in pieces.dictionary.to_numpy(zero_copy_only=False)]
        table, which = np.frombuffer(b"".join(found), "<u4"), pieces.indices.to_numpy()
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        lengths = sizes[which]
        upto = np.append(0, np.cumsum(lengths))  # ids before each piece
        ids = table[np.repeat((np.cumsum(sizes) - sizes)[which] - upto[:-1], lengths) + np.arange(upto[-1])]
        ends = upto[np.searchsorted(first, np.cumsum([len(t) for t in whole]))]
        ids = np.insert(ids, np.repeat(ends, len(end)), np.tile(np.array(end, "<u4"), len(ends)))
        return np.split(ids, (ends + len(end) * np.arange(1, len(ends) + 1))[:-1])


@lru_cache(maxsize=2)
def chunk_ids(path: str) -> ChunkIds:
    """The cache of this worker process; later tasks of the process go on with it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkIds(path)
