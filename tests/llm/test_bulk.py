"""Tokens of many texts at once."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lathework.llm import packing
from lathework.llm.tokens import ChunkIds

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["'s", "'T", "'", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|", "<", "\x7f", "\t", "\r", "\x0b", "\x00", "\x85", "\xa0", *"\xaa\xb7\xd7\xf7\u0130\u1e9e\u03a3\u4e2d\u0301\u0327\u0416\U0001f642"]
PLAIN = list("aAzZ\u00e9\u00c9\u00df\u00ff\u00de\u00d8019,.!_`~  \n")


def test_each_distinct_piece_is_looked_up_once():
    class Counted(ChunkIds):
        looked = 0

        def __getitem__(self, piece):
            self.looked += 1
            return super().__getitem__(piece)

    ids = Counted(PATH)
    ids.of("Das Haus, das haus. DAS\n" * 500)
    assert ids.looked == 4


@pytest.mark.parametrize("letters", [PLAIN, ODD + PLAIN, ODD])
def test_many_texts_have_the_ids_of_each(letters):
    ids, whole, deal = ChunkIds(PATH, most=100), Tokenizer.from_file(PATH), random.Random(3)
    for _ in range(150):
        texts = ["".join(deal.choices(letters, k=deal.choice([0, 1, 2, 5, 9, 40]))) for _ in range(7)]
        want = [whole.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert [x.tolist() for x in ids.many(texts, [1])] == want, texts


def test_each_character_in_its_chunk():
    texts = [t for n in range(1, 0x250) for t in (chr(n), f"a{chr(n)}B", f"A{chr(n)},", f"{chr(n)}1{chr(n)}")]
    whole = Tokenizer.from_file(PATH)
    assert [x.tolist() for x in ChunkIds(PATH).many(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_no_texts():
    ids = ChunkIds(PATH)
    assert ids.of("") == b"" and [x.tolist() for x in ids.many(["", " \n"], [1])] == [[1], [1]]


def test_open_windows_hold_no_other_texts():
    packer = packing.LevelPacker(32)
    packer.place(0, np.arange(100, dtype="<u4")[:40])
    assert packer.open[8][0][0][2].base is None


def test_stretches(monkeypatch):
    monkeypatch.setattr(packing, "STRETCH", 10)
    texts = ["", "a" * 9, "b", "c" * 35, "", "d" * 4, "\u00e9" * 5]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    parts = [p.column("text").to_pylist() for p in packing.stretches(batch)]
    assert sum(parts, []) == texts and len(parts) > 3
    assert all(sum(len(t.encode()) for t in p[1:]) <= 10 for p in parts)
    assert [p.num_rows for p in packing.stretches(batch.slice(0, 0))] == [0]
