"""Words of any length and texts of many words."""

import random

import numpy as np
import tiktoken

import slipway.llm.byte_bpe as bpe
import slipway.llm.pretokens as pretokens


def test_long_words_and_many_words():
    chance = random.Random(6)
    codec = bpe.Codec(bpe.read_ranks())
    library = tiktoken.Encoding("own", pat_str=bpe.public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    mixed = "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=200_000))
    dna = "".join(chance.choices("ACGT", k=50_000))
    many = " ".join(f"{chance.getrandbits(40):x}" for _ in range(300_000))
    for text in (mixed, dna, "漢字" * 3000, many):
        ((ids, decoded),) = codec.round_trips([text])
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert decoded == text.encode()


def test_pieces_change_nothing(monkeypatch):
    text = " ".join(f"word{n}ing" for n in range(500)) + " a  b"
    before = bpe.Codec(bpe.read_ranks()).round_trips([text, "", "one  two"])
    monkeypatch.setattr(pretokens, "PIECE", 7)
    monkeypatch.setattr(bpe, "ASKED", 50)
    assert bpe.Codec(bpe.read_ranks()).round_trips([text, "", "one  two"]) == before
