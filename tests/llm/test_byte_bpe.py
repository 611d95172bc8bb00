from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.cases import LONG, ODD, documents
from trawl.llm import byte_bpe
from trawl.llm.byte_bpe import VOCABULARY, PairEncoder, decode, encode, read_ranks


@pytest.fixture(scope="module")
def reference():
    ranks = read_ranks(VOCABULARY)
    pattern = public_tokenizers.PATTERN
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


TEXTS = [
    "<|endoftext|>",
    "don't we'll I'M ½ ⅷ ٣٤٥ 东京 🙂🙂",
    "\r\n\r\n \t x",
    "\x1c\x1d \x85᠎ ​ x\xa0 y",
    "=" * 700 + " " * 700 + "x",
    "ab" * 900,
    "\x00\x01" * 300,
]


def test_ids_agree_with_the_library(reference):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcdefgh") for _ in range(900))]
    texts += ["".join(rng.choice("ab  \n\t'sdlve.#1²é　\x1c") for _ in range(30)) for _ in range(800)]
    for text, ids in zip(texts, PairEncoder().encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text), text[:80]


def test_round_trip_of_documents(spark, reference):
    rows = ODD + [(100 + i, t) for i, t in enumerate(TEXTS)]
    table = documents(spark, rows, clashes=True)
    twice, at_once = decode(encode(table)), encode(table, decoded=True)
    assert sorted(map(repr, twice.collect())) == sorted(map(repr, at_once.collect()))
    for r in twice.collect():
        ids = reference.encode_ordinary(r.text or "")
        assert r["ids"] == ids and r.n_tokens == len(ids)
        assert bytes(r.decoded) == (r.text or "").encode()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.score == "mine"
    assert decode(encode(documents(spark, []))).collect() == []


def test_blocks_do_not_change_ids(reference):
    encoder = PairEncoder()
    wanted = np.array(reference.encode_ordinary(LONG), "<u4").tobytes()
    assert encoder.encode(LONG) == wanted
    assert list(encoder.encode_many([LONG, "x", LONG])) == [wanted, encoder.encode("x"), wanted]


def test_words_forgotten_and_learned_again_have_the_same_ids(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN_WORDS", 30)
    monkeypatch.setattr(byte_bpe, "BLOCK_WORDS", 12)
    encoder, rng = PairEncoder(), random.Random(4)
    learned, plain = [], encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: learned.extend(new) or plain(new))
    texts = [" the of " + " ".join(f"w{rng.randrange(200)}" for _ in range(5)) for _ in range(200)]
    for text, ids in zip(texts, encoder.encode_many(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
    # Words that every text has are worked out once; others are, when they come again late.
    assert learned.count(" the") == learned.count(" of") == 1 and len(learned) > len(set(learned))
    assert len(encoder._known) + len(encoder._older) <= 2 * 30


def test_a_recursion_takes_words_up_to_a_number_of_bytes(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BYTES_PER_RECURSION", 3_000)
    encoder, plain = PairEncoder(), PairEncoder._short
    together = []

    def counted(self, new):
        together.append(sum(len(raw) for _, raw in new))
        return plain(self, new)

    monkeypatch.setattr(PairEncoder, "_short", counted)
    text = " ".join(f"y{'x' * (i % 190)}" for i in range(400)) + " z" * 9 + "".join(f" a{i}" for i in range(300))
    ids = np.frombuffer(next(encoder.encode_many([text])), "<u4").tolist()
    assert ids == reference.encode_ordinary(text)
    assert max(together) < 3_200 and len(together) <= sum(together) / 3_000 + 1


def test_decoding_takes_neighbouring_tokens_as_one_row(reference, monkeypatch):
    decoder, rng = byte_bpe.PairDecoder(), random.Random(6)
    rows = [[rng.randrange(50_000) for _ in range(n)] for n in (*range(20), 0, 64, 1000)]
    wanted = [b"".join(reference.decode_single_token_bytes(t) for t in ids) for ids in rows]
    ordered, plain = [], byte_bpe.np.repeat
    monkeypatch.setattr(byte_bpe.np, "repeat", lambda *a: ordered.append(len(plain(*a))) or plain(*a))
    assert decoder.decode_many(byte_bpe.pa.array(rows, byte_bpe.pa.list_(byte_bpe.pa.int32()))) == wanted
    assert min(ordered) == sum(-(-len(ids) // 8) for ids in rows)


def test_null_and_unknown_ids_have_no_bytes():
    decoder = byte_bpe.PairDecoder()
    given = byte_bpe.pa.array([[15496, None, 995], None, [60_000] * 9 + [0]], byte_bpe.pa.list_(byte_bpe.pa.int32()))
    assert decoder.decode_many(given) == [b"Hello world", b"", b"!"]


def test_decoding_odd_ids(spark):
    rows = [(1, [15496, 995]), (2, []), (3, None), (4, [60_000, 0])]
    table = spark.createDataFrame(rows, "k int, ids array<int>")
    got = {r.k: bytes(r.decoded) for r in decode(table).collect()}
    assert got == {1: b"Hello world", 2: b"", 3: b"", 4: b"!"}
