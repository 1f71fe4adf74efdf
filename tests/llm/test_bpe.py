import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from likertlake.llm import bpe, queries
from likertlake.llm.share import PORTION

RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.Tokenizer(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def model(spark):
    return queries.tokenizer(spark)


def test_query_against_the_library(spark, sf_dir, texts):
    for r in queries.op7_byte_bpe(spark, sf_dir).collect():
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'slvedm09aé\x1c\x85")), max_size=80))
def test_any_text(text):
    assert OWN.encode(text) == TIKTOKEN.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3000, "ab" * 2000, " " * 3000 + "x", "é" * 1500, "<|endoftext|>", "9" * 700, "A1b2" * 500])
def test_long_pre_tokens(text):
    assert OWN.encode(text) == TIKTOKEN.encode_ordinary(text)
    for piece in (text.encode()[:200], text.encode()[:60]):
        assert bpe.merge(piece, RANKS) == bpe._merge_long(piece, RANKS) or piece in RANKS


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (64, 64), (300, 30)])
def test_stitched_chunks(spark, texts, model, chunk, overlap):
    """Every cut must come out as if there were none, also where chunks never meet."""
    own = [t[:3000] for t in list(texts.values())[:40]]
    own += ["  \n\n a'll  " * 50, "don't we've I'm " * 40, "x" * 500 + " y" * 100, "\t\r\n" * 100, "𝒳é" * 200, "a" * 45, "", None] + own[:3]
    df = spark.createDataFrame(list(enumerate(own)), "i int, text string")
    for r in bpe.encode(df, model, chunk=chunk, overlap=overlap).collect():
        assert r.ids == TIKTOKEN.encode_ordinary(own[r.i] or ""), own[r.i]


@pytest.mark.parametrize("chunk", [1000, 1023, bpe.CHUNK])
def test_characters_of_changing_width(spark, model, chunk):
    """A long text whose every other character has another width, and one of all widths."""
    texts = ["\U0001f600a" * 40_000, "aé你\U0001d4b3 " * 8_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in bpe.encode(df, model, chunk=chunk, overlap=100).collect():
        assert r.ids == TIKTOKEN.encode_ordinary(texts[r.i])


@settings(deadline=None, max_examples=100)
@given(st.lists(st.binary(min_size=2, max_size=40).filter(lambda b: b not in RANKS), max_size=20))
def test_merges_of_many_pieces_at_once(pieces):
    got = bpe.merge_all(pieces, RANKS, OWN.pairs, OWN.joined)
    assert [np.frombuffer(x, np.int32).tolist() for x in got] == [bpe.merge(p, RANKS) for p in pieces]


def test_few_pre_tokens_are_kept(monkeypatch):
    """Those needed for what is encoded are there, however few are kept."""
    monkeypatch.setattr(bpe, "CACHE", 50)
    monkeypatch.setattr(bpe, "AT_ONCE", 200)
    own = bpe.Tokenizer(RANKS, P.PATTERN)
    texts = [" ".join(f"wörd{i * j % 97}x{'y' * (i % 90)}" for j in range(30)) for i in range(60)]
    assert [np.frombuffer(x, np.int32).tolist() for x in own.packed(texts)] == [TIKTOKEN.encode_ordinary(t) for t in texts]
    assert len(own.cache) <= 100


def test_odd_rows(odd, none, model):
    rows = bpe.decode(bpe.encode(odd, model, chunk=1000, overlap=100), model).collect()
    assert len(rows) == odd.count() and set(rows[0].asDict()) == set(odd.columns)
    assert all(bytes(r.bytes) == (r.text or "").encode() for r in rows)
    assert bpe.decode(bpe.encode(none, model), model).collect() == []


def test_decoding_of_unknown_ids(spark, model):
    df = spark.createDataFrame([([0, -1, 10**9],), (None,), ([],)], "ids array<int>")
    got = [r.bytes if r.bytes is None else bytes(r.bytes) for r in bpe.decode(df, model).collect()]
    assert got == [next(k for k, v in RANKS.items() if v == 0), None, b""]


def test_a_worker_has_little_of_a_batch_in_hand(spark, model):
    """All texts of a partition are one batch, of 15 MB here."""

    class Sizes:  # the only id of each text is how many characters came with it
        def packed(self, texts):
            return [np.array([sum(map(len, texts))], np.int32).tobytes()] * len(texts)

    docs = spark.range(3000).selectExpr("id", "repeat(concat('word', id, ' '), 5000 div length(concat('word', id, ' '))) text").coalesce(1)
    sizes = {r.ids[0] for r in bpe.encode(docs, Sizes()).collect()}
    assert max(sizes) < 2 * PORTION and len(sizes) > 1
    same = bpe.decode(bpe.encode(docs, model), model).where("bytes = cast(text as binary)")
    assert same.count() == 3000
