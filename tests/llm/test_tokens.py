import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from playtide.llm import byte_bpe, token_counts

from .conftest import EDGES, prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = st.text(st.sampled_from(list("ab \n\t'.▁é中  0129st-_")) | st.characters(codec="utf-8"), max_size=60)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@given(TEXTS)
@settings(max_examples=500, deadline=None)
def test_counts_are_the_librarys(text):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL) if not hasattr(test_counts_are_the_librarys, "m") \
        else test_counts_are_the_librarys.m
    test_counts_are_the_librarys.m = library
    assert token_counts.pre_token_counts(MODEL).of_text(text) == len(library.encode(text))


def test_counts_over_pieces(library, monkeypatch):
    text = prose(1, 3000) + "  " + "x" * 500 + " " * 40 + "</s> <unk>"
    monkeypatch.setattr(token_counts, "PIECE", 100)
    assert token_counts.pre_token_counts(MODEL).of_text(text) == len(library.encode(text))


def test_proven_strings_and_forgetting(library, monkeypatch):
    counts = token_counts.PreTokenCounts(MODEL)
    assert len(counts.proven) > 10_000 and set(counts.proven.values()) == {1}
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    text = prose(2, 500)
    assert counts.of_text(text) == len(library.encode(text))
    assert len(counts) <= len(counts.proven) + 3 and counts.proven.items() <= counts.items()


def test_counts_in_spark(documents, library):
    found = token_counts.count_tokens(documents(EDGES), MODEL).collect()
    assert [(r.doc_id, r.n_tokens) for r in found] == [(i, len(library.encode(t or ""))) for i, t in EDGES]
    assert token_counts.count_tokens(documents([]), MODEL).collect() == []


@given(TEXTS, st.integers(1, 20))
@settings(max_examples=500, deadline=None)
def test_pieces_do_not_change_ids(text, size):
    encoder = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    assert "".join(byte_bpe.pieces(text, size)) == text
    assert byte_bpe.text_ids(text, encoder, size).tolist() == encoder.encode_ordinary(text)


def test_round_trip_in_spark(documents):
    encoder = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    docs = documents(EDGES + [(20, "<|endoftext|> literally")])
    coded = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    for row in coded.collect():
        assert row.ids == encoder.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()
    assert byte_bpe.encode(documents([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_query_digests(spark, tmp_path, documents):
    from playtide.llm import queries
    documents(EDGES).write.parquet(f"{tmp_path}/documents.parquet")
    encoder = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    wanted = sorted((str(i), len(encoder.encode_ordinary(t or "")),
                     hashlib.sha256(",".join(map(str, encoder.encode_ordinary(t or ""))).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGES)
    found = queries.QUERIES["op10_byte_bpe"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == wanted
    counted = queries.QUERIES["op2_token_counts"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.n_bytes for r in counted if r.doc_id}[8] == len(EDGES[9][1].encode())
    assert [r.over_limit for r in counted if r.doc_id == 6] == [True]
