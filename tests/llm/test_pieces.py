"""Piece encoding and decoding against the library."""

import hashlib
import random

import pytest
import sentencepiece

from starfold.llm import pieces
from starfold.llm.common import prepare
from starfold.llm.queries import QUERIES, piece_model_path, tokenizer_path

ALPHABETS = ["abcdefghij ", "ab ", " \t\n", "aéß漢字かな😀▁ \x00", "etaoin shrdlu<>/s0x", "  a", "   ▁▁th", "0123456789+-*/(){}[];\n    "]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def odd_texts():
    rng = random.Random(4)
    out = []
    for _ in range(3000):
        letters = rng.choice(ALPHABETS)
        out.append("".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 10, 40, 100]))))
    out += ["", "a" * 5000, " " * 5000, " " * 100 + "the", "the <s> </s> <unk> <0x41>", "�", "\n", "▁", " ▁ "]
    return out + ["".join(rng.choice("abcdefghijklmnop") for _ in range(9000))]


@pytest.mark.parametrize("longest", [1, 20, 2048, 10**9])
def test_encoding_is_the_library_s(library, monkeypatch, longest):
    """Rounds and heap give the library's ids, whichever takes a word."""
    monkeypatch.setattr(pieces, "LONG", longest)
    texts = odd_texts()
    model = pieces.PieceModel(piece_model_path())
    assert [i.tolist() for i in model.encode(texts)] == library.encode(texts)


def test_words_are_forgotten_and_found_again(library, monkeypatch):
    monkeypatch.setattr(pieces, "KEEP", 10)
    model = pieces.PieceModel(piece_model_path())
    for text in odd_texts()[:200]:
        assert model.encode([text, None, text])[2].tolist() == library.encode(text)


def test_decoding_of_any_ids(library):
    """Broken byte runs, control pieces and leading spaces too."""
    model = pieces.PieceModel(piece_model_path())
    rng = random.Random(8)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(3), rng.randrange(29870, 29875)]) for _ in range(rng.randrange(9))]
        assert model.decode(ids) == library.decode(ids)
    for text in odd_texts():
        assert model.decode(library.encode(text)) == library.decode(library.encode(text))


def test_other_models_are_refused():
    with pytest.raises(Exception):
        pieces.PieceModel(tokenizer_path())


def test_documents(spark, library):
    """Nulls, long texts, repeated rows and columns named like results."""
    texts = [None, "", "one two", "one two", "x" * 200_000, "lorem ipsum " * 20_000, *odd_texts()[:300]]
    rows = [(i if i != 3 else None, t, "clash", 5) for i, t in enumerate(texts)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = sorted((r.doc_id if r.doc_id is not None else 3, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.token_digests(docs, piece_model_path()).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = library.encode([t or "" for t in texts])
    assert got == [(i, len(x), sha(",".join(map(str, x))), sha(library.decode(x) if x else "")) for i, x in enumerate(ids)]
    whole = {r.doc_id: (r.ids, r.decoded) for r in pieces.encode_documents(docs, piece_model_path()).collect()}
    assert whole[2] == (library.encode("one two"), "one two") and whole[0] == ([], "")
    assert pieces.token_digests(docs.where("doc_id < 0"), piece_model_path()).count() == 0


def test_query_on_given_table(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op12_sentencepiece"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
