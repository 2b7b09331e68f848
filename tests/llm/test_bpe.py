import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from histdim.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "e", "th", "in", "ing", " ", "\n", "  ", "1", "23", "é", "ß", "😀", "　", "\x1c", "\x85", "日本", "!", "?!",
         "'s", "'ll", "_", "́", "İ", "²", "​", "\x00", "zq", "tion", "WARC", "\t"]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(bpe._read(PATH), PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def ids_text(library, text):
    return " ".join(map(str, library.encode_ordinary(text)))


def test_random_texts_as_the_library(codec, library):
    rnd = random.Random(4)
    for _ in range(4000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(60)))
        assert codec.encode(text) == ids_text(library, text)
        assert codec.decode(codec.encode(text)) == text.encode()


def test_random_bytes_of_one_piece(codec, library):
    """Pieces that no whole token spells, of letters only, so that the pattern keeps them whole."""
    rnd = random.Random(5)
    for _ in range(2000):
        piece = "".join(rnd.choice("abcdeéßñtionghszx") for _ in range(rnd.randrange(1, 40)))
        assert codec.encode_piece(piece.encode()) == library.encode_ordinary(piece)


@pytest.mark.parametrize("text", ["a" * 30000, " " * 20000, "ab" * 9000, "zq" * 3000, "\n" * 5000 + "x", "<|endoftext|>"])
def test_long_pieces(codec, library, text):
    assert codec.encode(text) == ids_text(library, text)


def test_full_memo_tables_are_emptied(monkeypatch, library, codec):
    monkeypatch.setattr(bpe, "PIECES_KEPT", 5)
    monkeypatch.setattr(bpe, "PAIRS_KEPT", 5)
    own = bpe.BytePairCodec(codec.ranks, PATTERN)
    text = "thereaea ndonthing ereation wheaonst blelyth " * 3
    assert own.encode(text) == ids_text(library, text)
    assert len(own.memo) <= 5 and len(own.pairs) <= 5


def test_documents(spark, odd_docs, make_docs, library):
    want = sorted(str((r.doc_id, r.text or "")) for r in odd_docs.collect())
    encoded = bpe.encode_documents(odd_docs, PATH, PATTERN)
    assert sorted(str((r.doc_id, library.decode(r.ids))) for r in encoded.collect()) == want
    decoded = bpe.decode_documents(encoded, PATH, PATTERN)
    assert sorted(str((r.doc_id, bytes(r.data).decode())) for r in decoded.collect()) == want
    for r, e in zip(odd_docs.orderBy("doc_id", "text").collect(),
                    bpe.round_trip(odd_docs.orderBy("doc_id", "text"), PATH, PATTERN).collect()):
        ids = library.encode_ordinary(r.text or "")
        assert (e.doc_id, e.n_tokens) == (r.doc_id, len(ids))
        assert e.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert e.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.round_trip(make_docs([]), PATH, PATTERN).count() == 0
