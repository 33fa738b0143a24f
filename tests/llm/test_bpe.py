"""The transducer and the decoder against tiktoken, and the columns they add."""

from __future__ import annotations

from array import array

import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from stayledger.llm import bpe

PATH = str(public.path("byte_bpe_multi_50k.tiktoken"))
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = bpe.Encoder(RANKS, public.PATTERN, bpe.newer_characters(public.PATTERN))
# a vocabulary with a token that no merges lead to, and one that ties with itself
TOY = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258, b"bab": 259, b"xyz": 260, b"aaaa": 261}
ANY = st.characters(exclude_categories=["Cs"])


def ids_of(own: bpe.Encoder, text: str) -> list[int]:
    return array("i", b"".join(own.stream(text))).tolist()


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(ANY, max_size=60), st.text("etaoinsrhl .'\n1", max_size=200), st.lists(st.sampled_from(sorted(RANKS)), max_size=20).map(lambda w: b"".join(w).decode("utf-8", "replace"))))
def test_same_ids_as_the_library_and_back(text):
    ids = ids_of(OWN, text)
    assert ids == LIBRARY.encode_ordinary(text)
    decoder = bpe.decoder(PATH)
    decoder.begin()
    assert "".join(decoder.feed([i]) for i in ids) + decoder.finish() == text


@settings(max_examples=150, deadline=None)
@given(st.text("abxyz", max_size=40))
def test_toy_vocabulary(text):
    library = tiktoken.Encoding("toy", pat_str=".+", mergeable_ranks=TOY, special_tokens={})
    own = bpe.Encoder(TOY, ".+")
    assert ids_of(own, text) == library.encode_ordinary(text)
    if text.encode() not in TOY:
        assert own.transducer.encode(text.encode()) == library.encode_ordinary(text)


@pytest.mark.parametrize("look", [1, 7, 130, 4096])
def test_tokens_come_out_while_a_piece_goes_on(monkeypatch, look):
    monkeypatch.setattr(bpe, "LOOK", look)
    own, piece, read, got = bpe.Transducer(RANKS), b"antidisestablishmentarianism" * 40, [], []

    def tape():
        for byte in piece:
            read.append(byte)
            yield byte

    for part in own.stream(tape()):
        got += part
        behind = len(read) - sum(len(own.words[i]) for i in got)
        assert behind <= 2 * max(map(len, RANKS)) + look
    assert got == LIBRARY.encode_ordinary(piece.decode())


def test_vocabulary_without_bytes():
    with pytest.raises(ValueError, match="single bytes"):
        bpe.Transducer({b"a": 0})


def test_newer_characters_are_other_characters():
    newer = bpe.newer_characters(public.PATTERN)
    text = "".join(f"a{c}1{c} {c}!" for c in newer[:: max(1, len(newer) // 200)])
    assert ids_of(OWN, text) == LIBRARY.encode_ordinary(text)


def test_stretches_don_t_change_ids(monkeypatch):
    text = "Some words,  and more\n\n of them don't end.   \t x" * 30 + "unbroken" * 40
    whole = ids_of(OWN, text)
    for size in (1, 7, 100):
        monkeypatch.setattr(bpe, "STRETCH", size)
        assert ids_of(bpe.Encoder(RANKS, public.PATTERN), text) == whole == LIBRARY.encode_ordinary(text)


def test_forgetting_doesn_t_change_ids(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 3)
    own = bpe.Encoder(RANKS, public.PATTERN)
    monkeypatch.setattr(bpe, "STATES", 5)
    monkeypatch.setattr(bpe, "PAIRS", 3)
    text = "alpha beta gamma delta epsilon zeta alpha beta unwritten gammas" * 3
    assert ids_of(own, text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(ANY, max_size=40), st.text("etaoinsrhl .\n1", max_size=80)), max_size=30))
def test_texts_together(texts):
    own = bpe.Encoder(RANKS, public.PATTERN, bpe.newer_characters(public.PATTERN)) if len(texts) == 1 else OWN
    found = [array("i", ids).tolist() for ids in own.encode(iter(texts))]
    assert found == [LIBRARY.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("stretch, abreast, states, pairs", [(1 << 20, 8192, 50_000, 400_000), (60, 8192, 50_000, 400_000), (1 << 20, 2, 5, 3)])
def test_short_pieces_run_side_by_side(monkeypatch, stretch, abreast, states, pairs):
    for name, value in (("STRETCH", stretch), ("ABREAST", abreast), ("STATES", states), ("PAIRS", pairs)):
        monkeypatch.setattr(bpe, name, value)
    own, alone = bpe.Encoder(RANKS, public.PATTERN), []
    plain = own.transducer.stream
    monkeypatch.setattr(own.transducer, "stream", lambda piece: alone.append(piece) or plain(piece))
    texts = ["", "Unwritten gammas, thorreou ndernt", "nterti" * 30, "éèêxyz wörtlichkeiten", "thorreou " * 30, ""] * 2
    found = [array("i", ids).tolist() for ids in own.encode(texts)]
    assert found == [LIBRARY.encode_ordinary(t) for t in texts]
    assert set(alone) == {b"nterti" * 30}


def test_decoder_waits_for_whole_characters():
    decoder = bpe.Decoder({b: bytes([b]) for b in range(256)})
    assert [decoder.feed([b]) for b in "é€".encode()] == ["", "é", "", "", "€"]
    assert decoder.feed("€".encode()[:2]) == "" and decoder.finish() == "�"
    decoder.begin()
    assert decoder.feed([0xE2, 0x41]) == "�A" and decoder.finish() == ""
    with pytest.raises(ValueError, match="300"):
        decoder.feed([300])


def test_columns(spark):
    long = "a long text, " * 200_000
    rows = [(1, "Hello, world"), (2, None), (3, ""), (1, "Hello, world"), (None, "<|endoftext|>"), (4, long)]
    docs = spark.createDataFrame([(k, t, "kept", 1.5) for k, t in rows], "doc_id long, text string, `a b` string, IDS double")
    found = bpe.decode(bpe.encode(docs, PATH, public.PATTERN), PATH)
    assert found.columns == ["doc_id", "text", "a b", "ids", "decoded"]
    for r in found.collect():
        assert r.ids == LIBRARY.encode_ordinary(r.text or "") and r.decoded == (r.text or "") and r["a b"] == "kept"
    assert bpe.encode(docs.limit(0), PATH, public.PATTERN).count() == 0
    none = spark.createDataFrame([(1, None), (2, []), (3, [None, 65])], "n int, ids array<int>")
    assert {r.n: r.decoded for r in bpe.decode(none, PATH).collect()} == {1: "", 2: "", 3: LIBRARY.decode([65])}
