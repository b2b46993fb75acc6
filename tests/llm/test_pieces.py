"""SentencePiece encoding and decoding against the sentencepiece library."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, store
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from sentencepiece import SentencePieceProcessor

from tidemark.llm import piece_codec
from tidemark.llm.piece_codec import decode_column, encode_column, encode_parts, encode_pieces, load_pieces, merge_rounds

MODEL = tokenizer_path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=MODEL)
ODD = ["", " ", "  ", " lead", "trail ", "a  b", "▁a", "▁▁ ▁x", "\n", "tab\tx", "a\0b", "ﬁ Å", "é Å", "日本𓀀 かな", "ßüÉ Ǆ Σίσυφος", "</s> a <0x41>", "<unk>", "� x", "q" * 700, "ab" * 900, " " * 40, "ab " * 3000, "a" * 5000]
text = st.lists(st.sampled_from([*"ab 'sthero.,!1\n\té▁", "  ", "the", " and", "ing", "aaaa", "Σ", "漢", "😀", "\0"]), max_size=30).map("".join)
ids = st.lists(st.one_of(st.integers(0, 31_999), st.integers(3, 258), st.sampled_from([0, 1, 2, 28705])), max_size=9)


def encode(values):
    found, marks = encode_column(pa.array(values), load_pieces(MODEL))
    return [found[a:b].tolist() for a, b in zip(marks, marks[1:])]


@settings(max_examples=300, deadline=None)
@given(st.lists(text, min_size=1, max_size=4))
def test_encoding_of_any_texts(values):
    assert encode(values) == LIBRARY.encode(values)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abeilnorst", min_size=1, max_size=120))
def test_encoding_of_dense_words(value):
    assert encode([value]) == [LIBRARY.encode(value)]


@settings(max_examples=500, deadline=None)
@given(ids)
def test_decoding_of_any_ids(value):
    found = decode_column(np.array(value, dtype=np.int32), np.array([0, len(value)]), load_pieces(MODEL))
    assert found == [LIBRARY.decode(value).encode()]


def test_rounds_join_many_places_at_once():
    pieces = load_pieces(MODEL)
    symbols = pieces.symbols_of(np.full(4096, ord("a"), dtype=np.uint32))
    merged, sizes, rounds = merge_rounds(symbols, np.array([0, 4096]), pieces)
    assert rounds < 20 and len(merged) == sizes[0] <= len(LIBRARY.encode("a" * 4096))


def test_bytes_of_characters_that_are_no_piece():
    found, sizes = encode_parts(["a𓀀b".encode(), "𓀀".encode()], load_pieces(MODEL))
    assert sizes.tolist() == [6, 4] and found[1:5].tolist() == [load_pieces(MODEL).fallback[b] for b in "𓀀".encode()]


def test_models_that_are_not_covered(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        load_pieces(str(tmp_path / "other.model"))


@pytest.mark.parametrize("entries, slab", [(400_000, 1 << 21), (3, 5)])
def test_digests_of_odd_texts_and_whole_tables(spark, tmp_path, monkeypatch, entries, slab):
    monkeypatch.setattr(piece_codec, "CACHE_ENTRIES", entries)
    monkeypatch.setattr(piece_codec, "ROUND_BYTES", slab)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "twice the key"), (None, "no key"), (99, None)]
    rows += [(r.doc_id + 1000, r.text) for r in documents(spark).collect()]
    docs = store(spark, tmp_path, [(*r, 7, "x") for r in rows], "doc_id long, text string, n_tokens long, ids string", files=3)
    wanted = []
    for key, value in rows:
        found = LIBRARY.encode(value or "", add_eos=True)
        decoded = LIBRARY.decode(found)
        wanted.append((str(key), len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    found = [(str(r.doc_id), *tuple(r)[1:]) for r in encode_pieces(docs, MODEL).collect()]
    assert sorted(found) == sorted(wanted)
    plain = encode_pieces(docs.filter("doc_id < 30"), MODEL, digests=False).collect()
    assert all(r.ids == LIBRARY.encode(t or "", add_eos=True) and r.decoded == LIBRARY.decode(r.ids) for r in plain for t in [dict(rows[:23])[r.doc_id]] if r.doc_id != 3)
    assert encode_pieces(docs.limit(0), MODEL).collect() == []
