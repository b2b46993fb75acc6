"""Token counts and word BPE against the tokenizers library."""

import hashlib

import pytest
from helpers import documents, store
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from tidemark.llm import bpe_codec, token_counts
from tidemark.llm.bpe_codec import Memo, decode_ids, encode_documents, encode_ids, encode_words, load_vocabulary, merge_exactly
from tidemark.llm.token_counts import count_tokens, encode_lengths, load_tokenizer, pieces_of

BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = ["", " ", "\n\n  a", "a  b", " lead", "trail ", "tab\tx", "it's we'll", "ßüÉ Ǆ Σίσυφος ΑΣ", "漢字 かな", "é Å", "1 22 333", "a b c\x85d\x1ce", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>z", "q" * 700, "ab " * 3000, "​|##", "</w>"]
text = st.lists(st.sampled_from([*"ab 's.,!1\n\té", "  ", "\x1c", " ", "the", " and", "Σ", "ß", "<|endoftext|>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(text)
def test_pieces_count_like_whole_texts(value):
    tokenizer, added = load_tokenizer(BYTES)
    pieces = None if any(a in value for a in added) else pieces_of(value)
    if pieces is not None:
        assert sum(encode_lengths(tokenizer, pieces)) == len(Tokenizer.from_file(BYTES).encode(value, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(text)
def test_word_encoding_and_decoding_of_any_text(value):
    library, vocabulary = Tokenizer.from_file(WORDS), load_vocabulary(WORDS)
    wanted = library.encode(value, add_special_tokens=False).ids
    assert encode_ids(value, vocabulary) == wanted
    assert decode_ids(wanted, vocabulary) == library.decode(wanted, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdeinorstxz", min_size=1, max_size=90))
def test_speculation_equals_exact_merging(word):
    vocabulary = load_vocabulary(WORDS)
    spelt = word + vocabulary.suffix
    exact = merge_exactly(spelt, vocabulary)
    stop = len(word)
    assert bpe_codec._merge_long([*spelt[: stop - 1], spelt[stop - 1 :]], vocabulary) == exact
    assert encode_words([word], vocabulary)[0] == [exact]


def test_some_words_pass_and_some_fail_the_border_check():
    vocabulary = load_vocabulary(WORDS)
    words = [w for t in ("the quick brown fox", "thnttionor erinareanant whtionre", "antidisestablishmentarianism") for w in t.split()]
    _, failing = encode_words(words, vocabulary)
    assert 0 < failing < len(words)


@pytest.mark.parametrize("table_size", [0, 5, 65_536])
def test_counts_do_not_depend_on_the_table(spark, tmp_path, monkeypatch, table_size):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 3)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "twice the key"), (None, "no key"), (99, None)]
    docs = store(spark, tmp_path, [(*r, 7, "x") for r in rows], "doc_id long, text string, n_tokens long, piece string")
    library = Tokenizer.from_file(BYTES)
    wanted = sorted((str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for k, t in rows)
    found = count_tokens(docs, BYTES, limit=3, table_size=table_size).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == wanted
    assert all(r.over_limit == (r.n_tokens > 3) for r in found)
    assert count_tokens(docs.limit(0), BYTES).collect() == []


def test_whole_table_counts(spark):
    library = Tokenizer.from_file(BYTES)
    wanted = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) for r in documents(spark).collect()}
    assert {r.doc_id: r.n_tokens for r in count_tokens(documents(spark), BYTES).collect()} == wanted


def test_digests_of_odd_texts_and_whole_tables(spark, tmp_path):
    library = Tokenizer.from_file(WORDS)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "twice the key"), (None, "no key"), (99, None)]
    rows += [(r.doc_id + 1000, r.text) for r in documents(spark).collect()]
    docs = store(spark, tmp_path, rows)
    wanted = []
    for key, value in rows:
        ids = library.encode(value or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        wanted.append((str(key), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    found = [(str(r.doc_id), *tuple(r)[1:]) for r in encode_documents(docs, WORDS).collect()]
    assert sorted(found) == sorted(wanted)
    plain = encode_documents(docs.filter("doc_id = 1003 or doc_id = 3"), WORDS, digests=False).collect()
    assert all(r.decoded == library.decode(r.ids, skip_special_tokens=False) for r in plain)
    assert encode_documents(docs.limit(0), WORDS).collect() == []


def test_a_memo_keeps_what_is_used():
    memo = Memo(2)
    memo.young.update(a=1, b=2)
    memo.age()
    assert memo.recall("a") == 1 and memo.recall("z") is None and memo.young == {"a": 1}
