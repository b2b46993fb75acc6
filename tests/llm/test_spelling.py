"""Spelling groups against all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LOW, documents, store
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import spelling
from tidemark.llm.spelling import group_spellings, run_counts, search_lists


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counts(rows, every=31, least=7):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least:
                total[run] += 1
    return total


def groups(rows, every=31, least=7, least_n=2, times=10):
    """The result by comparing all pairs of words of like length."""
    words = {w: n for w, n in counts(rows, every, least).items() if n >= least_n}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    out = {}
    for w, n in words.items():
        near = [v for k in (-1, 0, 1) for v in by_size.get(len(w) + k, []) if one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best is not None and words[best] >= times * n else None, n, len(near))
    rows = []
    for w, (form, n, near) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, near, words[form] if form else None))
    return sorted(rows, key=lambda r: r[0])


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def variants(seed=3, size=150):
    """Texts with dense vocabularies, chains of forms, umlauts, nulls and repeated keys."""
    chance = random.Random(seed)
    stems = ["".join(chance.choice(letters) for _ in range(chance.randrange(6, 10))) for letters in ("abé", "ab") for _ in range(size)]
    rows = [(i, " ".join(chance.choice(stems).capitalize() * chance.choice([1, 1, 2]) for _ in range(chance.randrange(99)))) for i in range(40)]
    rows += [(i, "Anderswo " * 300 + "anderwo " * 30 + "anerwo andero " * 9 + "ndersw anderwos " * 3) for i in (50, 51)]
    rows += [(None, "abababa ÀÿÀÿÀÿÀ ×÷×÷×÷×"), (3, None), (4, ""), (3, "abababa1abababa_ABABABA"), (60, "x" * 300 + " " + "x" * 299), (61, "x" * 300 + " " + "x" * 299)]
    return rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=0, max_size=7), min_size=1, max_size=25, unique=True))
def test_lists_give_all_pairs_one_edit_apart(texts):
    texts = sorted(texts)
    n, wanted = len(texts), set()
    sizes = {len(t) for t in texts}
    for least in sizes:
        query, row = search_lists(np.zeros(n, dtype=np.int64), texts, np.full(n, least), np.zeros(n, dtype=bool))
        pairs = list(zip(query.tolist(), row.tolist()))
        assert len(pairs) == len(set(pairs))
        wanted |= {(i, j) for i in range(n) for j in range(n) if one_edit(texts[i], texts[j]) and min(len(texts[i]), len(texts[j])) == least}
        assert set(pairs) == {p for p in wanted if min(len(texts[p[0]]), len(texts[p[1]])) == least}


def test_lists_stay_apart():
    query, row = search_lists(np.array([0, 0, 1, 1]), ["ab", "ac", "ab", "xy"], np.full(4, 2), np.zeros(4, dtype=bool))
    assert sorted(zip(query.tolist(), row.tolist())) == [(0, 1), (1, 0)]
    late = search_lists(np.zeros(2, dtype=np.int64), ["aab", "aac"], np.full(2, 2), np.ones(2, dtype=bool))
    assert len(late[0]) == 0


@pytest.mark.parametrize("size, slab", [(1, 4), (3, 1), (7, 20), (500, 1000)])
def test_lists_may_span_batches(monkeypatch, size, slab):
    monkeypatch.setattr(spelling, "SLAB_ROWS", slab)
    rows = [(False, 3, 2, shared, rest, n + 1) for shared in ("aaa", "aab", "abc") for n, rest in enumerate(["aa", "ab", "abb", "bb", "cd"])]
    table = pa.Table.from_pylist([dict(zip(["late", "front", "open", "shared", "rest", "n"], r)) for r in rows])
    out = [r for b in spelling._search_batches(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    assert len(out) == 12 and {r["word"] for r in out if r["best"].startswith("abc")} == {"abcaa", "abcab", "abcabb", "abcbb"}
    assert {(r["word"], r["near"], r["best"], r["best_n"]) for r in out if r["word"].startswith("aaa")} == {
        ("aaaaa", 1, "aaaab", 2), ("aaaab", 3, "aaabb", 4), ("aaaabb", 2, "aaabb", 4), ("aaabb", 2, "aaaabb", 3),
    }


def test_counts_of_misspelt_runs(spark, tmp_path):
    rows = variants()
    for every in (1, 3, 31):
        got = {r.word: r.n for r in run_counts(store(spark, tmp_path, rows, files=2), every=every).collect()}
        assert got == counts(rows, every)


@pytest.mark.parametrize("most", [2, 9, 4096])
def test_groups_equal_all_pairs(spark, tmp_path, most):
    rows = variants()
    docs = store(spark, tmp_path, [(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int", files=3)
    wanted = groups(rows)
    assert found(group_spellings(docs, most=most)) == wanted
    assert any(r[1] and r[2] != r[1] for r in wanted) and any(r[4] > 3 for r in wanted), sorted(r[4] for r in wanted)[-3:]
    assert found(group_spellings(docs.limit(0), most=most)) == []


def test_whole_table_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(group_spellings(documents(spark))) == groups(rows)
