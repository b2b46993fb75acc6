"""Phrases against counting every place, and the registered query against SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import LOW, SF, store

from tidemark.llm import bitmaps
from tidemark.llm.arrow_text import flat_texts, lower_ascii
from tidemark.llm.collocations import SQL, _squeezed, chunk_counts, collocations, parse
from tidemark.llm.queries import QUERIES

ODD = ["", None, " \t ", "...", "One", "one two", "One  two\tTHREE, one two;three\nfour", "a.b.c", "a\x0bb a\x0cb a\x0db", "Ünder DEN ünder den", "x" * 5000 + " y", "the end " * 3000]


def pieces(text):
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW))]


def brute(rows, least=30, top=2000):
    """The result by counting phrases at every place."""
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            total[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    chosen = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    held = Counter()
    for (lang, w), a in chosen.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                held[lang, w[i : i + k]] = max(held[lang, w[i : i + k]], a)
    out = {}
    for (lang, w), a in chosen.items():
        if 100 * held[lang, w] >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, total[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def prose(seed=5, n=120):
    chance = random.Random(seed)
    voc = ["the", "of", "in", "New", "York", "états", "unis", "machine", "Learning", "a", "b1", "x-y"]
    passage = " ".join(chance.choice(voc) for _ in range(60))
    mark = lambda: chance.choice([" ", " ", " ", " ", "\t ", ", ", ". ", "\n"])
    rows = []
    for i in range(n):
        text = "".join(chance.choice(voc) + mark() for _ in range(chance.randrange(1, 120)))
        rows.append((i, chance.choice(["en", "fr", None, "und"]), text + (passage if i % 3 == 0 else "")))
    return rows + [(500 + i, "en", t) for i, t in enumerate(ODD)] + [(None, "en", rows[0][2]), (1, "en", rows[0][2])]


@pytest.mark.parametrize("period", [1, 3, 12])
def test_chunks_cover_every_phrase_once(period):
    column = pa.array([t for _, _, t in prose(9, 30)])
    data, marks = flat_texts(column)
    data, marks = _squeezed(lower_ascii(data), marks)
    starts, ends, own, text = parse(data, marks, period)
    got, wanted = Counter(), Counter()
    for s, e, n, t in zip(starts.tolist(), ends.tolist(), own.tolist(), text.tolist()):
        w = data[s:e].tobytes().decode().split(" ")
        got.update((t, k, tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(n) if i + k <= len(w))
    for t, value in enumerate(column.to_pylist()):
        for w in pieces(value):
            wanted.update((t, k, tuple(w[i : i + k])) for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
    assert got == wanted


def test_passages_share_chunks_wherever_they_stand(spark, tmp_path):
    chance = random.Random(1)
    passage = " ".join(str(chance.randrange(1000)) for _ in range(400))
    rows = [(i, "en", f"{i} " * i + passage + f" {i}" * 7) for i in range(20)]
    chunks = chunk_counts(store(spark, tmp_path, rows, "doc_id long, lang string, text string")).collect()
    assert sum(c.own for c in chunks if c.n == 20) > 300 and sum(c.n * c.own for c in chunks) == sum(len(t.split()) for _, _, t in rows)


@pytest.mark.parametrize("least, top, bits", [(30, 2000, 1 << 28), (4, 7, 1 << 28), (2, 2000, 1 << 8)])
def test_collocations_equal_counting(spark, tmp_path, monkeypatch, least, top, bits):
    monkeypatch.setattr(bitmaps, "MOST_BITS", bits)
    rows = prose()
    docs = store(spark, tmp_path, [(*r, 1, "x") for r in rows], "doc_id long, lang string, text string, n int, phrase string", files=3)
    wanted = brute([r[1:] for r in rows], least, top)
    assert found(collocations(docs, least=least, top=top)) == wanted and wanted
    assert found(collocations(docs.limit(0))) == []


def test_bits_of_a_large_set_let_others_pass_only(spark, monkeypatch):
    keys = np.arange(0, 1 << 40, 1 << 30, dtype=np.int64) * 3 + 17
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for most in (1 << 8, 1 << 28):
        monkeypatch.setattr(bitmaps, "MOST_BITS", most)
        assert bitmaps.hits_sized(bitmaps.sized_bitmap(frame, "key", len(keys)), keys.view(np.uint64)).all()


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert found(QUERIES["op13_collocations"](spark, SF)) == sorted(con.execute(SQL).fetchall())
