"""Quality model, sharding, vector search and the pipeline."""

import zlib

import numpy as np
import pytest
from helpers import SF, documents, store
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import sharding, vector_search
from tidemark.llm.quality_gam import FEATURES, fit_gam, learn, score_quality, text_features, without_rejected
from tidemark.llm.sharding import permute, shard_rows
from tidemark.llm.vector_search import as_long, build_graph, halve, lengthened, lists_within, nearest, nearest_lists


def labels(spark, sf=SF):
    return spark.read.parquet(f"{sf}/labels.parquet")


def test_features_of_texts():
    import pyarrow as pa

    found = text_features(pa.array(["", None, "ab ab\nab ab\n", "A" * 50_000, "É!! x|y #$"]))
    assert found.shape == (5, len(FEATURES)) and np.isfinite(found).all()
    at = FEATURES.index
    assert not found[:2].any()
    assert found[2, at("repeated_neighbours")] == 0.75 and found[2, at("repeated_lines")] == 0.5 and found[2, at("distinct_words")] == 0.25
    assert found[3, at("upper_share")] == 1 and found[4, at("wide_upper_share")] > 0 and found[4, at("shout_share")] > 0


def test_the_model_learns_single_features_and_a_pair():
    chance = np.random.default_rng(1)
    x = np.zeros((4000, len(FEATURES)))
    x[:, :3] = chance.random((4000, 3))
    y = ((x[:, 0] > 0.6) | ((x[:, 1] > 0.5) != (x[:, 2] > 0.5))).astype(float)
    model = fit_gam(x, y)
    assert (1, 2) in model.pairs
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.97
    assert fit_gam(x[:0], y[:0]).score(x[:3]).tolist() == [0.5] * 3
    assert (fit_gam(x[:10], np.ones(10)).score(x[:3]) > 0.9).all()


def test_held_out_accuracy_and_columns(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: r for r in score_quality(docs, labels(spark, sf)).collect()}
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found.values())
    held = [(r.quality, found[r.doc_id]) for r in labels(spark, sf).collect() if found[r.doc_id].held_out]
    good, bad = ([f.score for q, f in held if q == k] for k in (1, 0))
    assert np.mean([q == f.predicted for q, f in held]) > 0.93
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95


def test_scores_do_not_use_held_out_labels_or_other_columns(spark):
    docs, marks = documents(spark), labels(spark)
    turned = marks.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    changed = docs.withColumns({"source": F.lit("s"), "lang": F.lit("xx"), "score": F.lit("clash")})
    assert sorted(map(tuple, score_quality(docs, marks).collect())) == sorted(map(tuple, score_quality(changed, turned).collect()))


def test_quality_edge_cases(spark, tmp_path):
    rows = [(1, "a good line of text."), (1, None), (None, "no key"), (2, ""), (3, "#$% " * 30_000)]
    docs = store(spark, tmp_path, rows)
    marks = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (4, 7)], "doc_id long, quality int")
    found = score_quality(docs, marks).collect()
    assert len(found) == 5 and not next(r for r in found if r.doc_id is None).held_out
    assert len({r.score for r in score_quality(docs, marks.limit(0)).collect()}) == 1
    assert score_quality(docs.limit(0), marks).collect() == []
    assert without_rejected(docs, learn(docs, marks), 0.0).count() == 5


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 1000, 4099])
def test_permutation_is_one_to_one(spark, n):
    found = [r[0] for r in spark.range(n).select(permute(F.col("id"), n, 11)).collect()]
    assert sorted(found) == list(range(n)) and (n < 24 or found != list(range(n)))


def check_shards(found, rows, shards=24):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == sorted(
        (str(k), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in rows
    )
    sizes = [sum(r.shard == s for r in found) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    assert all(r.law == "rows" and r.grown_shard is None for r in found)


def test_shards_of_odd_rows_and_of_hot_copies(spark, tmp_path):
    rows = [(i, f"text {i} é") for i in range(200)] + [(5, None), (5, ""), (None, "x"), (None, None)] + [(7, "the same")] * 900
    docs = store(spark, tmp_path, [(*r, 1, "p") for r in rows], "doc_id long, text string, size int, number string")
    found = shard_rows(docs, 24).collect()
    check_shards(found, rows)
    # the file layout does not matter
    again = shard_rows(store(spark, tmp_path, rows[::-1], files=4).repartition(3), 24).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert shard_rows(docs.limit(0), 24).collect() == []
    assert len({r.shard for r in shard_rows(docs.limit(3), 24).collect()}) == 3


def test_many_hot_kinds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "HOT_ROWS", 16)
    rows = [(7, "the same")] * 400 + [(None, None)] * 90 + [(i, "other") for i in range(100)]
    found = shard_rows(store(spark, tmp_path, rows), 24).collect()
    check_shards(found, rows)
    assert sorted(map(str, found)) == sorted(map(str, shard_rows(store(spark, tmp_path, rows[::-1], files=3), 24).collect()))


def test_no_python_in_the_sharding_plan(spark):
    plan = shard_rows(documents(spark), 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def search(vectors, k):
    """All inner products, by id."""
    out = {}
    for q, v in vectors:
        if q % 20 == 0:
            scored = sorted(((-float((np.array(v) * np.array(w)).sum()), i) for i, w in vectors if i != q))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_search_of_odd_vectors_is_exact_in_small_tables(spark, tmp_path):
    chance = np.random.default_rng(2)
    good = [(i, chance.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    good += [(i, good[40][1]) for i in range(200, 290)] + [(300, (np.array(good[0][1], dtype=np.float32) * np.float32(40)).tolist())]
    bad = [(400, None), (420, []), (440, [0.0] * 8), (460, [1.0, None] * 4), (480, [float("nan")] * 8), (500, [float("inf")] * 8), (520, [1.0] * 5), (None, [1.0] * 8)]
    frame = store(spark, tmp_path, [(*r, "x", 1) for r in good + bad], "vec_id long, embedding array<float>, uid string, rank int")
    wanted = search(good, 20)
    found = {}
    for r in nearest(frame).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert found.keys() == wanted.keys()
    for q, rows in wanted.items():
        assert [i for i, _ in found[q]] == [i for i, _ in rows]
        assert np.allclose([s for _, s in found[q]], [s for _, s in rows], rtol=0, atol=1e-12)
    few = nearest(frame.filter("vec_id in (0, 1, 2)")).collect()
    assert [(r.query_id, r.rank) for r in sorted(few, key=lambda r: r["rank"])] == [(0, 1), (0, 2)]
    assert nearest(frame.limit(0)).collect() == []
    assert nearest(frame.filter("vec_id = 440")).collect() == []


@pytest.mark.parametrize("block", [64, 8192])
def test_recall_over_many_lists(spark, monkeypatch, block):
    monkeypatch.setattr(vector_search, "LIST", 48)
    monkeypatch.setattr(vector_search, "BLOCK", block)
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in frame.collect()]
    matrix, ids = np.array([v for _, v in vectors], dtype=np.float64), np.array([i for i, _ in vectors])
    found = {}
    for r in nearest(frame).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = matrix @ matrix[q]
        score[q] = -np.inf
        hit += len(found[ids[q]] & set(ids[np.argsort(-score)[:20]].tolist()))
    assert hit / (20 * len(found)) >= 0.9
    assert all(len(v) == 20 for v in found.values())


def test_recall_over_thousands_of_lists(spark, tmp_path, monkeypatch):
    """More lists than a fixed number of opened ones would reach."""
    monkeypatch.setattr(vector_search, "LIST", 6)
    chance = np.random.default_rng(8)
    matrix = (chance.normal(size=(10, 32))[chance.integers(0, 10, 12_000)] + chance.normal(size=(12_000, 32))).astype(np.float32)
    frame = store(spark, tmp_path, [(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>", files=4)
    found = {}
    for r in nearest(frame, every=50).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(found) == 240
    hit = 0
    for q, own in found.items():
        score = matrix.astype(np.float64) @ matrix[q].astype(np.float64)
        score[q] = -np.inf
        hit += len(own & set(np.argsort(-score)[:20].tolist()))
    assert hit / (20 * len(found)) >= 0.95


def test_beam_search_finds_the_nearest_centroids():
    chance = np.random.default_rng(5)
    points = chance.normal(size=(6000, 16))
    centroids = halve(points, 10)
    assert 600 <= len(centroids) <= 1024
    ids, distance = nearest_lists(points[:300], build_graph(centroids))
    true = np.sqrt(((points[:300, None, :] - centroids[None]) ** 2).sum(axis=2))
    assert np.mean(ids[:, 0] == true.argmin(axis=1)) > 0.97
    assert np.allclose(distance[:, 0], true[np.arange(300), ids[:, 0]])
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in ids)


def test_lists_within_a_ratio_are_found_however_many():
    chance = np.random.default_rng(6)
    points = chance.normal(size=(6000, 8))
    centroids = halve(points, 10)
    graph = build_graph(centroids)
    own = points[:200]
    true = np.sqrt(((own[:, None, :] - centroids[None]) ** 2).sum(axis=2))
    for ratio in (1.0, 1.2, 3.0, float("inf")):
        wanted = true <= ratio * true.min(axis=1, keepdims=True) + 1e-9
        row, lists, home = lists_within(own, graph, ratio)
        got = np.zeros_like(wanted)
        got[row, lists] = True
        assert len(row) == got.sum() and home.sum() == len(own)
        assert (got & wanted).sum() >= 0.97 * wanted.sum() and (got & ~wanted).sum() <= 0.03 * wanted.sum()
    assert wanted.all() and got.all()
    held = np.full(len(centroids), 3)
    row, _, _ = lists_within(own, graph, 1.0, held, 301)
    assert (np.bincount(row) >= 101).all() and np.bincount(row).max() <= 102
    assert [len(x) for x in lists_within(own[:0], graph, 1.0)] == [0, 0, 0]
    assert np.allclose((as_long(own, 9.0) ** 2).sum(axis=1), 9.0) and lengthened(own, 99.0).shape == (200, 9)


def test_a_query_opens_few_lists_of_a_clustered_table(spark, tmp_path, monkeypatch):
    """Distance decides: of lists in 40 clusters far apart a query opens about those of its own, and finds k vectors."""
    monkeypatch.setattr(vector_search, "LIST", 16)
    opened = []
    whole = vector_search.open_lists

    def counted(*args):
        frame = whole(*args)
        opened.append(frame.count())
        return frame

    monkeypatch.setattr(vector_search, "open_lists", counted)
    chance = np.random.default_rng(9)
    matrix = (8 * chance.normal(size=(40, 16))[np.arange(8000) % 40] + chance.normal(size=(8000, 16))).astype(np.float32)
    frame = store(spark, tmp_path, [(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id long, embedding array<float>", files=4)
    found = {}
    for r in nearest(frame).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(v) == 20 for v in found.values()) and len(found) == 400
    hit = 0
    for q, own in found.items():
        score = matrix.astype(np.float64) @ matrix[q].astype(np.float64)
        score[q] = -np.inf
        hit += len(own & set(np.argsort(-score)[:20].tolist()))
    assert hit / 8000 >= 0.95
    assert opened[0] / 400 < 0.2 * 500


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
        docs = kept
    marks = {r.doc_id: r.quality for r in labels(spark).collect()}
    assert np.mean([marks[r.doc_id] for r in docs.collect() if r.doc_id in marks]) > 0.97
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, corpus_pipeline.encode(spark, docs, SF).collect()))


def test_pipeline_stages_take_odd_rows(spark, tmp_path):
    text = "A line of plain text that says a thing.\nAnd a second line that says one more thing."
    rows = [(1, text, "en", "s", 3), (2, text, "en", "s", 3), (None, None, None, None, None), (4, "", None, "s", 0), (4, "MIT " * 9000, "en", None, 9)]
    docs = store(spark, tmp_path, rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == [], name
        assert stage(spark, docs, SF).count() <= len(rows), name
    kept = corpus_pipeline.lines(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "4", "4", "None"]
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near_copies(spark, docs, SF).collect()) == ["1", "4", "4", "None"]
