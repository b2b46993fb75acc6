"""Approximate nearest neighbours over balanced posting lists.

Vectors are brought to one length by a further component, so that the largest inner product is the smallest distance.
A bounded sample is halved again and again, at the median along the line between two centres, until parts are small:
the means of these equal parts are the centroids, so lists are about equally long. Centroids lie in the memory of each
worker with a graph of their nearest neighbours, and a beam search over the graph finds the centroids near a vector.

Every vector goes to the list of its nearest centroid and, near a boundary, to those hardly farther. A query opens the
lists whose centroids lie within a ratio of its nearest centroid's distance, so a query amid a cluster opens few and one
between clusters many; the beam is widened until its last centroid is beyond the ratio, so no count ends the choice. The
ratio is measured on every table: some of the queries are held against all vectors, and it is the smallest that finds
the wanted share of their true neighbours in the lists as they are, found by the same search. Lists and queries of a list
are cut into blocks by counts, so no task holds a whole list however many vectors it has; within a block all inner
products are formed.

A query meets the nearest of its lists first, about the square root of their number. The score of its last result there
is a floor, exact for the rest: other lists give only what reaches it, so what a query gathers grows with that root.

Equal vectors are one entry that carries the k + 1 smallest ids, which is all that a result can show of them, and equal
queries are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import release, stored

#: Vectors that centroids are fitted on.
SAMPLE = 60_000
#: Vectors of the sample in a list, unless that makes more than `MOST_LISTS` lists.
LIST = 256
MOST_LISTS = 8_192
#: A vector also joins lists within this ratio of its nearest centroid's distance.
BORDER = 1.003
#: Queries held against all vectors, and the share of their neighbours that the opened lists have to hold.
TRIALS = 512
WANTED = 0.97
#: Width of the first beam; where a beam would hold more than a part of `SCAN` of all centroids, all distances are formed.
BEAM = 32
SCAN = 4
DEGREE = 24
STEPS = 8
SPREAD = 8
#: Rows of a block of a list, and of queries that meet it.
BLOCK = 8_192


@dataclass
class Graph:
    """Centroids, the neighbours of each, and a few of them to start from."""

    centroids: np.ndarray
    squares: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray


def halve(points: np.ndarray, most: int, seed: int = 7) -> np.ndarray:
    """Means of equal parts of `points`, each of at most `most` points."""
    chance = np.random.default_rng(seed)
    waiting, means = [np.arange(len(points))], []
    while waiting:
        part = waiting.pop()
        own = points[part]
        if len(part) <= max(1, most):
            means.append(own.mean(axis=0))
            continue
        centres = own[chance.choice(len(own), 2, replace=False)]
        for _ in range(6):
            near = ((own - centres[0]) ** 2).sum(axis=1) < ((own - centres[1]) ** 2).sum(axis=1)
            if near.all() or not near.any():
                break
            centres = np.array([own[near].mean(axis=0), own[~near].mean(axis=0)])
        order = np.argsort(own @ (centres[1] - centres[0]), kind="stable")
        half = len(part) // 2
        waiting += [part[order[:half]], part[order[half:]]]
    return np.array(means)


def build_graph(centroids: np.ndarray, seed: int = 7) -> Graph:
    """Link every centroid with its nearest ones and with two at random, which keeps the graph in one piece."""
    n = len(centroids)
    squares = (centroids**2).sum(axis=1)
    degree = min(DEGREE, n - 1)
    rows = []
    for at in range(0, n, 1024):
        part = squares[None, :] - 2 * centroids[at : at + 1024] @ centroids.T
        part[np.arange(len(part)), np.arange(at, at + len(part))] = np.inf
        rows.append(np.argpartition(part, degree - 1, axis=1)[:, :degree] if degree else np.zeros((len(part), 0), np.int64))
    near = np.concatenate(rows)
    chance = np.random.default_rng(seed)
    ring = chance.permutation(n)
    place = np.argsort(ring)
    around = np.column_stack([ring[(place + 1) % n], chance.integers(0, n, n)])
    entries = chance.permutation(n)[: max(1, min(n, 2 * int(np.sqrt(n))))]
    return Graph(centroids, squares, np.concatenate([near, around], axis=1), entries)


def nearest_lists(vectors: np.ndarray, graph: Graph, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """For each vector, the centroids a beam search finds, nearest first, and their distances; infinite where none."""
    n, width = len(vectors), min(beam, len(graph.centroids))
    own = (vectors**2).sum(axis=1)
    start = graph.squares[graph.entries][None, :] - 2 * vectors @ graph.centroids[graph.entries].T
    keep = min(width, start.shape[1])
    first = np.argpartition(start, keep - 1, axis=1)[:, :keep]
    ids = np.full((n, width), -1)
    cost = np.full((n, width), np.inf)
    ids[:, :keep], cost[:, :keep] = graph.entries[first], np.take_along_axis(start, first, axis=1)
    seen = np.zeros((n, len(graph.centroids)), dtype=bool)
    seen[np.arange(n)[:, None], graph.entries[None, :]] = True
    done = np.zeros((n, width), dtype=bool)
    for _ in range(max(STEPS, -(-width // SPREAD))):
        order = np.argpartition(np.where(done, np.inf, cost), min(SPREAD, width) - 1, axis=1)[:, :SPREAD]
        chosen = np.take_along_axis(ids, order, axis=1)
        np.put_along_axis(done, order, True, axis=1)
        ahead = graph.neighbours[np.maximum(chosen, 0)].reshape(n, -1)
        price = graph.squares[ahead] - 2 * np.einsum("nkd,nd->nk", graph.centroids[ahead], vectors)
        # of a centroid that several bring, the first counts; known ones do not
        rank = np.argsort(ahead, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ahead, rank, axis=1)
        twice = np.zeros_like(sorted_ids, dtype=bool)
        twice[:, 1:] = sorted_ids[:, 1:] == sorted_ids[:, :-1]
        again = np.zeros_like(twice)
        np.put_along_axis(again, rank, twice, axis=1)
        row = np.arange(n)[:, None]
        price[again | seen[row, ahead] | (np.repeat(chosen, graph.neighbours.shape[1], axis=1) < 0)] = np.inf
        seen[row, ahead] = True
        ids, cost, done = np.concatenate([ids, ahead], axis=1), np.concatenate([cost, price], axis=1), np.concatenate([done, np.zeros_like(again)], axis=1)
        best = np.argpartition(cost, width - 1, axis=1)[:, :width]
        ids, cost, done = (np.take_along_axis(x, best, axis=1) for x in (ids, cost, done))
    order = np.argsort(cost, axis=1, kind="stable")
    distance = np.sqrt(np.maximum(np.take_along_axis(cost, order, axis=1) + own[:, None], 0))
    return np.take_along_axis(ids, order, axis=1), distance


def all_lists(vectors: np.ndarray, graph: Graph) -> tuple[np.ndarray, np.ndarray]:
    """For each vector all centroids, nearest first, and their distances."""
    square = (vectors**2).sum(axis=1)[:, None] + graph.squares[None, :] - 2 * vectors @ graph.centroids.T
    order = np.argsort(square, axis=1, kind="stable")
    return order, np.sqrt(np.maximum(np.take_along_axis(square, order, axis=1), 0))


def farthest(distance: np.ndarray, ratio: float) -> np.ndarray:
    """The distance up to which lists belong to a vector, given that of its nearest one."""
    return ratio * np.maximum(distance, 1e-9) + 1e-12


def lists_within(vectors: np.ndarray, graph: Graph, ratio: float, held: np.ndarray | None = None, least: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector, list and whether it is the nearest one, of all lists within `ratio` of the nearest centroid's distance.

    With `held`, numbers of entries per list, a vector also gets the next lists until they hold `least` entries.
    """
    found = []
    waiting, beam, whole = np.arange(len(vectors)), BEAM, False
    while len(waiting):
        whole = SCAN * beam > len(graph.centroids)
        ids, distance = all_lists(vectors[waiting], graph) if whole else nearest_lists(vectors[waiting], graph, beam)
        wanted = distance <= farthest(distance[:, :1], ratio)
        if held is not None:
            own = np.where(ids >= 0, held[ids], 0)
            wanted |= np.cumsum(own, axis=1) - own < least
        wanted &= ids >= 0
        wanted[:, 0] = True
        # what lies beyond the last one of the beam is unknown while that one is wanted
        done = np.full(len(waiting), True) if whole else ~wanted[:, -1] & (ids[:, -1] >= 0)
        row, place = np.nonzero(wanted & done[:, None])
        found.append((waiting[row], ids[row, place], place == 0))
        waiting, beam = waiting[~done], 2 * beam
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, bool))


def lengthened(vectors: np.ndarray, square: float) -> np.ndarray:
    """Vectors with a component that brings all to the same length."""
    return np.column_stack([vectors, np.sqrt(np.maximum(square - (vectors**2).sum(axis=1), 0))])


def matrix_of(column: pa.Array) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)).astype(np.float64) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """`id` and `v` of the vectors that take part: of the most frequent length, finite, with a non-zero component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    # -0.0 and 0.0 are one value
    return rows.filter(F.size("v") == usual[0]["n"]).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))) if usual else rows


def assign(entries: DataFrame, graph: Graph, square: float) -> DataFrame:
    """`list` for each list that an entry (`uid`, `v`) joins, and whether it is the nearest one (`home`)."""
    shared = entries.sparkSession.sparkContext.broadcast(graph)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                row, lists, home = lists_within(lengthened(matrix_of(batch.column(1)), square), shared.value, BORDER)
                who = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(who), batch.column(1).take(who), pa.array(lists.astype(np.int32)), pa.array(home)], names=["uid", "v", "list", "home"]
                )

    return entries.select("uid", "v").mapInArrow(work, f"uid {entries.schema['uid'].dataType.simpleString()}, v array<double>, list int, home boolean")


def as_long(queries: np.ndarray, square: float) -> np.ndarray:
    """Queries brought to the length of all entries, which changes no order, with a further component of zero."""
    scaled = queries * np.sqrt(square / (queries**2).sum(axis=1))[:, None]
    return np.column_stack([scaled, np.zeros(len(queries))])


def open_lists(queries: DataFrame, graph: Graph, square: float, ratio: float, held: np.ndarray, least: int) -> DataFrame:
    """A row per query (`uid`, `v`) and `list` that it opens: those within `ratio`, and enough to hold `least` entries.

    `first` marks the nearest of them, as many as the square root of their number.
    """
    shared = queries.sparkSession.sparkContext.broadcast((graph, held))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                own, counts = shared.value
                row, lists, _ = lists_within(as_long(matrix_of(batch.column(1)), square), own, ratio, counts, least)
                many = np.bincount(row, minlength=batch.num_rows)
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                place = np.arange(len(row)) - np.repeat(begins, many[row[begins]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(lists.astype(np.int32)), pa.array(place < np.sqrt(many[row]))], names=["uid", "list", "first"]
                )

    return queries.select("uid", "v").mapInArrow(work, f"uid {queries.schema['uid'].dataType.simpleString()}, list int, first boolean")


def true_neighbours(entries: DataFrame, queries: np.ndarray, most: int) -> DataFrame:
    """The `most` entries (`uid`, `v`, `ids`) of largest inner product per query, by all products: `q`, `uid`, `score`, `ids`."""
    shared = entries.sparkSession.sparkContext.broadcast(queries)
    kind = entries.schema["uid"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        score, uid, many = np.zeros((len(own), 0)), np.zeros((len(own), 0), dtype=object), np.zeros((len(own), 0), dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                here = own @ matrix_of(batch.column(1)).T
                best = np.argpartition(-here, min(most, here.shape[1]) - 1, axis=1)[:, :most]
                score = np.concatenate([score, np.take_along_axis(here, best, axis=1)], axis=1)
                uid = np.concatenate([uid, np.array(batch.column(0).to_pylist(), dtype=object)[best]], axis=1)
                many = np.concatenate([many, batch.column(2).to_numpy(zero_copy_only=False)[best]], axis=1)
                best = np.argsort(-score, axis=1, kind="stable")[:, :most]
                score, uid, many = (np.take_along_axis(x, best, axis=1) for x in (score, uid, many))
        q = np.repeat(np.arange(len(own)), score.shape[1])
        names = pa.array(uid.ravel().tolist(), entries_type)
        yield pa.RecordBatch.from_arrays([pa.array(q), names, pa.array(score.ravel()), pa.array(many.ravel())], names=["q", "uid", "score", "many"])

    entries_type = to_arrow_type(entries.schema["uid"].dataType)
    found = entries.select("uid", "v", F.size("ids").cast("long").alias("many")).mapInArrow(work, f"q long, uid {kind}, score double, many long")
    place = F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "uid"))
    return found.withColumn("place", place).filter(F.col("place") <= most)


def ratio_needed(entries: DataFrame, queries: DataFrame, posted: DataFrame, graph: Graph, square: float, held: np.ndarray, k: int) -> float:
    """The least ratio within which queries find `WANTED` of their `k` nearest, measured on `TRIALS` of them.

    The share is that of the lists which the graph search opens; where it misses some, the ratio is raised.
    """
    sample = queries.select("uid", "v").orderBy(F.xxhash64("uid", F.lit(2)), "uid").limit(TRIALS).toArrow()
    if not sample.num_rows or len(graph.centroids) == 1:
        return 1.0
    own, names = matrix_of(sample.column("v").combine_chunks()), sample.column("uid").to_pylist()
    truth = true_neighbours(entries, own, k + 1)
    joined = posted.groupBy("uid").agg(F.collect_set("list").alias("lists"))
    rows = truth.join(joined, "uid").orderBy("q", "place").collect()
    asked = as_long(own, square)
    ids, distance = all_lists(asked, graph)
    nearness = np.zeros(ids.shape)
    np.put_along_axis(nearness, ids, distance / np.maximum(distance[:, :1], 1e-9), axis=1)
    places, costs, weights, seen = [], [], [], [0] * len(own)
    for r in rows:
        # an entry counts by its ids; a query is not its own neighbour
        n = min(r["many"] - (r["uid"] == names[r["q"]]), k - seen[r["q"]])
        if n > 0:
            seen[r["q"]] += n
            places.append((r["q"], r["lists"]))
            costs.append(nearness[r["q"], r["lists"]].min())
            weights.append(n)
    if not costs:
        return 1.0
    order, weights = np.argsort(costs, kind="stable"), np.array(weights)
    share = np.cumsum(weights[order]) / weights.sum()
    for aim in (WANTED, (1 + WANTED) / 2, 1.0):
        ratio = float(np.array(costs)[order][np.searchsorted(share, aim - 1e-12)])
        row, lists, _ = lists_within(asked, graph, ratio, held, k + 1)
        opened = np.zeros(nearness.shape, dtype=bool)
        opened[row, lists] = True
        if weights @ np.array([opened[q, own_lists].any() for q, own_lists in places]) >= WANTED * weights.sum():
            return ratio
    return float("inf")


def meet_lists(posted: DataFrame, opened: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """`uid`, `vec_id`, `score` of the best `k` + 1 per query and block of a list, as far as they reach the query's `floor`."""
    # at most a row per list
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    wants = opened.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("groups"))
    held = stored(sizes.join(wants, "list"), "vector-plan")
    plan = F.broadcast(held)
    deal = lambda parts: F.pmod(F.xxhash64("uid"), F.col(parts)).cast("int")
    left = posted.join(plan, "list").select("list", deal("blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "uid", "v", "ids")
    asking = opened.join(queries, "uid").join(plan, "list")
    right = asking.select("list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), deal("groups").alias("group"), "uid", "v", "floor")
    kind = queries.schema["uid"].dataType.simpleString()

    def meet(stock: pa.Table, queries: pa.Table) -> pa.Table:
        uid, ids, scores = [], [], []
        if stock.num_rows and queries.num_rows:
            x = matrix_of(stock.column("v").combine_chunks())
            q = matrix_of(queries.column("v").combine_chunks())
            names = stock.column("ids").to_pylist()
            least = np.array([i[0] for i in names])
            lowest = queries.column("floor").to_numpy()
            for at in range(0, len(q), 256):
                part = q[at : at + 256]
                rough = part @ x.T
                most = min(k + 9, len(x))
                best = np.argpartition(-rough, most - 1, axis=1)[:, :most]
                # one more time the same way for every block, so that equal vectors have equal scores
                exact = (part[:, None, :] * x[best]).sum(axis=2)
                # what ties with the last one kept is kept as well
                floor = np.sort(exact, axis=1)[:, -min(k + 1, most)]
                for i in range(len(part)):
                    near = best[i]
                    if most < len(x):
                        near = np.flatnonzero(rough[i] >= floor[i] - 1e-9 * max(1.0, abs(floor[i])))
                    value = (part[i] * x[near]).sum(axis=1)
                    order = np.lexsort((least[near], -value))[: k + 1]
                    order = order[value[order] >= lowest[at + i]]
                    if not len(order):
                        continue
                    uid.append(queries.column("uid")[at + i].as_py())
                    ids.append([j for o in order for j in names[near[o]]])
                    scores.append([value[o] for o in order for _ in names[near[o]]])
        return pa.table({"uid": pa.array(uid, queries.schema.field("uid").type), "ids": pa.array(ids, stock.schema.field("ids").type), "scores": pa.array(scores, pa.list_(pa.float64()))})

    met = (
        left.groupBy("list", "block", "group")
        .cogroup(right.groupBy("list", "block", "group"))
        .applyInArrow(meet, f"uid {kind}, ids array<{kind}>, scores array<double>")
    )
    return met.select("uid", F.explode(F.arrays_zip("ids", "scores")).alias("p")).select("uid", F.col("p.ids").alias("vec_id"), F.col("p.scores").alias("score"))


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The `k` vectors of largest inner product found for each vector whose id is divisible by `every`, itself excepted.

    Columns `query_id`, `rank` (from 1), `vec_id`, `score` (inner product of the original vectors in double precision);
    equal scores are ordered by smaller id, and with fewer candidates all are returned. Rows with a null id, or whose
    vector is null, empty, zero, of another length than most, or holds null or non-finite components take no part. Ids
    should be unique; repeated ones count as one where their vectors are equal. Other columns are not read. An empty
    table gives an empty result. The lists opened hold `WANTED` of the neighbours of the queries measured; that is a
    measured share, not a guarantee for each query. Each query opens lists of more than `k` vectors, where there are so many.
    """
    taken = stored(usable(vectors, key, vector), "vectors")
    digest = [F.xxhash64("v"), F.xxhash64(F.lit(1), "v")]
    rows = taken.withColumns({"h1": digest[0], "h2": digest[1]})
    heads = rows.groupBy("h1", "h2").agg(F.min("id").alias("uid"))
    within = F.row_number().over(W.partitionBy("h1", "h2").orderBy("id"))
    shown = rows.select("h1", "h2", "id").distinct().withColumn("place", within).filter(F.col("place") <= k + 1)
    held = shown.groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    entries = stored(
        rows.join(heads, ["h1", "h2"]).filter("id = uid").dropDuplicates(["uid"]).join(held, ["h1", "h2"]).select("uid", "v", "ids"), "vector-entries"
    )
    asked = stored(rows.filter(F.col("id") % every == 0).join(heads, ["h1", "h2"]).select("uid", F.col("id").alias("query_id")).distinct(), "vector-queries")

    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total = entries.agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square")).first()
    n, longest = total["n"], total["square"] or 0.0
    sample = entries.select("uid", "v").orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toArrow()
    points = lengthened(matrix_of(sample.column("v").combine_chunks()), longest) if n else np.zeros((1, 1))
    lists = min(MOST_LISTS, max(1, n // LIST))
    graph = build_graph(halve(points, -(-len(points) // lists)))

    posted = stored(assign(entries, graph, longest).join(entries.select("uid", "ids"), "uid"), "vector-lists")
    searched = stored(entries.select("uid", "v").join(asked.select("uid").distinct(), "uid", "left_semi"), "vector-searched")
    # at most a row per list; entries at home are counted once
    held = np.zeros(len(graph.centroids), dtype=np.int64)
    for r in posted.filter("home").groupBy("list").count().collect():
        held[r["list"]] = r["count"]
    ratio = ratio_needed(entries, searched, posted.select("uid", "list"), graph, longest, held, k)
    opened = stored(open_lists(searched, graph, longest, ratio, held, k + 1), "vector-opened")
    early = opened.filter("first")
    begun = stored(meet_lists(posted, early, searched.withColumn("floor", F.lit(float("-inf"))), k), "vector-begun")
    nth = F.row_number().over(W.partitionBy("uid").orderBy(F.desc("score"), "vec_id"))
    first = begun.groupBy("uid", "vec_id").agg(F.max("score").alias("score")).withColumn("place", nth)
    floors = first.filter(F.col("place") == k + 1).select("uid", F.col("score").alias("floor"))
    floored = searched.join(floors, "uid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    pairs = begun.unionByName(meet_lists(posted, opened.filter("not first"), floored, k))
    pairs = pairs.groupBy("uid", "vec_id").agg(F.max("score").alias("score"))
    order = [F.desc("score"), F.asc("vec_id")]
    top = pairs.withColumn("place", F.row_number().over(W.partitionBy("uid").orderBy(*order))).filter(F.col("place") <= k + 1)
    best = stored(top.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("found")), "vector-found")
    release(taken, entries, posted, searched, opened, begun)
    other = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = asked.join(best, "uid").select("query_id", F.posexplode(F.slice(other, 1, k)).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
