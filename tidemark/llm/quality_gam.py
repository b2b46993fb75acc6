"""Document quality as a generalised additive model with pairwise interactions.

Features are numbers of the text alone. Fitting turns each feature into bins and boosts in cycles: every cycle visits
all features, fits a tree of at most four leaves on that one feature to the current gradient, and adds a small part of
it to the feature's lookup table. The pairs that still explain most of the gradient then get two-dimensional tables in
the same way. A score is the sum of the entries that a text's bins select, so scoring is a few array additions per
batch, map-side, with tables of a few kilobytes.

The rows to learn from are a bounded sample of the labelled documents (`MOST_ROWS`, by the hash of the key); features
and scores are those of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrow_text import NOT_SPACE, byte_set, flat_texts, lower_ascii, slices, span_hashes, word_spans

#: Bound of the sample that is learned from.
MOST_ROWS = 200_000
BINS = 48
CYCLES = 60
PAIR_CYCLES = 30
PAIRS = 6
RATE = 0.15
RIDGE = 1.0

# what a byte counts as; the first class is everything else
_CLASSES = {
    "upper": byte_set((0x41, 0x5A)),
    "lower": byte_set((0x61, 0x7A)),
    "digit": byte_set((0x30, 0x39)),
    "space": byte_set((0x20, 0x20), (0x09, 0x0D)),
    "stop": byte_set((0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F)),
    "shout": byte_set((0x21, 0x21)),
    "bar": byte_set((0x7C, 0x7C), (0x3C, 0x3C), (0x3E, 0x3E)),
    "sign": byte_set((0x23, 0x26), (0x2A, 0x2B), (0x3D, 0x3D), (0x40, 0x40), (0x5E, 0x5E), (0x7E, 0x7E)),
    "wide": byte_set((0x80, 0xFF)),
}
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _n, _table in enumerate(_CLASSES.values(), start=1):
    _CLASS_OF[_table] = _n
_NOT_NEWLINE = ~byte_set((0x0A, 0x0A))

FEATURES = [
    "log_bytes",
    "log_words",
    "word_length",
    *[f"{name}_share" for name in _CLASSES],
    "wide_upper_share",
    "repeated_neighbours",
    "distinct_words",
    "repeated_lines",
    "words_per_line",
    "capital_words",
]


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Number of distinct hashes of each owner; owners ascend."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    return np.bincount(o[new], minlength=n)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of `FEATURES` per text; an empty or null text has zeros."""
    data, marks = flat_texts(column)
    out = np.zeros((len(marks) - 1, len(FEATURES)))
    for first, last in slices(marks):
        part, cut = data[marks[first] : marks[last]], marks[first : last + 1] - marks[first]
        out[first:last] = _slice_features(part, cut)
    return out


def _slice_features(data: np.ndarray, marks: np.ndarray) -> np.ndarray:
    n, k = len(marks) - 1, len(_CLASSES) + 1
    sizes = np.diff(marks)
    classes = _CLASS_OF[data]
    counts = np.bincount(np.repeat(np.arange(n) * k, sizes) + classes, minlength=n * k).reshape(n, k)
    starts, ends, bounds = word_spans(data, marks, NOT_SPACE)
    words = np.diff(bounds)
    owner = np.repeat(np.arange(n), words)
    hashes = span_hashes(lower_ascii(data), starts, ends)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    line_starts, line_ends, line_bounds = word_spans(data, marks, _NOT_NEWLINE)
    lines = np.diff(line_bounds)
    line_owner = np.repeat(np.arange(n), lines)
    line_kinds = _distinct(line_owner, span_hashes(data, line_starts, line_ends), n)
    # letters of two bytes from U+00C0 to U+00DE are capitals
    capital = np.zeros(len(data), dtype=bool)
    capital[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    capitals = np.bincount(np.repeat(np.arange(n), sizes)[capital], minlength=n)
    begins = capital[starts] | (classes[starts] == 1) if len(starts) else np.zeros(0, dtype=bool)
    safe = lambda x: np.maximum(x, 1)
    letters = safe(counts[:, 1] + counts[:, 2] + counts[:, -1])
    return np.column_stack(
        [
            np.log1p(sizes),
            np.log1p(words),
            (sizes - counts[:, 4]) / safe(words),
            counts[:, 1] / letters,
            counts[:, 2] / letters,
            *(counts[:, 3:] / safe(sizes)[:, None]).T,
            capitals / letters,
            np.bincount(owner[same], minlength=n) / safe(words),
            _distinct(owner, hashes, n) / safe(words),
            (lines - line_kinds) / safe(lines),
            np.log1p(words / safe(lines)),
            np.bincount(owner[begins], minlength=n) / safe(words),
        ]
    )


@dataclass
class Gam:
    """Cut points per feature, a table per feature, and tables of pairs."""

    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, features: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, features[:, j], side="right") for j, c in enumerate(self.cuts)]

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        bins = self.bins(features) if self.tables else []
        total = np.full(len(features), self.base)
        for b, t in zip(bins, self.tables, strict=True):
            total += t[b]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins with gradient and curvature sums."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _small_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree of depth two."""
    out = np.zeros(len(g))
    gain, at = _best_cut(g, h)
    edges = [0, len(g)]
    if gain > 1e-9:
        inner = [at]
        for low, high in ((0, at), (at, len(g))):
            more, place = _best_cut(g[low:high], h[low:high])
            if more > 1e-9:
                inner.append(low + place)
        edges = sorted({0, len(g), *inner})
    for low, high in zip(edges, edges[1:]):
        out[low:high] = g[low:high].sum() / (h[low:high].sum() + RIDGE)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and cell values of the best tree that cuts the first feature once and then each side of the second."""
    rows_g, rows_h = g.cumsum(axis=0), h.cumsum(axis=0)
    best, cell = 0.0, np.zeros_like(g)
    whole = g.sum() ** 2 / (h.sum() + RIDGE)
    for at in range(1, len(g)):
        sides = ((rows_g[at - 1], rows_h[at - 1]), (rows_g[-1] - rows_g[at - 1], rows_h[-1] - rows_h[at - 1]))
        cuts = [_best_cut(*side) for side in sides]
        gain = sum(c[0] + s[0].sum() ** 2 / (s[1].sum() + RIDGE) for c, s in zip(cuts, sides)) - whole
        if gain > best + 1e-9:
            best, cell = gain, np.zeros_like(g)
            for part, (_, place), (sg, sh) in zip((slice(0, at), slice(at, None)), cuts, sides):
                cell[part, :place] = sg[:place].sum() / (sh[:place].sum() + RIDGE)
                cell[part, place:] = sg[place:].sum() / (sh[place:].sum() + RIDGE)
    return best, cell


def fit_gam(features: np.ndarray, labels: np.ndarray) -> Gam:
    """Boost in cycles over features, then over the best pairs. Without two classes the score is the smoothed share."""
    ones, n = float(labels.sum()), len(labels)
    share = (ones + 1) / (n + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if n == 0 or ones in (0, n):
        return model
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(features[:, j], steps)) for j in range(features.shape[1])]
    bins = model.bins(features)
    widths = [len(c) + 1 for c in model.cuts]
    model.tables = [np.zeros(w) for w in widths]
    total = np.full(n, model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(CYCLES):
        for j, (b, w) in enumerate(zip(bins, widths)):
            g, h = slopes()
            step = RATE * _small_tree(np.bincount(b, g, w), np.bincount(b, h, w))
            model.tables[j] += step
            total += step[b]

    def on_grid(i: int, j: int) -> tuple[float, np.ndarray]:
        g, h = slopes()
        code, size = bins[i] * widths[j] + bins[j], widths[i] * widths[j]
        shape = (widths[i], widths[j])
        return _pair_tree(np.bincount(code, g, size).reshape(shape), np.bincount(code, h, size).reshape(shape))

    gains = {(i, j): on_grid(i, j)[0] for i in range(len(bins)) for j in range(i + 1, len(bins))}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS]
    model.pair_tables = [np.zeros((widths[i], widths[j])) for i, j in model.pairs]
    for _ in range(PAIR_CYCLES):
        for k, (i, j) in enumerate(model.pairs):
            step = RATE * on_grid(i, j)[1]
            model.pair_tables[k] += step
            total += step[bins[i], bins[j]]
    return model


def held_out(key: Column) -> Column:
    """Rows kept from learning: checksum of the key as text leaves 2 modulo 4; false for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> Gam:
    """Fit on labelled documents that are not held out; several labels of a key are averaged, nulls ignored."""
    marked = (
        labels.select(F.col("doc_id").alias("key"), F.col("quality").cast("double").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isin(0.0, 1.0) & ~held_out(F.col("key")))
        .groupBy("key")
        .agg((F.avg("label") >= 0.5).cast("double").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(most)
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, found.T)], names=["key", "label", *FEATURES])

    texts = docs.select(F.col("doc_id").alias("key"), F.col("text").cast("string").alias("text"))
    # at most `most` short rows, so small enough to send whole
    chosen = texts.join(F.broadcast(marked), "key").select(F.col("key").cast("string"), "text", "label")
    rows = (
        chosen.mapInArrow(measure, "key string, label double, " + ", ".join(f"{f} double" for f in FEATURES))
        .orderBy(F.xxhash64("key"), "key", *FEATURES)
        .limit(most)
        .drop("key")
        .toArrow()
    )
    matrix = np.column_stack([rows.column(f).to_numpy() for f in FEATURES]) if rows.num_rows else np.zeros((0, len(FEATURES)))
    return fit_gam(matrix, rows.column("label").to_numpy())


def scored(docs: DataFrame, model: Gam, name: str) -> DataFrame:
    """`docs` with one more column, the score of `text`; all rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score(text_features(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def without_rejected(docs: DataFrame, model: Gam, threshold: float) -> DataFrame:
    """The rows of `docs`, whole and unchanged, that score at least `threshold`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.score(text_features(batch.column(at))) >= threshold))

    return docs.mapInArrow(work, docs.schema)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Per document: `doc_id`, `held_out`, `score` (0 to 1, higher: label 1 likelier) and `predicted`.

    Inputs of a score are the features of the whole text only. A null text scores as an empty one. Null and repeated
    keys give a row each; a null key is neither learned from nor held out. Without labels of both kinds all scores are
    the smoothed share of label 1. Columns other than `doc_id` and `text` are not read. An empty table of documents
    gives an empty result.
    """
    model = learn(docs, labels)
    rows = scored(docs.select("doc_id", F.col("text").cast("string").alias("text")), model, "score")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
