"""Repeated passages are cut from all documents but the first, found as runs of consecutive sentences.

Texts are cut into sentences: after a full stop, an exclamation or question mark, at commas, colons and semicolons
(clauses of one sentence count as sentences, so that a passage set into another sentence loses little), at line ends,
and before a capitalised word that follows one that is not. A run is at least `RUN` consecutive sentences of at least
`least_words` words together.

With `longest`, sentences of more words are cut further: of each window of `longest` words inside one, the word of the
smallest hash begins a sentence. The places depend on the words of the window only, and no sentence is longer. A run is
then any number of sentences with enough words, so of a repeated passage of `least_words` + 3 `longest` words, at most the
`longest` first and last words, which lie in sentences that are not whole, stay in a copy. From each sentence the shortest run onwards is hashed, and to each sentence the shortest
run up to it; together these cover every repeated run whole, since a repeated run contains the shortest run from each
of its sentences that has one, and the shortest to its last.

Hashes are joined globally in two steps. Names of 64 bits are counted first, and a bitmap sized by their number, up to a
bound, carries those that occur twice to the tasks. Only their runs, a small part, are then sent with 128 bits, key and
place, and decide. Texts without cuts stay where they are; only the others are sent to their cuts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrow_text import NOT_SPACE, byte_set, counts_of, flat_texts, sequence_hashes, short_batches, slices, span_hashes, word_spans
from tidemark.llm.bitmaps import bitmap_of, hits, hits_sized, sized_bitmap
from tidemark.llm.common import fresh_name, release, stored, with_row_key

RUN = 2
LEAST_WORDS = 20
LONGEST = 10

_MARK = byte_set((0x21, 0x21), (0x2C, 0x2C), (0x2E, 0x2E), (0x3A, 0x3B), (0x3F, 0x3F))
_CAPITAL = byte_set((0x41, 0x5A))


def sentence_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which words begin a sentence."""
    begins = np.zeros(len(starts), dtype=bool)
    if not len(starts):
        return begins
    following = np.append(data[1:], 0)
    first = data[starts]
    capital = _CAPITAL[first] | ((first == 0xC3) & (following[starts] >= 0x80) & (following[starts] <= 0x9E))
    feeds = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(data == 0x0A, out=feeds[1:])
    begins[1:] = _MARK[data[ends[:-1] - 1]] | (feeds[starts[1:]] > feeds[ends[:-1]]) | (capital[1:] & ~capital[:-1])
    begins[bounds[:-1][bounds[:-1] < len(starts)]] = True
    return begins


def cut_long(begins: np.ndarray, words: np.ndarray, longest: int) -> np.ndarray:
    """Sentence starts, with those that sentences of more than `longest` words get by the hashes of their words."""
    at = np.flatnonzero(begins)
    counts = np.diff(np.append(at, len(begins)))
    windows = np.where(counts > longest, counts - longest + 1, 0)
    first = np.arange(windows.sum()) + np.repeat(at - np.cumsum(windows) + windows, windows)
    out = begins.copy()
    for low in range(0, len(first), 1 << 18):
        part = first[low : low + (1 << 18)]
        out[part + words[part[:, None] + np.arange(longest)].argmin(axis=1)] = True
    return out


def shortest_runs(data: np.ndarray, marks: np.ndarray, least: int, longest: int | None = None) -> tuple[np.ndarray, ...]:
    """Text, first word and end word (in the text) of the runs, and two hashes of each."""
    starts, ends, bounds = word_spans(data, marks, NOT_SPACE)
    words = span_hashes(data, starts, ends)
    begins = sentence_starts(data, starts, ends, bounds)
    run = RUN if longest is None else 1
    at = np.flatnonzero(begins if longest is None else cut_long(begins, words, longest))
    owner = np.repeat(np.arange(len(marks) - 1), counts_of(bounds))
    text = owner[at]
    stop_of_text = bounds[1:][text]
    edge = np.append(at, len(starts))
    n = len(at)
    i = np.arange(n)
    # onwards: the first sentence end that has enough sentences and words
    end = np.maximum(np.searchsorted(edge, at + least), np.minimum(i + run, n))
    onward = (end <= n) & (edge[np.minimum(end, n)] <= stop_of_text) & (i + run <= n)
    first, last = at[onward], edge[end[onward]]
    # up to: the last sentence start before the end of sentence i
    close = edge[1:]
    begin = np.minimum(np.searchsorted(at, close - least, side="right") - 1, i + 1 - run)
    upward = (begin >= 0) & (at[np.maximum(begin, 0)] >= bounds[:-1][text])
    b = np.maximum(begin, 0)
    upward &= ~(onward[b] & (edge[np.minimum(end[b], n)] == close))
    first, last = np.concatenate([first, at[b[upward]]]), np.concatenate([last, close[upward]])
    own = owner[first] if len(first) else np.zeros(0, dtype=np.int64)
    names = [sequence_hashes(words, first, last, v).view(np.int64) for v in (0, 1)]
    order = np.argsort(own, kind="stable")
    return own[order], (first - bounds[own])[order], (last - bounds[own])[order], names[0][order], names[1][order]


def later_runs(rows: DataFrame, least: int, longest: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """`rid`, `first` and `last` word of the runs that have an earlier copy, of rows of `rid`, `key`, `text`.

    Also the stored tables that this is worked out from.
    """

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 0):
            data, marks = flat_texts(batch.column(0))
            for first, last in slices(marks):
                found = shortest_runs(data[marks[first] : marks[last]], marks[first : last + 1] - marks[first], least, longest)
                yield pa.RecordBatch.from_arrays([pa.array(found[3])], names=["a"])

    counted = rows.select("text").mapInArrow(names, "a long").groupBy("a").agg(F.count(F.lit(1)).alias("times"))
    twice = stored(counted.filter("times > 1").select("a"), "sentence-names")
    shared = rows.sparkSession.sparkContext.broadcast(sized_bitmap(twice, "a", twice.count()))
    release(twice)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 2):
            data, marks = flat_texts(batch.column(2))
            for low, high in slices(marks):
                found = shortest_runs(data[marks[low] : marks[high]], marks[low : high + 1] - marks[low], least, longest)
                own, first, last, a, b = (x[hits_sized(shared.value, found[3].view(np.uint64))] for x in found)
                part, who = batch.slice(low, high - low), pa.array(own)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(who), part.column(1).take(who), *map(pa.array, (first, last, a, b))],
                    names=["rid", "key", "first", "last", "a", "b"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    kept = stored(rows.mapInArrow(runs, f"rid long, key {kind}, first long, last long, a long, b long"), "sentence-runs")
    place = F.struct("key", "rid", "first")
    heads = kept.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("head")).filter("times > 1")
    heads = stored(heads, "sentence-heads")
    later = kept.join(heads, ["a", "b"]).filter("head.rid != rid or head.first != first")
    return later.select("rid", "first", "last"), [kept, heads]


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(runs):
        if out and low <= out[-1][1]:
            out[-1] = out[-1][0], max(high, out[-1][1])
        else:
            out.append((low, high))
    return out


def dedup_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, longest: int | None = None) -> DataFrame:
    """`docs` with repeated passages cut from `text`, `words_removed`, and the cut byte spans in `spans`.

    A passage is a run of sentences as above; words are compared by their bytes, whatever white space is between. It
    stays where the key is smallest (null before all), then in the first row, then at the first place, and is cut with
    the white space after it everywhere else, also within one text. All rows and columns stay; a copy of a whole text
    becomes empty if it has enough words and, without `longest`, sentences. Null and empty texts stay as they are. Rows of equal key are ordered by file split and place, so
    `docs` should be a stored table. An empty table gives an empty result.
    """
    rid, runs = fresh_name(docs, "rid"), fresh_name(docs, "runs")
    rows = with_row_key(docs, rid)
    narrow = rows.select(F.col(rid).alias("rid"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    later, used = later_runs(narrow, least_words, longest)
    found = stored(later.groupBy("rid").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "sentence-cuts")
    release(*used)
    # only rows with cuts are sent to them; the bits of row numbers let some others go along
    marks = rows.sparkSession.sparkContext.broadcast(bitmap_of(found, "rid"))
    place = len(docs.columns)

    def chosen(wanted: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(hits(marks.value, batch.column(place).to_numpy()) == wanted))

        return rows.mapInArrow(work, rows.schema)

    cuts = found.select(F.col("rid").alias(rid), F.col("runs").alias(runs))
    # the cuts grow with the texts, so the join is the same at every size
    joined = chosen(True).join(cuts.hint("merge"), rid, "left").drop(rid)
    joined = joined.union(chosen(False).drop(rid).withColumn(runs, F.lit(None).cast(cuts.schema[runs].dataType)))
    at, end = docs.columns.index(text), len(docs.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, at):
            column = batch.column(at)
            gone, spans = np.zeros(batch.num_rows, dtype=np.int64), [[] for _ in range(batch.num_rows)]
            marked = np.flatnonzero(batch.column(end).is_valid().to_numpy(zero_copy_only=False))
            if len(marked):
                texts = column.to_pylist()
                for row, own in zip(marked, batch.column(end).take(pa.array(marked)).to_pylist(), strict=True):
                    raw = texts[row].encode("utf-8")
                    data = np.frombuffer(raw, dtype=np.uint8)
                    starts, _, _ = word_spans(data, np.array([0, len(raw)]), NOT_SPACE)
                    edges = np.append(starts, len(raw))
                    left, done = [], 0
                    for low, high in merged([(r["first"], r["last"]) for r in own]):
                        left.append(raw[done : edges[low]])
                        done = int(edges[high])
                        gone[row] += high - low
                        spans[row].append({"start": int(edges[low]), "stop": done})
                    texts[row] = b"".join([*left, raw[done:]]).decode("utf-8")
                column = pa.array(texts, column.type)
            columns = [column if i == at else c for i, c in enumerate(batch.columns[:end])]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone), pa.array(spans, kind)], names=schema.names)

    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    more = [T.StructField(fresh_name(docs, "words_removed"), T.LongType()), T.StructField(fresh_name(docs, "spans"), span)]
    schema = T.StructType([*docs.schema.fields, *more])
    return joined.mapInArrow(work, schema)
