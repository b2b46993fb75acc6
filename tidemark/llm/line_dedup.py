"""Later copies of repeated line runs are deleted; runs are found by prefix doubling over sequences of line ids.

A line is named by 128 bits of its bytes, a text is the sequence of its lines that are not blank, and a suffix is a
place in such a sequence. Round k names the suffixes by their first k lines, so suffixes of one name are an interval of
the suffix array whose common prefix has at least k lines. Doubling joins the name of a suffix with that of the suffix
k lines on; names that only one suffix has end there, so each round works on repeated prefixes only. Names are hashes
of pairs in place of sorted ranks: intervals are all that is asked for, not their order.

A run counts as repeated if it has at least `least_chars` bytes. Of each suffix, the shortest prefix that long decides:
its length depends on its content only, it is covered by two names of the last round that fits, and it is a later copy
unless its place is the first of its interval (by key, then row). With `whole`, the shortest run that ends at a line
decides in the same way: it covers the last lines of a repeated run, from which on fewer bytes of it are left. A repeated
run is made of such prefixes and of the shortest run up to its last line, so their union, merged per text, is the union
of the maximal runs that have an earlier copy. Since a line has at least one byte, `log2(least_chars)` rounds suffice for
runs of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.arrow_text import byte_set, counts_of, flat_texts, short_batches, slices, span_hashes, word_spans
from tidemark.llm.common import fresh_name, stored, with_row_key

LEAST_CHARS = 20

_IN_LINE = ~byte_set((0x0A, 0x0A))
_INK = ~byte_set((0x20, 0x20), (0x09, 0x0D))


def line_spans(data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines with a visible byte, and how many lie before each text."""
    starts, ends, _ = word_spans(data, marks, _IN_LINE)
    ink = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_INK[data], out=ink[1:])
    full = ink[ends] > ink[starts]
    starts, ends = starts[full], ends[full]
    return starts, ends, np.searchsorted(starts, marks)


def shortest_runs(sizes: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Lines from each place on that are needed for `least` bytes; 0 where the text ends before."""
    total = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=total[1:])
    stop = np.searchsorted(total, total[:-1] + least)
    last = np.repeat(bounds[1:], counts_of(bounds))
    return np.where(stop <= last, stop - np.arange(len(sizes)), 0)


def shortest_runs_back(sizes: np.ndarray, bounds: np.ndarray, least: int) -> np.ndarray:
    """Lines up to each place, itself included, that are needed for `least` bytes; 0 where the text begins after."""
    total = np.zeros(len(sizes) + 1, dtype=np.int64)
    np.cumsum(sizes, out=total[1:])
    begin = np.searchsorted(total, total[1:] - least, side="right") - 1
    first = np.repeat(bounds[:-1], counts_of(bounds))
    return np.where(begin >= first, np.arange(1, len(sizes) + 1) - begin, 0)


def sequences(rows: DataFrame, least: int) -> DataFrame:
    """A row per visible line of `rid`, `key`, `text`: place, 128 bits of the line, its shortest run onwards and up to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 2):
            data, marks = flat_texts(batch.column(2))
            for first, last in slices(marks):
                part = data[marks[first] : marks[last]]
                starts, ends, bounds = line_spans(part, marks[first : last + 1] - marks[first])
                own = batch.slice(first, last - first)
                counts = counts_of(bounds)
                owner = pa.array(np.repeat(np.arange(last - first), counts))
                place = np.arange(len(starts)) - np.repeat(bounds[:-1], counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0).take(owner),
                        own.column(1).take(owner),
                        pa.array(place, pa.int64()),
                        pa.array(span_hashes(part, starts, ends, 0).view(np.int64)),
                        pa.array(span_hashes(part, starts, ends, 1).view(np.int64)),
                        pa.array(shortest_runs(ends - starts, bounds, least), pa.int64()),
                        pa.array(shortest_runs_back(ends - starts, bounds, least), pa.int64()),
                    ],
                    names=["rid", "key", "pos", "a", "b", "need", "back"],
                )

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(work, f"rid long, key {kind}, pos long, a long, b long, need long, back long")


def repeated(suffixes: DataFrame) -> DataFrame:
    """The suffixes whose name another one has as well."""
    twice = stored(suffixes.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("a", "b"), "line-names")
    return stored(suffixes.join(twice, ["a", "b"]), "line-suffixes")


def later_copies(lines: DataFrame, least: int, whole: bool = False) -> DataFrame:
    """`rid`, `start` and `lines` of the merged runs that have an earlier copy; `whole` as in `dedup_lines`."""
    level, k, windows = repeated(lines if whole else lines.drop("back")), 1, None
    while True:
        ahead = lambda n: W.partitionBy("rid").orderBy("pos").rangeBetween(n, n)  # noqa: B023, E731
        # runs of k to 2 k - 1 lines: a name at their start and one that ends where they end
        parts = [level.filter(F.col("need") == k).withColumns({"c": F.col("a"), "d": F.col("b")})] if k == 1 else []
        for need in range(max(k, 2), min(2 * k - 1, least) + 1):
            tail = {"c": F.first("a").over(ahead(need - k)), "d": F.first("b").over(ahead(need - k))}
            onward = (F.col("need") == need) & F.col("c").isNotNull()
            if not whole:
                parts.append(level.withColumns(tail).filter(onward))
                continue
            # `back` is that of the last line of a name; runs that are the shortest onwards as well are there already
            head = {x: F.first(y).over(ahead(k - need)) for x, y in (("e", "a"), ("f", "b"), ("other", "need"))}
            ending = (F.col("back") == need) & F.col("e").isNotNull() & (F.col("other") != need)
            run = lambda pos, *names: F.struct(pos.alias("pos"), *(F.col(x).alias(y) for x, y in zip(names, "abcd", strict=True)))
            both = F.array(F.when(onward, run(F.col("pos"), *"abcd")), F.when(ending, run(F.col("pos") - (need - k), *"efab")))
            # one pass for both
            seen = level.withColumns(tail | head).filter(onward | ending).select("rid", "key", F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x"))
            parts.append(seen.select("rid", "key", F.lit(need).cast("long").alias("need"), "x.*"))
        for part in parts:
            part = part.select("rid", "key", "pos", "need", "a", "b", "c", "d")
            windows = part if windows is None else windows.union(part)
        if 2 * k > least:
            break
        pair = level.withColumns({"c": F.first("a").over(ahead(k)), "d": F.first("b").over(ahead(k))}).filter("c is not null")
        if whole:
            pair = level.withColumns({x: F.first(y).over(ahead(k)) for x, y in (("c", "a"), ("d", "b"), ("back", "back"))}).filter("c is not null")
        names = {"a": F.xxhash64(F.lit(1), "a", "b", "c", "d"), "b": F.xxhash64(F.lit(2), "d", "c", "b", "a")}
        level, k = repeated(pair.withColumns(names).drop("c", "d")), 2 * k
    windows = stored(windows, "line-windows")
    name = ["need", "a", "b", "c", "d"]
    place = F.struct("key", "rid", "pos")
    first = stored(windows.groupBy(*name).agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("head")).filter("times > 1"), "line-heads")
    later = windows.join(first, name).filter((F.col("head.rid") != F.col("rid")) | (F.col("head.pos") != F.col("pos")))
    # islands: a window that begins after all former ones of the text have ended opens a run
    order = W.partitionBy("rid").orderBy("pos")
    reach = F.max(F.col("pos") + F.col("need")).over(order.rowsBetween(W.unboundedPreceding, -1))
    opened = later.select("rid", "pos", "need", (reach.isNull() | (reach < F.col("pos"))).cast("int").alias("opens"))
    island = opened.withColumn("run", F.sum("opens").over(order))
    runs = island.groupBy("rid", "run").agg(F.min("pos").alias("start"), F.max(F.col("pos") + F.col("need")).alias("stop"))
    return runs.select("rid", "start", (F.col("stop") - F.col("start")).alias("lines"))


def cut_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, int]:
    """The text without the visible lines of the runs, and how many visible lines are left."""
    gone = {at for start, n in runs for at in range(start, start + n)}
    kept, at, left = [], 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\r\x0b\x0c"):
            if at not in gone:
                kept.append(line)
                left += 1
            at += 1
        else:
            kept.append(line)
    return "\n".join(kept), left


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, counts: bool = True, whole: bool = False) -> DataFrame:
    """`docs` with later copies of repeated line runs deleted from `text`; with `counts`, also `lines_removed`, `lines_left`.

    Lines end at line feeds; blank lines stay, and runs go on across them. A run of at least `least_chars` bytes that
    occurs at several places, overlapping ones and places within one text included, stays at the first only: the
    smallest key (null before all), then the first row. Without `whole`, the last lines of a run, from which on it has
    fewer bytes than that, stay in all copies. All rows and columns stay; a text that loses all its visible
    lines has none left. Null and empty texts stay as they are. Rows of equal key, or equal altogether, are ordered by
    file split and place, so `docs` should be a stored table. An empty table gives an empty result.
    """
    rid, runs = fresh_name(docs, "rid"), fresh_name(docs, "runs")
    rows = with_row_key(docs, rid)
    narrow = rows.select(F.col(rid).alias("rid"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = later_copies(stored(sequences(narrow, least_chars), "line-sequences"), least_chars, whole)
    spans = stored(found.groupBy("rid").agg(F.collect_list(F.struct("start", "lines")).alias("spans")), "line-runs")
    # the spans grow with the texts, so the join is the same at every size
    joined = rows.join(spans.select(F.col("rid").alias(rid), F.col("spans").alias(runs)).hint("merge"), rid, "left").drop(rid)
    at, last = docs.columns.index(text), len(docs.columns)
    removed, left = fresh_name(docs, "lines_removed"), fresh_name(docs, "lines_left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, at):
            column = batch.column(at)
            data, marks = flat_texts(column)
            _, _, bounds = line_spans(data, marks)
            lines = counts_of(bounds)
            gone = np.zeros(len(lines), dtype=np.int64)
            marked = np.flatnonzero(batch.column(last).is_valid().to_numpy(zero_copy_only=False))
            if len(marked):
                texts = column.to_pylist()
                for row, own in zip(marked, batch.column(last).take(pa.array(marked)).to_pylist(), strict=True):
                    texts[row], n = cut_lines(texts[row], [(s["start"], s["lines"]) for s in own])
                    gone[row] = lines[row] - n
                column = pa.array(texts, column.type)
            columns = [column if i == at else c for i, c in enumerate(batch.columns[:last])]
            names = batch.schema.names[:last]
            if counts:
                columns += [pa.array(gone), pa.array(lines - gone)]
                names = [*names, removed, left]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    more = [T.StructField(removed, T.LongType()), T.StructField(left, T.LongType())] if counts else []
    return joined.mapInArrow(work, T.StructType([*docs.schema.fields, *more]))
