"""Benchmark passages in documents, found by the q-gram lemma and verified by banded alignment.

Texts are brought to lower-case letters (of any script) and digits with single spaces between. Benchmark items are cut
into segments of 96 characters, one beginning every 18: a verbatim fragment of that length lacks at most 9 characters of
some segment, which is its edit budget, so all such fragments are found, wherever they begin. Items of 16 to 31 characters
are found as they are, between word borders, since a part of the edits would make other phrases of them. A segment of m characters that occurs with at most e edits shares at least m - q + 1 - q e of its
q-grams with the document, and all of them lie on diagonals (place in the document less place in the segment) that
differ by at most e. Diagonals are therefore dealt to bands of 2 (e + 1), one beginning every e + 1, so that any such
range lies whole in one band. Bands with enough shared q-grams are kept, and an alignment restricted to the band and e
diagonals on either side decides.

Documents are not moved: the segments' q-grams are broadcast in blocks of bounded size, one pass over the documents per
block, and all counting is done on the arrays of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import ALPHANUMERIC, flat_texts, short_batches, slices

Q = 8
#: Items shorter than this, brought to letters and digits, are ordinary phrases that clean documents hold as well.
LEAST_CHARS = 16
#: Items shorter than this must occur without an edit, from one word border to another.
EXACT_BELOW = 32
SEGMENT = 96
#: At most twice the edits of a segment, so that no fragment of `SEGMENT` characters falls between two segments.
STEP = 18
#: Edits per character that a segment may take.
BUDGET = 0.1
#: Characters of items in one broadcast block.
BLOCK_CHARS = 1 << 21
_TABLE_BITS = 22
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_COST = 1 << 12


def plain_text(data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters and digits of lower-case texts with one space for each run of anything else; new marks, and old places."""
    out = data.copy()
    keep = ALPHANUMERIC[out]
    out[~keep] = 0x20
    keep[1:] |= keep[:-1]
    if len(keep):
        keep[0] = True
    places = np.flatnonzero(keep)
    return out[places], np.searchsorted(places, marks), places


def lower_texts(column: pa.Array) -> pa.Array:
    """The texts in lower case, letter by letter in any script, or A-Z only beside bytes that are not UTF-8; null stays null."""
    try:
        return pc.utf8_lower(column)
    except pa.ArrowInvalid:
        return pc.ascii_lower(column)


def former_places(low: np.ndarray, raw: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Places in `raw` of places in `low`, its lower case: some letters take fewer or more bytes there."""
    heads, former = (np.flatnonzero((x & 0xC0) != 0x80) for x in (low, raw))
    if np.array_equal(heads, former):
        return places
    letter = np.searchsorted(heads, places, side="right") - 1
    ends = np.append(former[1:], len(raw))
    # the last byte of a letter stays the last
    last = places + 1 == np.append(heads[1:], len(low))[letter]
    return np.where(last, ends[letter] - 1, np.minimum(former[letter] + places - heads[letter], ends[letter] - 1))


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at each place as one number."""
    if len(data) < Q:
        return np.zeros(0, dtype=np.uint64)
    windows = np.lib.stride_tricks.sliding_window_view(data, Q)
    return np.ascontiguousarray(windows).view(np.uint64).ravel()


@dataclass
class Segments:
    """Segments of benchmark items, as places in the items' texts, and an index of the items' q-grams."""

    items: list
    texts: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    size: np.ndarray
    edits: np.ndarray
    needed: np.ndarray
    least: np.ndarray
    order: np.ndarray
    codes: np.ndarray
    first: np.ndarray
    holder: np.ndarray
    offset: np.ndarray
    table: np.ndarray


def plain_items(rows: list[tuple[object, str | None]]) -> list[tuple[object, np.ndarray]]:
    """Items with their plain texts; those that are too short, empty or null are left out."""
    out = []
    for item, text in rows:
        raw, marks = flat_texts(lower_texts(pa.array([text or ""], pa.string())))
        data, _, _ = plain_text(raw, marks)
        text = data.tobytes().strip()
        if len(text) >= LEAST_CHARS:
            out.append((item, np.frombuffer(text, dtype=np.uint8)))
    return out


def edit_budget(lengths: np.ndarray) -> np.ndarray:
    """Most edits of segments of these lengths."""
    return np.where(lengths < EXACT_BELOW, 0, (lengths * BUDGET).astype(np.int64))


def index_items(held: list[tuple[object, np.ndarray]]) -> Segments:
    """Each q-gram of an item is indexed once, however many of its segments overlap there."""
    lengths = np.array([len(t) for _, t in held])
    starts = [np.array([0]) if n <= SEGMENT else np.append(np.arange(0, n - SEGMENT, STEP), n - SEGMENT) for n in lengths]
    owner = np.repeat(np.arange(len(held)), [len(s) for s in starts])
    start = np.concatenate(starts)
    size = np.minimum(lengths, SEGMENT)[owner]
    edits = edit_budget(size)
    needed = np.maximum(size - Q + 1 - Q * edits, 1)
    codes = [grams(t) for _, t in held]
    flat = np.concatenate(codes)
    order = np.argsort(flat, kind="stable")
    distinct, first = np.unique(flat[order], return_index=True)
    table = np.zeros(1 << _TABLE_BITS, dtype=bool)
    table[(distinct * _FACTOR) >> np.uint64(64 - _TABLE_BITS)] = True
    begin = np.append(0, np.cumsum(lengths))
    holder = np.repeat(np.arange(len(held)), [len(c) for c in codes])[order]
    offset = np.concatenate([np.arange(len(c)) for c in codes])[order]
    # segments as places in all texts one after the other, which are in order
    place = begin[owner] + start
    least = needed[np.searchsorted(owner, np.arange(len(held)))]
    texts = np.concatenate([t for _, t in held])
    return Segments(
        [i for i, _ in held], texts, owner, start, size, edits, needed, least, place, distinct, np.append(first, len(flat)), holder, offset, table
    )


def often_enough(pair: np.ndarray, cells: int, least: np.ndarray) -> np.ndarray:
    """Which rows have a value that occurs at least `least` times; values are below `cells`."""
    if cells <= 8 * len(pair):
        return np.bincount(pair, minlength=cells)[pair] >= least
    _, back, sums = np.unique(pair, return_inverse=True, return_counts=True)
    return sums[back] >= least


def candidate_bands(data: np.ndarray, marks: np.ndarray, index: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, segment and least diagonal of the bands with enough shared q-grams."""
    codes = grams(data)
    hits = np.flatnonzero(index.table[(codes * _FACTOR) >> np.uint64(64 - _TABLE_BITS)])
    at = np.minimum(np.searchsorted(index.codes, codes[hits]), len(index.codes) - 1)
    same = index.codes[at] == codes[hits]
    hits, at = hits[same], at[same]
    text = np.searchsorted(marks, hits, side="right") - 1
    inside = hits + Q <= marks[text + 1]
    hits, at, text = hits[inside], at[inside], text[inside]
    counts = index.first[at + 1] - index.first[at]
    entry = np.repeat(index.first[at] - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
    item, offset = index.holder[entry], index.offset[entry]
    place, text = np.repeat(hits - marks[text], counts), np.repeat(text, counts)
    # enough hits of a text and item in all are necessary, and cheap to ask for first; then those of a text and segment
    kept = often_enough(text * len(index.items) + item, (len(marks) - 1) * len(index.items), index.least[item])
    item, offset, place, text = item[kept], offset[kept], place[kept], text[kept]
    if not len(item):
        return (np.zeros(0, dtype=np.int64),) * 3
    # segments of an item have one size, so its bands serve them all. A hit lies in the band that begins in its step and in
    # the one before; hits of an occurrence are in the band of the first of them, so bands that begin with none are let be
    head = np.searchsorted(index.owner, item)
    step = index.edits[head] + 1
    cell = np.floor_divide(place - offset, step)
    lowest, width = cell.min() - 1, cell.max() - cell.min() + 3
    key = (text * len(index.items) + item) * width + cell - lowest
    key, hit = np.concatenate([key, key - 1]), np.tile(np.arange(len(item)), 2)
    opens = np.arange(len(key)) < len(item)
    # sums of many bands in one bucket never fall below those of a band
    bucket = (key.astype(np.uint64) * _FACTOR) >> np.uint64(64 - _TABLE_BITS)
    kept = np.bincount(bucket.astype(np.int64), minlength=1 << _TABLE_BITS)[bucket] >= index.least[item[hit]]
    key, hit, opens = key[kept], hit[kept], opens[kept]
    keys, group, sums = np.unique(key, return_inverse=True, return_counts=True)
    if not len(keys):
        return (np.zeros(0, dtype=np.int64),) * 3
    kept = (np.bincount(group, opens) > 0) & (sums >= index.least[keys // width % len(index.items)])
    chosen = kept[group]
    group, hit, opens = group[chosen], hit[chosen], opens[chosen]
    # the segments that hold the q-gram of a hit
    at_most = index.order[head[hit]] + offset[hit]
    low = np.maximum(np.searchsorted(index.order, at_most - (index.size[head[hit]] - Q)), head[hit])
    counts = np.searchsorted(index.order, at_most, side="right") - low
    segment = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    pairs, back, sums = np.unique(np.repeat(group, counts) * len(index.owner) + segment, return_inverse=True, return_counts=True)
    segment, key = pairs % len(index.owner), keys[pairs // len(index.owner)]
    kept = (np.bincount(back, np.repeat(opens, counts), len(pairs)) > 0) & (sums >= index.needed[segment])
    segment, key = segment[kept], key[kept]
    low = (key % width + lowest) * (index.edits[segment] + 1) + index.start[segment]
    return key // width // len(index.items), segment, low


def align(data: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray, patterns: np.ndarray, edits: int):
    """Least edits, start and end of each pattern in its text within 2 (e + 1) diagonals from `low` and e around.

    All patterns have one length. Costs carry the diagonal they began on in their low bits, so that the start of the
    best alignment comes with its cost.
    """
    low = low - edits
    width = 4 * edits + 2
    k = np.arange(width)
    cost = np.tile(k, (len(low), 1)).astype(np.int64)
    far = np.int64(1) << 40
    ahead = k * _COST
    for i in range(patterns.shape[1]):
        j = begin[:, None] + (low + i)[:, None] + k
        valid = (j >= begin[:, None]) & (j < end[:, None])
        letter = np.where(valid, data[np.clip(j, 0, len(data) - 1)], 0)
        nxt = cost + np.where(letter == patterns[:, i : i + 1], 0, _COST)
        # outside the text only skipped letters of the pattern go on
        nxt[~valid] = far
        nxt[:, :-1] = np.minimum(nxt[:, :-1], cost[:, 1:] + _COST)
        cost = np.minimum.accumulate(nxt - ahead, axis=1) + ahead
    best = np.argmin(cost, axis=1)
    value = cost[np.arange(len(low)), best]
    start = np.maximum(low + (value & (_COST - 1)), 0)
    stop = np.minimum(low + patterns.shape[1] + best, end - begin)
    return value >> 12, start, stop


def find_items(column: pa.Array, index: Segments) -> list[tuple[int, int, int, int, int]]:
    """Row, segment, edits and byte span in the original text of every verified occurrence."""
    column = column.cast(pa.large_string())
    data, marks = flat_texts(column)
    low_data, low_marks = flat_texts(lower_texts(column))
    found = []
    for first, last in slices(marks):
        low = low_data[low_marks[first] : low_marks[last]]
        part, cut, places = plain_text(low, low_marks[first : last + 1] - low_marks[first])
        text, segment, least = candidate_bands(part, cut, index)
        if not len(text):
            continue
        places = former_places(low, data[marks[first] : marks[last]], places)
        sizes = index.size[segment]
        for m in np.unique(sizes):
            chosen = np.flatnonzero(sizes == m)
            patterns = index.texts[index.order[segment[chosen]][:, None] + np.arange(m)]
            own, most = text[chosen], int(edit_budget(m))
            cost, start, stop = align(part, cut[own], cut[own + 1], least[chosen], patterns, most)
            good = (cost <= most) & (stop > start)
            if m < EXACT_BELOW:
                good &= at_borders(part, cut[own] + start, cut[own] + stop, cut[own], cut[own + 1])
            for n in np.flatnonzero(good):
                t = int(own[n])
                base = int(marks[first + t] - marks[first])
                s, e = int(places[cut[t] + start[n]]) - base, int(places[cut[t] + stop[n] - 1]) + 1 - base
                found.append((first + t, int(segment[chosen[n]]), int(cost[n]), s, e))
    return found


def at_borders(data: np.ndarray, start: np.ndarray, stop: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the spans begin and end where words of their texts do."""
    before = (start == begin) | (data[np.maximum(start - 1, 0)] == 0x20)
    after = (stop == end) | (data[np.minimum(stop, len(data) - 1)] == 0x20)
    return before & after


def blocks_of(benchmark: DataFrame) -> Iterator[Segments]:
    """Indexes of the benchmark's items in blocks of bounded size, read one after the other."""
    block: list[tuple[object, np.ndarray]] = []
    size = 0
    for row in benchmark.select("item_id", F.col("text").cast("string")).toLocalIterator():
        held = plain_items([(row[0], row[1])])
        block += held
        size += sum(len(text) for _, text in held)
        if size >= BLOCK_CHARS:
            yield index_items(block)
            block, size = [], 0
    if block:
        yield index_items(block)


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs` and benchmark item that occurs in it.

    Columns: the key as `doc_id`, `item_id`, `segments` (verified segments of the item), `edits` (of the best one),
    `start_byte` and `end_byte` (least start and largest end in the UTF-8 text). Whole texts of any length are searched;
    null and empty texts hold nothing. Capitals of any script equal their small letters. Of an item of `SEGMENT` characters
    (UTF-8 bytes of letters, digits and single spaces) or more, every verbatim fragment of that length is found; shorter
    items are found whole, with edits up to `BUDGET`, those below `EXACT_BELOW` without any and between word borders only,
    and those below `LEAST_CHARS` are not searched.
    Repeated items each count. Null or repeated keys give their own rows. An empty table on either side gives no rows.
    Other columns are not read.
    """
    spark = docs.sparkSession
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, segments long, edits long, start_byte long, end_byte long"
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    result = spark.createDataFrame([], schema)
    for index in blocks_of(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in short_batches(batches, 1):
                groups: dict[tuple[int, int], list] = {}
                items = shared.value.items
                place: dict = {}
                for row, segment, cost, start, end in find_items(batch.column(1), shared.value):
                    item = int(shared.value.owner[segment])
                    n = place.setdefault(items[item], item)
                    groups.setdefault((row, n), []).append((segment, cost, start, end))
                rows = [
                    (r, items[n], len({g[0] for g in v}), min(g[1] for g in v), min(g[2] for g in v), max(g[3] for g in v))
                    for (r, n), v in sorted(groups.items())
                ]
                if rows:
                    taken, *others = zip(*rows)
                    columns = [batch.column(0).take(pa.array(taken)), pa.array(others[0]), *(pa.array(c, pa.int64()) for c in others[1:])]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "segments", "edits", "start_byte", "end_byte"])

        result = result.union(narrow.mapInArrow(work, schema))
    return result


def without_items(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs`, whole and unchanged, in which no benchmark item occurs."""
    at = docs.columns.index(text)
    for index in blocks_of(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in short_batches(batches, at):
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[f[0] for f in find_items(batch.column(at), shared.value)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(work, docs.schema)
    return docs
