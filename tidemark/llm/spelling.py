"""Spelling variants: words one edit apart, found by dynamic programming along sorted lists.

`run_counts` cuts texts into runs of letters, misspells one in `every` by a fixed rule of key and run (so that there is
something to find and to test against), and counts the words left.

`near_words` finds for each word the words at exactly one edit. Two such words agree before the edit and behind it, so
they share the front half of the shorter one's length or the rear rest of it: words are dealt to lists by those
halves. A list of more than `most` words is dealt again by the halves of what its words do not share, and so on until
lists are short or one character is left open, so no task holds a hot half. A pair that shares several halves counts
in the first only.

In a list, sorted by what its words do not share, all words are searched at once. The search goes down the list's
prefixes: a state is a word, a range of the list with one common prefix, and the three cells of the edit matrix's row
around the diagonal. The longest common prefixes of neighbouring rows tell where a range parts into longer prefixes;
each row is computed once for a whole range, and a range whose cells all exceed one edit is skipped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import byte_set, cut_out, flat_texts, lower_ascii, short_batches, slices
from tidemark.llm.common import stored

#: Words of a list that is searched as it is.
LIST_WORDS = 4096
#: Rows of lists that are searched together, and states that are held at a time.
SLAB_ROWS = 1 << 16
STATES = 1 << 20
#: Runs up to this many bytes are hashed side by side.
SHORT_RUN = 64

_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC3))


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def letter_runs(data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of A-Z, a-z and U+00C0 to U+00FF in texts given as UTF-8."""
    inside = _LETTER[data]
    inside[1:] |= data[:-1] == 0xC3
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[:-1] = inside
    edge[1:] ^= inside
    after = np.append(inside, False)
    # a run that reaches the end of a text ends there
    cuts = marks[(marks > 0) & (marks < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    return np.union1d(np.flatnonzero(edge & after), cuts), np.union1d(np.flatnonzero(edge & ~after), cuts)


def run_checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, carried on from the crc32 `first` of what stands before it."""
    sizes = ends - starts
    out = np.empty(len(starts), dtype=np.uint32)
    for i in np.flatnonzero(sizes > SHORT_RUN):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(first[i]))
    short = np.flatnonzero(sizes <= SHORT_RUN)
    short = short[np.argsort(-sizes[short].astype(np.int16), kind="stable")]
    at, state = starts[short], ~first[short].astype(np.uint32)
    longer = np.searchsorted(-sizes[short], -np.arange(SHORT_RUN), side="left")
    for j in range(SHORT_RUN):
        n = longer[j]
        if not n:
            break
        state[:n] = _CRC[(state[:n] ^ data[at[:n] + j]) & 0xFF] ^ state[:n] >> 8
    out[short] = ~state
    return out


def count_batch(keys: list[str], column: pa.Array, every: int, least: int) -> pa.Array:
    """The words of one batch with at least `least` code points, as values and counts."""
    data, marks = flat_texts(column)
    found = []
    for a, b in slices(marks):
        part = lower_ascii(data[marks[a] : marks[b]])
        own = marks[a : b + 1] - marks[a]
        starts, ends = letter_runs(part, own)
        wide = np.concatenate(([0], np.cumsum(part == 0xC3)))
        long = ends - starts - (wide[ends] - wide[starts]) >= least
        starts, ends = starts[long], ends[long]
        if not len(starts):
            continue
        first = np.array([zlib.crc32(f"{k}:".encode()) for k in keys[a:b]], dtype=np.uint32)
        sums = run_checksums(part, starts, ends, first[np.searchsorted(own, starts, side="right") - 1])
        hit = sums % every == 0
        found.append(cut_out(part, starts[~hit], ends[~hit]))
        changed = []
        for s, e, h in zip(starts[hit].tolist(), ends[hit].tolist(), sums[hit].tolist()):
            run = part[s:e].tobytes().decode("utf-8")
            at = h % len(run)
            if len(run) > least:
                changed.append(run[:at] + run[at + 1 :])
        found.append(pa.array(changed, pa.large_string()))
    return pc.value_counts(pa.chunked_array(found, pa.large_string()))


def run_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 31, least: int = 7) -> DataFrame:
    """`word` and `n`, the times it occurs: runs of letters of all texts, A-Z in lower case, of `least` code points or more.

    Where `every` divides the crc32 of `<key>:<run>`, the run loses its code point at that crc32 modulo its length. A
    null text has no runs, and a null key stands for an empty one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 1):
            counted = count_batch(batch.column(0).to_pylist(), batch.column(1), every, least)
            yield pa.RecordBatch.from_arrays([counted.field("values").cast(pa.string()), counted.field("counts")], names=["word", "n"])

    narrow = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text).cast("string"))
    return narrow.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _lists(words: DataFrame) -> DataFrame:
    """Each word's lists: once as the shorter and once as the longer word of a pair, by its front and its rear half.

    `shared` is what all words of a list have, its first `front` code points before and the others behind `rest`; `open`
    is the length of `rest` in the pair's shorter word. In a `late` list, words that also share the front half of
    `open` are no pair, since they meet elsewhere.
    """
    size = F.char_length("word")
    by_size = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("s")).filter("s > 0")
    half = F.floor(F.col("s") / 2).cast("int")
    rear = F.col("s") - half
    front_list = F.struct(
        F.lit(False).alias("late"),
        half.alias("front"),
        rear.cast("int").alias("open"),
        F.expr("substring(word, 1, s div 2)").alias("shared"),
        F.expr("substring(word, s div 2 + 1)").alias("rest"),
    )
    rear_list = F.struct(
        F.lit(True).alias("late"),
        F.lit(0).alias("front"),
        half.alias("open"),
        F.expr("substring(word, char_length(word) - (s - s div 2) + 1)").alias("shared"),
        F.expr("substring(word, 1, char_length(word) - (s - s div 2))").alias("rest"),
    )
    return by_size.select("n", F.explode(F.array(front_list, rear_list)).alias("l")).select("l.*", "n")


def _halves(lists: DataFrame) -> DataFrame:
    """The same words in lists by the halves of what is open."""
    front = F.struct(
        F.col("late"),
        F.expr("cast(front + open div 2 as int)").alias("front"),
        F.expr("cast(open - open div 2 as int)").alias("open"),
        F.expr("concat(substring(shared, 1, front), substring(rest, 1, open div 2), substring(shared, front + 1))").alias("shared"),
        F.expr("substring(rest, open div 2 + 1)").alias("rest"),
    )
    kept = "char_length(rest) - (open - open div 2)"
    rear = F.struct(
        F.lit(True).alias("late"),
        F.col("front"),
        F.expr("cast(open div 2 as int)").alias("open"),
        F.expr(f"concat(substring(shared, 1, front), substring(rest, {kept} + 1), substring(shared, front + 1))").alias("shared"),
        F.expr(f"substring(rest, 1, {kept})").alias("rest"),
    )
    return lists.select("n", F.explode(F.array(front, rear)).alias("l")).select("l.*", "n")


_LIST = ["late", "front", "open", "shared"]


def search_lists(of: np.ndarray, texts: list[str], opens: np.ndarray, late: np.ndarray, states: int = STATES) -> tuple[np.ndarray, np.ndarray]:
    """All ordered pairs of rows of the same list whose texts are exactly one edit apart, as two arrays of rows.

    Rows are sorted by list and text, and texts of a list differ. At least one text of a pair has the length in `opens`;
    in a `late` list, the two differ within their first `opens` code points.
    """
    n = len(texts)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, n)
    begin = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    flat = np.concatenate((flat, np.zeros(1, dtype=np.uint32)))
    lcp = _neighbour_prefixes(of, flat, begin, sizes)
    heads = np.flatnonzero(lcp < 0)
    tails = np.append(heads[1:], n)
    first = np.repeat(heads, tails - heads)
    last = np.repeat(tails, tails - heads)
    alone = last - first == 1
    parting = np.argsort(lcp, kind="stable")
    parting_depth = lcp[parting]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    queries = np.flatnonzero(~alone)
    per = max(1, states // 64)
    for a in range(0, len(queries), per):
        q = queries[a : a + per]
        found += _descend(q, first[q], last[q], flat, begin, sizes, lcp, parting, parting_depth, opens, late)
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _neighbour_prefixes(of, flat, begin, sizes) -> np.ndarray:
    """Length of the common prefix of each row and the one before, -1 where a list begins."""
    n = len(of)
    lcp = np.full(n, -1, dtype=np.int64)
    rows = np.flatnonzero(of[1:] == of[:-1]) + 1 if n else np.zeros(0, dtype=np.int64)
    depth = 0
    while len(rows):
        lcp[rows] = depth
        same = (sizes[rows] > depth) & (sizes[rows - 1] > depth)
        rows = rows[same]
        rows = rows[flat[begin[rows] + depth] == flat[begin[rows - 1] + depth]]
        depth += 1
    return lcp


def _descend(q, a, b, flat, begin, sizes, lcp, parting, parting_depth, opens, late) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, row) of the rows below each query's range, prefix by prefix."""
    far = np.int8(2)
    # cells of the row at depth 0: distances to query prefixes of length -1, 0 and 1
    low, mid, high = np.full(len(q), far), np.zeros(len(q), np.int8), np.where(sizes[q] >= 1, np.int8(1), far).astype(np.int8)
    match = np.zeros(len(q), dtype=np.int64)
    depth, found = 0, []
    while len(q):
        size = sizes[q]
        ending = sizes[a] == depth
        off = size - depth
        cell = np.where(off == -1, low, np.where(off == 0, mid, np.where(off == 1, high, far)))
        hit = ending & (cell == 1)
        hit[hit] &= np.minimum(size[hit], depth) == opens[q[hit]]
        hit[hit] &= ~late[q[hit]] | (match[hit] < opens[q[hit]])
        if hit.any():
            found.append((q[hit], a[hit]))
        # the longer prefixes of each range begin where neighbours have exactly this depth in common, and at its start
        lo, hi = np.searchsorted(parting_depth, depth, side="left"), np.searchsorted(parting_depth, depth, side="right")
        cuts = parting[lo:hi]
        x, y = np.searchsorted(cuts, a, side="right"), np.searchsorted(cuts, b, side="left")
        own = (~ending).astype(np.int64)
        children = y - x + own
        up = np.repeat(np.arange(len(q)), children)
        if not len(up):
            break
        ends = np.cumsum(children)
        inside = np.arange(len(up)) - np.repeat(ends - children, children)
        from_cuts = inside - own[up]
        padded = np.append(cuts, 0)
        start = np.where(from_cuts < 0, a[up], padded[np.minimum(x[up] + np.maximum(from_cuts, 0), len(cuts))])
        stop = b[up].copy()
        more = np.flatnonzero(inside + 1 < children[up])
        stop[more] = start[more + 1]
        q, size = q[up], size[up]
        letter = flat[begin[start] + depth]
        base = begin[q]
        # letters of the query at depth - 1, depth and depth + 1
        differs = [((flat[base + np.clip(depth + k, 0, np.maximum(size - 1, 0))] != letter) | (depth + k >= size) | (depth + k < 0)).astype(np.int8) for k in (-1, 0, 1)]
        old_low, old_mid, old_high, match = low[up], mid[up], high[up], match[up]
        low = np.minimum(old_low + differs[0], old_mid + 1)
        mid = np.minimum(np.minimum(old_mid + differs[1], old_high + 1), low + 1)
        high = np.minimum(old_high + differs[2], mid + 1)
        # cells beyond the query do not exist
        low = np.minimum(np.where(depth <= size, low, far), far).astype(np.int8)
        mid = np.minimum(np.where(depth + 1 <= size, mid, far), far).astype(np.int8)
        high = np.minimum(np.where(depth + 2 <= size, high, far), far).astype(np.int8)
        match = match + ((match == depth) & (differs[1] == 0))
        depth += 1
        near = np.minimum(np.minimum(low, mid), high) < far
        q, a, b, low, mid, high, match = q[near], start[near], stop[near], low[near], mid[near], high[near], match[near]
    return found


def _search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each row within its list, for batches sorted by list and rest; lists may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(h) for h in held) < SLAB_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        of = _list_numbers(table)
        whole = int(np.searchsorted(of, of[-1]))
        if whole:
            yield from _near_rows(table.slice(0, whole), of[:whole])
        held = table.slice(whole).to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from _near_rows(table, _list_numbers(table))


def _list_numbers(table: pa.Table) -> np.ndarray:
    """A number for each row, one higher at each new list."""
    fresh = np.zeros(len(table), dtype=bool)
    for name in _LIST:
        column = table[name]
        if len(table) > 1:
            fresh[1:] |= pc.not_equal(column.slice(1), column.slice(0, len(table) - 1)).to_numpy(zero_copy_only=False)
    return np.cumsum(fresh)


def _near_rows(table: pa.Table, of: np.ndarray) -> Iterator[pa.RecordBatch]:
    sizes = np.bincount(of) if len(of) else np.zeros(0, dtype=np.int64)
    shared_list = sizes[of] > 1
    table, of = table.filter(pa.array(shared_list)), of[shared_list]
    if not len(table):
        return
    rest = table["rest"].to_pylist()
    query, row = search_lists(of, rest, table["open"].to_numpy(), table["late"].to_numpy(zero_copy_only=False))
    if not len(query):
        return
    n = table["n"].to_numpy()
    order = np.lexsort((-n[row], query))
    query, row = query[order], row[order]
    first = np.ones(len(query), dtype=bool)
    first[1:] = query[1:] != query[:-1]
    heads = np.flatnonzero(first)
    best = n[row[heads]]
    group = np.cumsum(first) - 1
    # every row that ties for the best goes on, the number of near words with the first of them
    tied = np.flatnonzero(n[row] == best[group])
    near = np.where(first, np.bincount(group)[group], 0)[tied]
    shared, front = table["shared"].to_pylist(), table["front"].to_pylist()
    word = lambda i: shared[i][: front[i]] + rest[i] + shared[i][front[i] :]
    yield pa.RecordBatch.from_arrays(
        [pa.array([word(i) for i in query[tied].tolist()]), pa.array(near, pa.int64()), pa.array(n[row[tied]], pa.int64()), pa.array([word(i) for i in row[tied].tolist()])],
        names=["word", "near", "best_n", "best"],
    )


def near_words(words: DataFrame, most: int = LIST_WORDS) -> DataFrame:
    """For each word of `words` (`word`, `n`; distinct, not null, not empty) with near words: their number `n_near`, and
    `best` and `best_n`, the near word of largest `n` (of equal ones, the first in code-point order)."""
    lists, found = _lists(words), None
    while True:
        lists = stored(lists, "spelling-lists")
        large = lists.filter("open > 1").groupBy(*_LIST).count().filter(F.col("count") > most).drop("count")
        large = stored(large, "spelling-large")
        over = large.isEmpty()
        short = lists if over else lists.join(large, _LIST, "left_anti")
        dealt = short.select(*_LIST, "rest", "n").repartition(*_LIST).sortWithinPartitions(*_LIST, "rest")
        part = dealt.mapInArrow(_search_batches, "word string, near long, best_n long, best string")
        found = part if found is None else found.unionByName(part)
        if over:
            break
        lists = _halves(lists.join(large, _LIST, "left_semi"))
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", F.col("b.word").alias("best"), (-F.col("b.n")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """`word` and `root`, the end of its chain of forms, for `forms` (`word`, `form`); chains have no circles.

    Each round doubles the way that all words have gone, so a chain of k forms takes log2(k) rounds.
    """
    hops = stored(forms.select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        onward = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hops = stored(hops.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-hops")
        if hops.filter("moved").isEmpty():
            return hops.select("word", "root")
        hops = hops.select("word", "root")


def group_spellings(
    docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 31, least: int = 7, least_n: int = 2, times: int = 10, most: int = LIST_WORDS
) -> DataFrame:
    """Words of all texts (`run_counts`) that occur `least_n` times or more, each with the form it is a variant of.

    Columns: `word`, `form`, `root`, `n`, `n_near`, `form_n`. Words are near if one code point inserted, deleted or
    replaced makes one of the other; `n_near` counts them. `form` is the near word of largest `n` (the first in
    code-point order of equal ones) if it occurs at least `times` as often as the word, else null, and `form_n` its `n`.
    `root` is where following forms ends, or the word itself. Repeated keys and rows count as often as they stand. An
    empty table, or texts without such words, give an empty result. Columns other than key and text are not read.
    """
    words = stored(run_counts(docs, key, text, every, least).filter(F.col("n") >= least_n), "spelling-words")
    is_form = F.col("best_n") >= F.col("n").cast("decimal(38,0)") * times
    grouped = words.join(near_words(words, most), "word", "left").select(
        "word",
        F.when(is_form, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    grouped = stored(grouped, "spelling-forms")
    roots = _roots(grouped.filter("form IS NOT NULL").select("word", "form"))
    return grouped.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
