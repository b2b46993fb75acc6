"""N-gram Jaccard join by parity sketches.

The set of a document is that of its hashed word shingles. Two sets with similarity of at least `per_cent` % have sizes
within that ratio, and a symmetric difference of at most a fixed share of their sizes together. Size bands double;
band j serves the pairs whose smaller set has between 2^j and 2^(j+1) - 1 shingles, so a set signs in its own band, and
in the one below if a smaller partner may lie there.

A band splits the universe of shingles into blocks, and the sketch of a set holds one word per block: the shingles of
the block added up modulo 2^64, a parity with more bits. Each shingle that only one of two sets has changes one block,
so the number of differing words never exceeds the symmetric difference. With at most d differing words, any d + 1
words of a set contain one that its partner has too. Sets therefore sign with the d + 1 words that are first in a global
order (fullest block first, then by the word): of two partners, the one whose last word comes earlier shares a word
that both sign with. A set with too few filled blocks signs with its empty ones as well, so nothing is lost.

Equal sets are one class. Signatures are sorted by value, and each class is first held against the classes that lead its
buckets; exact links give components. What is left are pairs of different components in one bucket. Shingles
that no other component has, and bits in which one-bit parity sketches of two sets differ, bound their symmetric
difference from below; pairs that pass both bounds are verified exactly. Every pair of a bucket is thus linked
indirectly, ruled out by a bound, or verified.

Shingles are compared by 64-bit hashes, classes by 128 bits and size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow_text import NOT_SPACE, flat_texts, list_array, lower_ascii, mix, run_hashes, short_batches, slices, span_hashes, word_spans
from tidemark.llm.bitmaps import hits_sized, sized_bitmap
from tidemark.llm.common import fresh_name, release, stored, with_row_key
from tidemark.llm.components import components

WORDS = 5
PER_CENT = 80
#: Blocks of a band for each word that its largest sets sign with.
SPARE = 1.15
LEAST_BLOCKS = 8
#: One in so many shingles is looked at for shingles that no other component has.
PART = 3
#: Longs of the one-bit parity sketch that pairs of a bucket are held against.
SKETCH = 16

#: Earlier buckets of a class that are looked at for one that a pair has met in.
EARLIER = 8

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def salt(k: int) -> np.uint64:
    """The k-th multiple of `_PRIME` modulo 2^64."""
    return np.uint64(k * int(_PRIME) & 0xFFFFFFFFFFFFFFFF)



def shingle_sets(data: np.ndarray, marks: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Owner and hash of the distinct shingles of each text, sorted; fewer words than a shingle has are one shingle."""
    starts, ends, bounds = word_spans(data, marks, NOT_SPACE)
    hashes = span_hashes(lower_ascii(data), starts, ends)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    runs = run_hashes(hashes, words)
    inside = owner[: len(runs)] == owner[len(owner) - len(runs) :]
    owners, values = [owner[: len(runs)][inside]], [runs[inside]]
    for k in range(1, words):
        short = np.flatnonzero(counts == k)
        if len(short):
            owners.append(short)
            values.append(mix(run_hashes(hashes, k)[bounds[short]] + np.uint64(k)))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[new], value[new]


def largest_partner(sizes: np.ndarray, per_cent: int) -> np.ndarray:
    return sizes * 100 // per_cent


def difference_bound(sizes_together: np.ndarray, per_cent: int) -> np.ndarray:
    """Most elements that two linked sets of these sizes together do not share."""
    return sizes_together * (100 - per_cent) // (100 + per_cent)


def signatures(owner: np.ndarray, value: np.ndarray, n: int, per_cent: int = PER_CENT) -> tuple[np.ndarray, np.ndarray]:
    """Owner and signature of what each of `n` sets signs with; sets are sorted runs of `owner`."""
    sizes = np.bincount(owner, minlength=n)
    owners, signs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for band in range(int(sizes.max(initial=0)).bit_length()):
        low, high = 1 << band, (2 << band) - 1
        most = int(largest_partner(np.array([high]), per_cent)[0])
        signing = (sizes >= low) & (sizes <= most)
        if not signing.any():
            continue
        partner = np.where(sizes > high, high, largest_partner(sizes, per_cent))
        wanted = difference_bound(sizes + partner, per_cent) + 1
        top = int(difference_bound(np.array([high + most]), per_cent)[0]) + 1
        blocks = max(LEAST_BLOCKS, int(np.ceil(SPARE * top)))
        member = signing[owner]
        o, v = owner[member], value[member]
        block = ((v >> np.uint64(11)) % np.uint64(blocks)).astype(np.int64)
        order = np.argsort(o * blocks + block, kind="stable")
        o, v, block = o[order], v[order], block[order]
        first = np.ones(len(o), dtype=bool)
        first[1:] = (o[1:] != o[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(first)
        weight = np.diff(np.append(at, len(o)))
        word = np.add.reduceat(mix(v ^ _PRIME), at)
        o, block = o[at], block[at]
        word = mix(word + salt(band + 1) + (block.astype(np.uint64) << np.uint64(20)))
        order = np.lexsort((word, -weight, o))
        o, word, block = o[order], word[order], block[order]
        place = np.arange(len(o)) - np.searchsorted(o, o)
        chosen = place < wanted[o]
        owners.append(o[chosen])
        signs.append(word[chosen])
        filled = np.bincount(o, minlength=n)
        for i in np.flatnonzero(signing & (filled < wanted)):
            empty = np.setdiff1d(np.arange(blocks), block[np.searchsorted(o, i) : np.searchsorted(o, i, side="right")])
            owners.append(np.full(len(empty), i))
            signs.append(mix(salt(band + 1) + (empty.astype(np.uint64) << np.uint64(20)) + np.uint64(7)))
    return np.concatenate(owners), np.concatenate(signs)


def bit_sketches(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Parity sketches of `n` sets: each element flips one bit, so no more bits differ than elements do."""
    bit = (value >> np.uint64(3)) % np.uint64(64 * SKETCH)
    flips = np.bincount(owner * (64 * SKETCH) + bit.astype(np.int64), minlength=n * 64 * SKETCH)
    return np.packbits((flips & 1).astype(np.uint8).reshape(n, -1), axis=1, bitorder="little").view(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def describe(rows: DataFrame, words: int) -> DataFrame:
    """Per row of `rid`, `doc_id`, `text`: set size `n` and 128 bits of the set in `c` and `h`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 2):
            data, marks = flat_texts(batch.column(2))
            for first, last in slices(marks):
                owner, value = shingle_sets(data[marks[first] : marks[last]], marks[first : last + 1] - marks[first], words)
                part = batch.slice(first, last - first)
                sizes, names = set_names(owner, value, last - first)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *map(pa.array, (sizes, *names))], names=["rid", "doc_id", "n", "c", "h"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"rid long, doc_id {kind}, n long, c long, h long")


def set_names(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sizes and two 64-bit names of `n` sets."""
    sizes = np.bincount(owner, minlength=n)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    names = []
    for k in (1, 2):
        total = np.zeros(len(value) + 1, dtype=np.uint64)
        np.cumsum(mix(value + salt(k)), out=total[1:])
        names.append(_signed(mix(total[bounds[1:]] - total[bounds[:-1]])))
    return sizes, names


def sign_documents(texts: DataFrame, words: int, per_cent: int) -> DataFrame:
    """`sign` and `c` for each signature of each text; computed again from the texts, which is less than storing them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_batches(batches, 0):
            data, marks = flat_texts(batch.column(0))
            for first, last in slices(marks):
                owner, value = shingle_sets(data[marks[first] : marks[last]], marks[first : last + 1] - marks[first], words)
                _, names = set_names(owner, value, last - first)
                who, sign = signatures(owner, value, last - first, per_cent)
                # copies within a slice sign once
                _, own = np.unique(names[0], return_index=True)
                kept = np.zeros(last - first, dtype=bool)
                kept[own] = True
                who, sign = who[kept[who]], sign[kept[who]]
                yield pa.RecordBatch.from_arrays([pa.array(_signed(sign)), pa.array(names[0][who])], names=["sign", "c"])

    return texts.mapInArrow(work, "sign long, c long")


def shared_buckets(signs: DataFrame) -> DataFrame:
    """Rows of `sign` and `c` whose signature at least two classes have, with `first`, the least class of the bucket.

    Sorted rows stream through, so a bucket of any size takes constant memory. A class has some hundred signatures,
    so even a bucket that holds every class has below a hundredth of all rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sign = last_c = head = None
        lonely = False
        for batch in batches:
            sign, c = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(sign):
                continue
            new = np.ones(len(sign), dtype=bool)
            new[1:] = (sign[1:] != sign[:-1]) | (c[1:] != c[:-1])
            new[0] = (last_sign, last_c) != (sign[0], c[0])
            sign, c = sign[new], c[new]
            if not len(sign):
                continue
            begins = np.ones(len(sign), dtype=bool)
            begins[1:] = sign[1:] != sign[:-1]
            begins[0] = last_sign != sign[0]
            at = np.flatnonzero(begins)
            group = np.cumsum(begins) - 1
            lead = c[at][group] if begins[0] else np.where(group < 0, head, c[np.append(at, 0)][group])
            follows = ~begins
            # the head of a bucket goes out once a second class has come
            heads = at[~np.append(begins[1:], True)[at]]
            out_sign, out_c, out_first = [sign[follows], sign[heads]], [c[follows], c[heads]], [lead[follows], c[heads]]
            if lonely and follows[0]:
                out_sign.append(sign[:1])
                out_c.append(np.array([head], dtype=np.int64))
                out_first.append(np.array([head], dtype=np.int64))
            lonely = bool(begins[-1])
            last_sign, last_c, head = sign[-1], c[-1], lead[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x)) for x in (out_sign, out_c, out_first)], names=["sign", "c", "first"]
            )

    return signs.repartition("sign").sortWithinPartitions("sign", "c").mapInArrow(work, "sign long, c long, first long")


def only_marked(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of `rid` whose `rid` is in `wanted`, and by chance some others: a bitmap sorts them out before any shuffle."""
    marks = wanted.select(F.xxhash64("rid").alias("mark"))
    shared = rows.sparkSession.sparkContext.broadcast(sized_bitmap(marks, "mark", marks.count()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            kept = batch.filter(pa.array(hits_sized(shared.value, batch.column(last).to_numpy().view(np.uint64))))
            if kept.num_rows:
                yield kept.select(range(last))

    return rows.withColumn("mark", F.xxhash64("rid")).mapInArrow(work, rows.schema)


def sets_of(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """`rid`, `shingles` and `sketch` of the rows of `rid`, `text` whose `rid` is in `wanted`."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in short_batches(batches, 1):
            data, marks = flat_texts(part.column(1))
            for first, last in slices(marks):
                owner, value = shingle_sets(data[marks[first] : marks[last]], marks[first : last + 1] - marks[first], words)
                n = last - first
                lists = list_array(_signed(value), np.bincount(owner, minlength=n), pa.int64())
                sketches = list_array(bit_sketches(owner, value, n).ravel(), np.full(n, SKETCH), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).slice(first, n), lists, sketches], names=["rid", "shingles", "sketch"])

    found = only_marked(rows, wanted).mapInArrow(work, "rid long, shingles array<long>, sketch array<long>")
    return found.join(wanted.select("rid"), "rid", "left_semi")


def linked(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs `u`, `v` of a stored table whose sets have a similarity of at least `per_cent` %, exactly."""
    met = pairs.select(F.explode(F.array("u", "v")).alias("rid")).distinct()
    held = only_marked(sets.select("rid", "shingles"), stored(met, "parity-met"))
    left = held.select(F.col("rid").alias("u"), F.col("shingles").alias("su"))
    right = held.select(F.col("rid").alias("v"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    # pairs grow with the sets, so the joins are the same at every size
    found = pairs.select("u", "v").hint("merge").join(left, "u").hint("merge").join(right, "v").select("u", "v", both.alias("k"), (F.size("su") + F.size("sv")).alias("s"))
    return found.filter(100 * F.col("k") >= per_cent * (F.col("s") - F.col("k"))).select("u", "v")


def lead_links(tried: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """Links among the stored pairs `u`, `v`, `shared`: enough of them to give the components of all.

    Each class is held against the lead that it shares most buckets with; of the other pairs, only those whose classes
    are not in one component by then. Sets are sent once per pair, so copies of copies are not sent once per lead.
    """
    best = tried.groupBy("u").agg(F.max(F.struct("shared", "v")).alias("best")).select("u", F.col("best.v").alias("v"))
    near = stored(linked(stored(best, "parity-best"), sets, per_cent), "parity-links")
    part = components(near)
    of = lambda x: part.select(F.col("node").alias(x), F.col("component").alias(f"p{x}"))
    apart = tried.select("u", "v").join(best, ["u", "v"], "left_anti").join(of("u"), "u", "left").join(of("v"), "v", "left")
    rest = stored(apart.filter(F.coalesce("pu", "u") != F.coalesce("pv", "v")).select("u", "v"), "parity-rest")
    return stored(near.union(linked(rest, sets, per_cent)), "parity-links")


def sizes_fit(small: str, large: str, per_cent: int) -> Column:
    return F.least(small, large) * 100 >= F.greatest(small, large) * per_cent


def sketches_allow(per_cent: int) -> Column:
    """Whether the sketches `ku` and `kv` differ in no more bits than linked sets of sizes `nu` and `nv` may."""
    bits = sum((F.bit_count(F.col("ku")[i].bitwiseXOR(F.col("kv")[i])) for i in range(SKETCH)), F.lit(0))
    return bits * (100 + per_cent) <= (100 - per_cent) * (F.col("nu") + F.col("nv"))


def component_rows(rows: DataFrame, words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """Per row of `rid`, `doc_id`, `text`: `rid`, `doc_id`, set size `n`, and the least row and key of its component.

    `root` is a row of the component, the same for all its rows; rows without shingles are their own.
    """
    narrow = stored(describe(rows.select("rid", "doc_id", "text"), words), "parity-sets")
    classes = stored(
        narrow.filter("n > 0").groupBy("c", "h", "n").agg(F.min("rid").alias("rid"), F.min("doc_id").alias("least")), "parity-classes"
    )
    buckets = stored(shared_buckets(sign_documents(rows.select("text"), words, per_cent)), "parity-buckets")
    wanted = stored(classes.join(buckets.select("c").distinct(), "c", "left_semi").select("rid", "c", "n"), "parity-wanted")
    sets = stored(sets_of(rows.select("rid", "text"), wanted, words), "parity-sets")

    # every class against the classes that lead its buckets, as far as their sketches allow
    known = wanted.join(sets.select("rid", "sketch"), "rid")
    leads = buckets.filter("c != first").groupBy("c", "first").agg(F.count(F.lit(1)).alias("shared"))
    tried = stored(
        leads.join(known.select("c", F.col("rid").alias("u"), F.col("n").alias("nu"), F.col("sketch").alias("ku")), "c")
        .join(known.select(F.col("c").alias("first"), F.col("rid").alias("v"), F.col("n").alias("nv"), F.col("sketch").alias("kv")), "first")
        .filter(sizes_fit("nu", "nv", per_cent) & sketches_allow(per_cent))
        .select("u", "v", "shared"),
        "parity-tried",
    )
    links = lead_links(tried, sets, per_cent)
    still = stored(open_pairs(buckets, wanted, sets, components(links), per_cent), "parity-pairs")
    release(buckets)
    more = stored(linked(still, sets, per_cent), "parity-links")
    release(sets, tried, still)
    final = components(links.union(more))

    placed = classes.join(final, classes["rid"] == final["node"], "left").select("c", "h", "n", "rid", "least", "component")
    roots = placed.filter("component is not null").groupBy("component").agg(F.min("least").alias("reach"))
    named = placed.join(roots, "component", "left").select(
        "c", "h", "n", F.coalesce("component", "rid").alias("root"), F.coalesce("reach", "least").alias("component_id")
    )
    found = narrow.filter("n > 0").join(named, ["c", "h", "n"]).select("rid", "doc_id", "n", "root", "component_id")
    alone = narrow.filter("n = 0").select("rid", "doc_id", "n", F.col("rid").alias("root"), F.col("doc_id").alias("component_id"))
    return found.union(alone)


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """Per row of `docs`: the key as `doc_id`, `n_shingles` and `component_id`, the smallest key reachable by links.

    Two rows link when their sets of distinct `words`-word shingles (lower case in ASCII, words between ASCII white
    space) have a Jaccard similarity of at least `per_cent` %, in whole numbers. A text with fewer words is one shingle;
    one without words, or null, has none, and its component is its own key. Equal texts link, and so do other rows with
    the same set. A repeated key gives a row each time; a null key is never the smallest, and stays null where no other
    is reachable. Other columns are not read. An empty table gives an empty result. `docs` should be a stored table,
    since its rows are numbered by split and place at three readings.
    """
    rows = with_row_key(docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")), "rid")
    return component_rows(rows, words, per_cent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """The rows of `docs`, unchanged, of which one of each component stays: of smallest key (null last), then first.

    Rows without words are linked with nothing and all stay.
    """
    rid = fresh_name(docs, "rid")
    rows = with_row_key(docs, rid)
    narrow = rows.select(F.col(rid).alias("rid"), F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = stored(component_rows(narrow, words, per_cent), "parity-components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "rid"))
    kept = found.groupBy("root").agg(first.alias("first")).select(F.col("first.rid").alias("rid"))
    gone = found.join(kept, "rid", "left_anti").select(F.col("rid").alias(rid))
    return rows.join(gone.hint("merge"), rid, "left_anti").drop(rid)


def open_pairs(buckets: DataFrame, wanted: DataFrame, sets: DataFrame, parts: DataFrame, per_cent: int) -> DataFrame:
    """Pairs of classes of different components that share a bucket and that counts do not rule out.

    `alone` counts the shingles of a class that no other component has, among one in `PART` of all shingles and as far as
    two classes at most have them. Those of both classes of a pair are in its symmetric difference, and so are at least as
    many shingles as their sketches have different bits; neither number may exceed the bound of the pair.
    """
    known = wanted.join(parts, wanted["rid"] == parts["node"], "left").select("c", "rid", "n", F.coalesce("component", "rid").alias("part"))
    placed = buckets.select("sign", "c").join(known, "c").select("sign", "rid", "n", "part")
    mixed = placed.groupBy("sign").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low != high").select("sign")
    mixed_rows = stored(placed.join(mixed, "sign"), "parity-open")
    members = mixed_rows.select("rid", "part").distinct()
    holders = (
        sets.join(members, "rid")
        .select(F.explode("shingles").alias("shingle"), "rid", "part")
        .filter(F.pmod("shingle", F.lit(PART)) == 0)
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("k"), F.min("rid").alias("a"), F.max("rid").alias("b"), F.min("part").alias("low"), F.max("part").alias("high"))
        .filter("k <= 2 and low = high")
    )
    alone = holders.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("rid")).groupBy("rid").agg(F.count(F.lit(1)).alias("alone"))
    viable = (
        members.join(alone, "rid", "left")
        .join(sets.select("rid", "sketch", F.size("shingles").alias("size")), "rid")
        .select("rid", F.coalesce("alone", F.lit(0)).alias("alone"), "sketch", "size")
        .filter(F.col("alone") * (100 + per_cent) <= (100 - per_cent) * (F.col("size") + F.floor(F.col("size") * 100 / per_cent)))
    )
    # a pair that shares an earlier bucket has met there: of its buckets, all that have one of the `EARLIER` before them
    # in common are passed over, and the first never is
    held = mixed_rows.join(viable.select("rid", "alone"), "rid").distinct()
    before = F.collect_list("sign").over(Window.partitionBy("rid").orderBy("sign").rowsBetween(-EARLIER, -1))
    rows = held.withColumn("before", before).join(viable.select("rid", "sketch"), "rid").select("sign", "rid", "n", "part", "alone", "sketch", "before")
    left = rows.toDF("sign", "u", "nu", "pu", "au", "ku", "bu")
    right = rows.toDF("sign", "v", "nv", "pv", "av", "kv", "bv")
    bound = (100 - per_cent) * (F.col("nu") + F.col("nv"))
    return (
        left.join(right, "sign")
        .filter((F.col("pu") != F.col("pv")) & (F.struct("nu", "u") < F.struct("nv", "v")) & sizes_fit("nu", "nv", per_cent))
        .filter(((F.col("au") + F.col("av")) * (100 + per_cent) <= bound) & sketches_allow(per_cent))
        .filter(~F.arrays_overlap("bu", "bv"))
        .select("u", "v")
        .distinct()
    )
