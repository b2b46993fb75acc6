"""A reproducible shuffle whose shard and slot can be computed: a Feistel permutation of global row numbers.

Rows are numbered in an order that depends on their content only: by bucket of a hash of key, size and checksum, then
by these three. Counts per bucket give each bucket its first number, so numbering sorts buckets and never the table.
Rows that agree in all three are interchangeable; where there are very many of a kind, they come last, in as many
buckets as their number asks for, and it does not matter which of them gets which number.

The number goes through a Feistel network on a x b >= n cells, a and b near the square root of n. Places beyond n walk
on along their cycle until they fall inside; fewer than a places lie outside, so walks are short. Place p goes to
shard p mod m and slot p div m: shard sizes differ by one at most and slots have no gaps.

Everything is built-in expressions on three narrow columns; texts are read once and not moved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Buckets of the numbering. Their counts, and those of as many more for hot kinds, are the only global state.
BUCKETS = 1 << 14
#: Kinds of equal rows beyond this share of all rows are hot; there are at most 1 / share of them.
HOT_SHARE = 0.001
HOT_ROWS = 256
ROUNDS = 4
#: Steps of a walk. A walk takes fewer than a, and each step ends it but with probability below 1 / a.
MOST_STEPS = 64


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with at least `n` cells."""
    a = max(1, math.isqrt(n))
    return a, max(1, -(-n // a))


def permute_once(place: Column, a: int, b: int, seed: int) -> Column:
    """A permutation of 0 .. a*b-1 that is a plain expression of `place`.

    One half lies in Z_a, the other in Z_b; in turn each is shifted by a hash of the other, which can be undone.
    """
    left, right = _whole(place, b), F.pmod(place, F.lit(b))
    for n in range(ROUNDS):
        if n % 2:
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(seed + n), left), F.lit(b)), F.lit(b))
        else:
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(seed + n), right), F.lit(a)), F.lit(a))
    return left * F.lit(b) + right


def _whole(x: Column, y: int) -> Column:
    """Whole part of x / y for x >= 0, in longs."""
    return F.call_function("div", x, F.lit(y))


def permute(place: Column, n: int, seed: int) -> Column:
    """A permutation of 0 .. n-1: steps on the grid until the place lies below `n`."""
    a, b = grid(n)
    once = permute_once(place, a, b, seed)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(min(a, MOST_STEPS) + 1)),
        once,
        lambda at, _: F.when(at >= n, permute_once(at, a, b, seed)).otherwise(at),
    )
    ended = F.when(once < n, once).otherwise(walk)
    return F.when(ended < n, ended).otherwise(F.raise_error(F.lit("a walk did not end")).cast("long"))


def number_rows(rows: DataFrame, kind: list[str], name: str) -> tuple[DataFrame, int]:
    """Add a gapless number from 0, in an order that depends on the values of `kind` only; and the number of rows.

    `rows` must be a stored table with no other column that differs between rows of equal `kind`.
    """
    spark = rows.sparkSession
    bucket, first, base, parts = (f"{name}_{x}" for x in ("bucket", "first", "base", "parts"))
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(*kind), F.lit(BUCKETS)).cast("int"))
    counts = dict(dealt.groupBy(bucket).count().collect())
    n = sum(counts.values())
    limit = max(HOT_ROWS, n * HOT_SHARE)
    full = [k for k, c in counts.items() if c > limit]
    if full:
        hot = dealt.filter(F.col(bucket).isin(full)).groupBy(*kind).count().filter(F.col("count") > limit).collect()
        spread, at = [], BUCKETS
        for *values, count in sorted(hot, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r)):
            share = -(-count * BUCKETS // n)
            spread.append((*values, at, share))
            at += share
        types = ", ".join(f"`{name}_{c}` {rows.schema[c].dataType.simpleString()}" for c in kind)
        known = spark.createDataFrame(spread, f"{types}, `{base}` int, `{parts}` int")
        same = [F.col(c).eqNullSafe(F.col(f"{name}_{c}")) for c in kind]
        own = F.col(base) + F.pmod(F.monotonically_increasing_id(), F.col(parts)).cast("int")
        dealt = dealt.join(F.broadcast(known), same, "left").withColumn(bucket, F.coalesce(own, F.col(bucket)))
        dealt = dealt.select(*rows.columns, bucket)
        counts = dict(dealt.groupBy(bucket).count().collect())
    starts, at = [], 0
    for k in sorted(counts):
        starts.append((k, at))
        at += counts[k]
    offsets = spark.createDataFrame(starts, f"{bucket} int, {first} long")
    within = F.row_number().over(W.partitionBy(bucket).orderBy(*kind)) - 1
    numbered = dealt.withColumn(name, within).join(F.broadcast(offsets), bucket)
    return numbered.withColumn(name, (F.col(first) + F.col(name)).cast("long")).drop(bucket, first), n


def shard_rows(docs: DataFrame, shards: int, seed: int = 11, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Deal all rows of `docs` out to `shards` shards by the `rows` law: counts differ by one at most.

    Per row: the key as `doc_id`, `size` (bytes of the text in UTF-8 plus 8), `text_crc32`, `law`, `shard`, `slot`
    (gapless from 0 in each shard) and a null `grown_shard`. A null text counts as empty: size 8, checksum 0. Null and
    repeated keys are dealt out like others; rows equal in key, size and checksum are interchangeable, so that the
    result as a whole is the same whatever the files look like. Other columns are not read. With fewer rows than
    shards some shards stay empty; an empty table gives an empty result.
    """
    narrow = stored(
        docs.select(
            F.col(key).alias("doc_id"),
            (F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_crc32"),
        ),
        "sharding",
    )
    numbered, n = number_rows(narrow, ["doc_id", "size", "text_crc32"], "number")
    place = permute(F.col("number"), n, seed)
    return numbered.withColumn("place", place).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard"),
        _whole(F.col("place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
