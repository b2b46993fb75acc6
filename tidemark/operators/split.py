"""Repeatable splits with exact sizes, without sorting or shuffling the rows.

Each row has a fixed place in a random order, the hash of its key and the seed. A count per hash prefix
finds the prefix in which the cut falls; longer prefixes narrow it down until few rows are left, and those
give the exact hash at the cut. After that the split is a comparison with a constant, so the rows
themselves never move.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numeric import key_hash

PREFIX_DIGITS = 4  # 65,536 prefixes per class and step
HASH_DIGITS = 32
ONE_TASK = 100_000  # rows of a cut prefix that one task may rank; more are narrowed down first


def quotas(counts: dict[object, int], share: float) -> dict[object, int]:
    """Rows to draw per class: ceil(share * all) in total, by largest remainder, ties in class order."""
    total = sum(counts.values())
    exact = {c: share * n for c, n in counts.items()}
    drawn = {c: math.floor(x) for c, x in exact.items()}
    missing = math.ceil(share * total) - sum(drawn.values())
    by_remainder = sorted(counts, key=lambda c: (-(exact[c] - drawn[c]), str(c)))
    for c in by_remainder[: max(missing, 0)]:
        drawn[c] += 1
    return drawn


def mark_share(
    df: DataFrame,
    key: str,
    share: float,
    seed: object,
    strata: Column | None = None,
    flag: str = "is_test",
) -> DataFrame:
    """`df` with a boolean `flag`, true for an exact share of the rows of every class.

    `strata` is the class of a row and has few values. Rows with the same key fall on the same side, so where
    keys repeat the share of rows can be exceeded by the copies of one key per class.
    """
    stratum = strata if strata is not None else F.lit(0)
    keyed = df.select(stratum.alias("s"), key_hash(F.col(key), seed).alias("h"))
    cuts = _cuts(keyed, share)
    hashed = key_hash(F.col(key), seed)
    chosen = F.lit(False)
    for value, cut in cuts.items():
        if cut is not None:
            chosen = chosen | (stratum.eqNullSafe(F.lit(value)) & (hashed <= cut))
    return df.withColumn(flag, chosen)


def _at_cut(keyed: DataFrame, digits: int, wanted: dict[object, int]) -> dict[object, tuple[str, int, int]]:
    """Per class the prefix in which the rank `wanted` falls, with the rows up to its end and in it."""
    per_prefix = keyed.withColumn("p", F.substring("h", 1, digits)).groupBy("s", "p").agg(F.count("*").alias("n"))
    # at most 65,536 rows per class, as all but the last digits are fixed
    order = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    running = per_prefix.withColumn("upto", F.sum("n").over(order))
    falls_here = F.lit(False)
    for s, rank in wanted.items():
        falls_here |= F.col("s").eqNullSafe(F.lit(s)) & (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
    return {r.s: (r.p, r.upto, r.n) for r in running.where(falls_here).collect()}


def _cuts(keyed: DataFrame, share: float) -> dict[object, str | None]:
    """For every class the largest hash that is drawn, None if none is."""
    drawn = quotas({r.s: r["count"] for r in keyed.groupBy("s").count().collect()}, share)
    cuts: dict[object, str | None] = {s: None for s in drawn}
    rest = {s: n for s, n in drawn.items() if n > 0}
    if not rest:
        return cuts
    digits, inside = PREFIX_DIGITS, keyed
    while True:
        places = _at_cut(inside, digits, rest)
        rest = {s: rest[s] - (upto - n) for s, (_, upto, n) in places.items()}
        in_cut = F.lit(False)
        for s, (p, _, _) in places.items():
            in_cut |= F.col("s").eqNullSafe(F.lit(s)) & F.col("h").startswith(p)
        inside = keyed.where(in_cut)
        if digits == HASH_DIGITS or max(n for _, _, n in places.values()) <= ONE_TASK:
            break
        digits += PREFIX_DIGITS
    # copies of a key are merged first, so a key with very many rows is one row here
    order = Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    ranked = inside.groupBy("s", "h").agg(F.count("*").alias("copies")).withColumn("upto", F.sum("copies").over(order))
    at_cut = F.lit(False)
    for s, rank in rest.items():
        at_cut |= F.col("s").eqNullSafe(F.lit(s)) & (F.col("upto") >= rank) & (F.col("upto") - F.col("copies") < rank)
    for r in ranked.where(at_cut).select("s", "h").collect():
        cuts[r.s] = r.h
    return cuts


def train_test_split(
    df: DataFrame, key: str, test_size: float, seed: object, strata: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; stratified when `strata` is given, plain otherwise."""
    marked = mark_share(df, key, test_size, seed, strata, "_test")
    return marked.where(~F.col("_test")).drop("_test"), marked.where("_test").drop("_test")


def fold_column(key: str, seed: object, folds: int) -> Column:
    """Fold number of a row for cross-validation, from a hash apart from the split's."""
    return (F.conv(F.substring(key_hash(F.col(key), f"fold{seed}"), 1, 8), 16, 10).cast("bigint") % folds).cast("int")
