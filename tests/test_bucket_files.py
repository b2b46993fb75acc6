"""Upserts that rewrite the touched buckets only."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import bucket_files
from tidemark.sources.feature_table import KeyViolation


def plain(df):
    return {r.k: tuple(r) for r in df.collect()}


def batch(spark, keys, shift):
    return spark.createDataFrame([(k, float(k + shift), str(k % 7)) for k in keys], "k long, x double, c string")


def test_merges_equal_a_dictionary(spark, database):
    name, chance = f"{database}.features", random.Random(1)
    wanted = {k: (k, float(k), str(k % 7)) for k in range(3000)}
    assert bucket_files.write(batch(spark, range(3000), 0), name, "k", 16) == 3000
    first = bucket_files.open_table(spark, name)
    for step in (1, 2):
        keys = chance.sample(range(3300), 40)
        wanted |= {k: (k, float(k + step), str(k % 7)) for k in keys}
        assert bucket_files.write(batch(spark, keys, step), name, "k", 16) == len(wanted)
        assert plain(bucket_files.open_table(spark, name)) == wanted
    assert first.count() == 3000  # a reader of the first version still has it
    part = spark.createDataFrame([(5, "new", 1), (9999, "own", 2)], "k long, c string, extra int")
    bucket_files.merge(part, name)
    found = plain(bucket_files.open_table(spark, name))
    assert found[5] == (5, wanted[5][1], "new", 1) and found[9999] == (9999, None, "own", 2)
    assert found[6] == (*wanted[6], None) and len(found) == len(wanted) + 1


def test_bytes_written_follow_the_batch(spark, database):
    name = f"{database}.features"
    wide = spark.range(40_000).select(F.col("id").alias("k"), *[F.rand(i).alias(f"x{i}") for i in range(6)])
    bucket_files.create(wide, name, "k", 64)
    folders = lambda: {r.bucket: r.folder for r in spark.table(f"{database}.features__buckets").collect()}
    size = lambda held: sum(os.path.getsize(os.path.join(d, f)) for folder in held for d, _, fs in os.walk(folder.removeprefix("file:")) for f in fs if f.endswith("parquet"))
    before = folders()
    one_bucket = wide.where(F.pmod(F.hash("k"), F.lit(64)) == 3)
    bucket_files.merge(one_bucket.withColumn("x0", F.lit(0.5)), name)
    after = folders()
    fresh = [f for b, f in after.items() if f != before[b]]
    assert [b for b in after if after[b] != before[b]] == [3] and size(fresh) < size(before.values()) / 32
    assert bucket_files.open_table(spark, name).where("x0 = 0.5").count() == one_bucket.count()


def test_what_is_refused(spark, database):
    name = f"{database}.features"
    with pytest.raises(KeyViolation):
        bucket_files.create(batch(spark, [1, 1], 0), name, "k", 4)
    bucket_files.create(batch(spark, [1, 2], 0), name, "k", 4)
    for wrong in (batch(spark, [3, 3], 0), batch(spark, [3], 0).select(F.lit(None).cast("long").alias("k"), "x", "c")):
        with pytest.raises(KeyViolation):
            bucket_files.merge(wrong, name)
    with pytest.raises(ValueError, match="other types"):
        bucket_files.merge(batch(spark, [3], 0).withColumn("x", F.lit("a")), name)
    with pytest.raises(ValueError, match="already exists"):
        bucket_files.create(batch(spark, [1], 0), name, "k", 4)
    with pytest.raises(KeyViolation):
        bucket_files.write(batch(spark, [1], 0), name, "k", 8)
    assert len(plain(bucket_files.open_table(spark, name))) == 2


def test_empty_tables_and_vacuum(spark, database):
    name = f"{database}.features"
    assert bucket_files.create(batch(spark, [1], 0).limit(0), name, "k", 4) == 0
    assert bucket_files.open_table(spark, name).columns == ["k", "x", "c"] and bucket_files.open_table(spark, name).count() == 0
    assert bucket_files.merge(batch(spark, range(50), 0), name) == 50
    assert bucket_files.merge(batch(spark, range(50), 0).limit(0), name) == 50
    assert bucket_files.merge(batch(spark, [7], 1), name) == 50
    wanted = plain(bucket_files.open_table(spark, name))
    assert bucket_files.vacuum(spark, name) == []
    assert bucket_files.vacuum(spark, name, grace=1e-9) and plain(bucket_files.open_table(spark, name)) == wanted
