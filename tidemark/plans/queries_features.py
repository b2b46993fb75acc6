"""Registered queries: feature tables, preparation, encoding and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Config
from tidemark.operators import features, split
from tidemark.operators.features import FEATURES
from tidemark.operators.metrics import class_weights
from tidemark.operators.quantiles import column_quantiles, exact_quantiles
from tidemark.operators.wide_encoder import WideEncoder
from tidemark.plans.registered import query, scratch_database
from tidemark.plans.retrain import draw_holdout, training_rows
from tidemark.plans.subjects import (
    CUSTOMERS,
    DOCUMENTS,
    EARLIER_CUTOFF,
    EVENT_LOG_SQL,
    customers,
    customers_sql,
    event_log,
    table,
)
from tidemark.session import scratch_path
from tidemark.sources import bucket_files, feature_table, scored_log
from tidemark.sources.tables import load_csv_table

_C = f"WITH c AS ({customers_sql()})"
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).where(F.col("lapsed").isNotNull())


_L = f"WITH c AS (SELECT * FROM ({customers_sql()}) WHERE lapsed IS NOT NULL)"

_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate"


@query(
    "q_feature_project_dedupe",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
        strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
      SELECT {_LINE_COLUMNS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_extendedprice, l_quantity) AS n FROM lineitem) WHERE n = 1""",
)
def project_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*_LINE_COLUMNS.split(", "))
    newest = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_extendedprice"), F.asc("l_quantity")]
    unique = features.dedupe(lines, ["l_orderkey", "l_linenumber"], newest)
    return unique.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        "l_extendedprice",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )


@query("q_dedupe_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedupe_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Any row per key survives, so only the key can be compared."""
    return features.dedupe(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber"
    )


@query(
    "q_key_problems",
    """SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS null_keys, count(*) FILTER (WHERE n > 1) AS repeated_keys
    FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def key_problems(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table.key_problems(table(spark, sf, "lineitem"), "l_orderkey")


@query("q_label_project", f"{_C} SELECT c_custkey, lapsed FROM c")
def label_project(spark: SparkSession, sf: str) -> DataFrame:
    return features.project_labels(customers(spark, sf), CUSTOMERS)


_UPSERT_COLUMNS = ("c_custkey", "segment", "n_orders", "days_since")
_UPSERT = f"""
    WITH o AS ({customers_sql(EARLIER_CUTOFF)}), n AS (
      SELECT * FROM ({customers_sql()}) WHERE days_since < 366)
    SELECT {", ".join(_UPSERT_COLUMNS)} FROM n
    UNION ALL SELECT {", ".join(_UPSERT_COLUMNS)} FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n)"""


def _old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customer features at the earlier cutoff, and those of customers that ordered since."""
    old = customers(spark, sf, EARLIER_CUTOFF).select(*_UPSERT_COLUMNS)
    new = customers(spark, sf).where("days_since < 366").select(*_UPSERT_COLUMNS)
    return old, new


@query("q_feature_upsert", _UPSERT)
def feature_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table.upsert_rows(*_old_and_new(spark, sf), "c_custkey")


@query("q_feature_store", _UPSERT)
def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a stored, bucketed feature table: created, then merged into, then read."""
    old, new = _old_and_new(spark, sf)
    name = f"{scratch_database(spark)}.customer_features"
    feature_table.create(old, name, "c_custkey", buckets=8)
    feature_table.merge(new, name, "c_custkey", buckets=8)
    return spark.table(name)


@query("q_upsert_delta", _UPSERT)
def upsert_delta(spark: SparkSession, sf: str) -> DataFrame:
    """The same through bucket files: customers of one segment are merged first, then the others."""
    old, new = _old_and_new(spark, sf)
    name = f"{scratch_database(spark)}.customer_features"
    bucket_files.create(old, name, "c_custkey", 64)
    first = F.col("segment") == _SEGMENTS[0]
    for part in (new.where(first), new.where(~first)):
        bucket_files.merge(part, name)
    return bucket_files.open_table(spark, name)


@query(
    "q_feature_lookup",
    """SELECT doc_id, quality, lang, source, n_chars FROM labels LEFT JOIN documents USING (doc_id)""",
)
def feature_lookup(spark: SparkSession, sf: str) -> DataFrame:
    labels = features.project_labels(table(spark, sf, "labels"), DOCUMENTS)
    docs = features.project_features(table(spark, sf, "documents"), DOCUMENTS)
    return feature_table.lookup(labels, docs, "doc_id")


@query(
    "q_feature_lookup_unmatched",
    """SELECT quality, lang, n_chars FROM labels l
       LEFT JOIN (SELECT * FROM documents WHERE lang <> 'fr') d ON l.doc_id = d.doc_id""",
)
def feature_lookup_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    """Labels whose key has no features keep their row; the key is left out afterwards."""
    docs = table(spark, sf, "documents").where("lang <> 'fr'").select("doc_id", "lang", "n_chars")
    labels = features.project_labels(table(spark, sf, "labels"), DOCUMENTS)
    return feature_table.lookup(labels, docs, "doc_id", exclude=("doc_id",))


@query(
    "q_hot_lookup",
    """SELECT k, l_returnflag, p_brand, p_size, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM (
         SELECT CASE WHEN l_linenumber % 2 = 1 THEN 7 WHEN l_linenumber < 6 THEN 2 * l_partkey END AS k, l_returnflag, l_quantity
         FROM lineitem) LEFT JOIN part ON k = p_partkey GROUP BY ALL""",
)
def hot_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in the role of labels: half of them ask for one part, some for none, and some for parts there are not."""
    name = f"{scratch_database(spark)}.parts"
    feature_table.create(table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_brand", "p_size"), name, "k", buckets=8)
    number, part = F.col("l_linenumber"), F.col("l_partkey")
    asked = F.when(number % 2 == 1, 7).when(number < 6, 2 * part).cast(spark.table(name).schema["k"].dataType)
    lines = table(spark, sf, "lineitem").select(asked.alias("k"), "l_returnflag", "l_quantity")
    found = feature_table.lookup_spread(lines, spark.table(name), "k", tasks=8)
    return found.groupBy("k", "l_returnflag", "p_brand", "p_size").agg(
        F.count("*").alias("n"), F.sum("l_quantity").cast("double").alias("quantity")
    )


@query(
    "q_combine_training",
    f"""{_C} SELECT lapsed, NULL AS batch, count(*) AS n FROM c GROUP BY 1
    UNION ALL SELECT lapsed, 'earlier', count(*) FROM ({customers_sql(EARLIER_CUTOFF)}) GROUP BY 1""",
)
def combine_training(spark: SparkSession, sf: str) -> DataFrame:
    """New rows carry a column more; the base rows get nulls there."""
    new = customers(spark, sf, EARLIER_CUTOFF).withColumn("batch", F.lit("earlier"))
    both = features.combine(customers(spark, sf), new)
    return both.groupBy("lapsed", "batch").agg(F.count("*").alias("n"))


_PREPARED = """segment, region, nation, CAST(debtor AS VARCHAR) AS debtor, n_orders,
    round(spend, 2) AS spend, acctbal, days_since"""


@query(
    "q_prepare_labelled",
    f"{_C} SELECT {_PREPARED}, CASE WHEN lapsed = 'Yes' THEN 1 ELSE 0 END AS label FROM c",
)
def prepare_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return features.prepare(customers(spark, sf), CUSTOMERS).withColumn("spend", F.round("spend", 2))


@query("q_prepare_unlabelled", f"{_C} SELECT {_PREPARED} FROM c")
def prepare_unlabelled(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf).drop("lapsed")
    return features.prepare(rows, CUSTOMERS).withColumn("spend", F.round("spend", 2))


def _medians(cols: tuple[str, ...]) -> str:
    return ", ".join(f"quantile_cont({c}, 5e-1) AS m_{c}" for c in cols)


_NUM = ("n_orders", "spend", "acctbal", "days_since")
_FILLED = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _NUM)
_SCALED = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
    f"ELSE stddev_pop({c}) OVER () END), 6) AS {c}"
    for c in _NUM
)


@query(
    "q_impute_scale",
    f"""{_C}, m AS (SELECT {_medians(_NUM)} FROM c), f AS (SELECT c_custkey, {_FILLED} FROM c, m)
    SELECT c_custkey, {_SCALED} FROM f""",
)
def impute_scale(spark: SparkSession, sf: str) -> DataFrame:
    """The number part of the encoder, fitted on the whole table."""
    config = CUSTOMERS.with_(categorical=())
    rows = features.prepare(customers(spark, sf), config, keep_key=True)
    encoder = features.TableEncoder(config).fit(rows)
    wide = features.encoded_columns(rows, encoder, config, "c_custkey")
    # adding zero turns a negative zero into zero
    return wide.select("c_custkey", *[(F.round(c, 6) + 0.0).alias(c) for c in _NUM])


_ONE_HOT = ", ".join(
    [
        f"CASE WHEN segment = '{s}' THEN 1e0 ELSE 0e0 END AS \"segment={s}\""
        for s in _SEGMENTS
        if s != "MACHINERY"
    ]
    + ["CASE WHEN segment = 'MACHINERY' THEN 1e0 ELSE 0e0 END AS \"segment=Unknown\""]
    + [f"CASE WHEN region = '{r}' THEN 1e0 ELSE 0e0 END AS \"region={r}\"" for r in _REGIONS if r != "ASIA"]
)


@query("q_one_hot", f"{_C} SELECT c_custkey, {_ONE_HOT} FROM c")
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """A missing segment counts as `Unknown`; a region that was not there at the fit gives zeros."""
    config = CUSTOMERS.with_(numeric=(), categorical=("segment", "region"), as_string=())
    rows = customers(spark, sf).select(
        "c_custkey", F.when(F.col("segment") != "MACHINERY", F.col("segment")).alias("segment"), "region"
    )
    encoder = features.TableEncoder(config).fit(rows.where("region <> 'ASIA'"))
    return features.encoded_columns(rows, encoder, config, "c_custkey")


_DUMMY = ", ".join(
    [f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS \"segment_{s}\"" for s in _SEGMENTS[1:]]
    + [f"CASE WHEN region = '{r}' THEN 1 ELSE 0 END AS \"region_{r}\"" for r in _REGIONS[1:]]
)


@query("q_dummy_drop_first", f"{_C} SELECT c_custkey, {_DUMMY} FROM c")
def dummy_drop_first(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf).select("c_custkey", "segment", "region")
    return features.dummy_columns(rows, ["segment", "region"])


_PROBS = (0.1, 0.5, 0.9)


@query(
    "q_quantiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(quantile_cont({c}, 1e-1), 4) AS p10,
        round(quantile_cont({c}, 5e-1), 4) AS p50, round(quantile_cont({c}, 9e-1), 4) AS p90 FROM lineitem"""
        for c in ("l_extendedprice", "l_quantity", "l_tax")
    ),
)
def quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of whole columns."""
    columns = ["l_extendedprice", "l_quantity", "l_tax"]
    found = column_quantiles(table(spark, sf, "lineitem"), columns, _PROBS)
    rows = [(c, *[round(v, 4) for v in found[c]]) for c in columns]
    return spark.createDataFrame(rows, "column string, p10 double, p50 double, p90 double")


@query(
    "q_class_weights",
    f"""{_L} SELECT CASE WHEN lapsed = 'Yes' THEN 1 ELSE 0 END AS label, count(*) AS n,
      round((SELECT count(*) FROM c) / (2e0 * count(*)), 6) AS weight FROM c GROUP BY 1""",
)
def weights(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.prepare(_labelled(spark, sf), CUSTOMERS)
    return class_weights(rows).withColumn("weight", F.round("weight", 6))


def split_sql(source: str, share: str, seed: str, key: str, stratum: str) -> str:
    """Exact shares per class by largest remainder, ranks by the hash of key and seed."""
    return f"""
      SELECT *, rank <= quota AS drawn FROM (
        SELECT b.*, row_number() OVER (PARTITION BY s ORDER BY md5(CAST({key} AS VARCHAR) || '{seed}'), {key}) AS rank
        FROM (SELECT *, {stratum} AS s FROM {source}) b)
      JOIN (
        SELECT s, whole + CASE WHEN row_number() OVER (ORDER BY exact - whole DESC, s)
                 <= ceil({share} * sum(n) OVER ()) - sum(whole) OVER () THEN 1 ELSE 0 END AS quota
        FROM (SELECT s, n, {share} * n AS exact, floor({share} * n) AS whole
              FROM (SELECT {stratum} AS s, count(*) AS n FROM {source} GROUP BY 1))) USING (s)"""


_LABEL_SQL = "CASE WHEN lapsed = 'Yes' THEN 1 ELSE 0 END"


@query(
    "q_stratified_split",
    f"{_L} SELECT c_custkey, s AS label, drawn AS is_test FROM ({split_sql('c', '2e-1', '42', 'c_custkey', _LABEL_SQL)})",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    rows = features.prepare(_labelled(spark, sf), CUSTOMERS, keep_key=True).select("c_custkey", "label")
    return split.mark_share(rows, "c_custkey", 0.2, 42, F.col("label"))


@query(
    "q_random_split",
    f"SELECT o_orderkey, drawn AS is_test FROM ({split_sql('orders', '2e-1', '42', 'o_orderkey', '0')})",
)
def random_split(spark: SparkSession, sf: str) -> DataFrame:
    return split.mark_share(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.2, 42)


_HELD = split_sql("c", "15e-2", "holdout42", "c_custkey", _LABEL_SQL)


@query("q_holdout", f"{_L} SELECT c_custkey, lapsed FROM ({_HELD}) WHERE drawn")
def holdout(spark: SparkSession, sf: str) -> DataFrame:
    return draw_holdout(_labelled(spark, sf).select("c_custkey", "lapsed"), CUSTOMERS)


@query(
    "q_exclude_holdout",
    f"{_L} SELECT c_custkey, lapsed, segment, n_orders FROM ({_HELD}) WHERE NOT drawn",
)
def exclude_holdout(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled(spark, sf)
    held = draw_holdout(rows.select("c_custkey", "lapsed"), CUSTOMERS)
    return training_rows(
        features.project_labels(rows, CUSTOMERS), rows.select("c_custkey", "segment", "n_orders"), CUSTOMERS, held
    )


@query(
    "q_append_log",
    f"""SELECT strftime(inference_ts, '%Y-%m-%d') AS inference_date, count(*) AS n_rows, count(note) AS n_notes,
        round(sum(amount), 2) AS amount
      FROM (SELECT *, CASE WHEN inference_ts >= TIMESTAMP '2024-01-16' THEN event_type END AS note
            FROM ({EVENT_LOG_SQL})) GROUP BY 1""",
)
def append_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches appended to a log; the second has a column more."""
    log = event_log(spark, sf)
    first = log.where(F.col("inference_ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    second = log.where(F.col("inference_ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    name = f"{scratch_database(spark)}.inference_log"
    scored_log.append(first, name, many_days=True)
    scored_log.append(second.withColumn("note", F.col("event_type")), name, many_days=True)
    return (
        spark.table(name)
        .groupBy(F.date_format("inference_date", "yyyy-MM-dd").alias("inference_date"))
        .agg(
            F.count("*").alias("n_rows"), F.count("note").alias("n_notes"), F.round(F.sum("amount"), 2).alias("amount")
        )
    )


@query(
    "q_quantiles_grouped",
    """SELECT nullif(l_returnflag, 'A') AS flag, round(quantile_cont(l_extendedprice, 1e-1), 4) AS p10,
      round(quantile_cont(l_extendedprice, 5e-1), 4) AS p50, round(quantile_cont(l_extendedprice, 9e-1), 4) AS p90
     FROM lineitem GROUP BY 1""",
)
def quantiles_grouped(spark: SparkSession, sf: str) -> DataFrame:
    """Groups with a null key among them."""
    rows = table(spark, sf, "lineitem").select(F.nullif("l_returnflag", F.lit("A")).alias("flag"), "l_extendedprice")
    found = exact_quantiles(rows, ["flag"], "l_extendedprice", _PROBS)
    return found.select("flag", *[F.round(F.col("quantiles")[i], 4).alias(f"p{int(p * 100)}") for i, p in enumerate(_PROBS)])


@query(
    "q_one_hot_wide",
    """SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS position FROM orders""",
)
def one_hot_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Position of each value of a column with as many values as rows."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("word"))
    return features.positions_of(orders, "word", features.category_positions(orders, "word")).select("o_orderkey", "position")


_RETRAIN_COLUMNS = ("c_custkey", "segment", "n_orders", "days_since", "lapsed")


@query(
    "q_retrain_input",
    f"""WITH o AS ({customers_sql(EARLIER_CUTOFF)}), n AS (SELECT * FROM ({customers_sql()}) WHERE days_since < 366)
    SELECT {", ".join(_RETRAIN_COLUMNS)} FROM n
    UNION ALL SELECT {", ".join(_RETRAIN_COLUMNS)} FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
)
def retrain_input(spark: SparkSession, sf: str) -> DataFrame:
    """Base and new rows of the same customers: feature and label of the new row survive."""
    base = customers(spark, sf, EARLIER_CUTOFF).select(*_RETRAIN_COLUMNS)
    new = customers(spark, sf).where("days_since < 366").select(*_RETRAIN_COLUMNS)
    return features.combine_newest(base, new, "c_custkey")


@query(
    "q_feature_upsert_partial",
    f"""WITH o AS ({customers_sql(EARLIER_CUTOFF)}), n AS (SELECT * FROM ({customers_sql()}) WHERE days_since < 366)
    SELECT n.c_custkey, o.segment, n.n_orders, o.days_since FROM n LEFT JOIN o ON o.c_custkey = n.c_custkey
    UNION ALL SELECT {", ".join(_UPSERT_COLUMNS)} FROM o WHERE c_custkey NOT IN (SELECT c_custkey FROM n)""",
)
def feature_upsert_partial(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that brings one of the features leaves the others as they are."""
    old, new = _old_and_new(spark, sf)
    return feature_table.upsert_rows(old, new.select("c_custkey", "n_orders"), "c_custkey")


@query(
    "q_append_log_widened",
    f"""SELECT strftime(inference_ts, '%Y-%m-%d') AS inference_date, count(*) AS n_rows,
        CAST(sum(CASE WHEN inference_ts >= TIMESTAMP '2024-01-16' THEN 3 ELSE 5000000000 END) AS BIGINT) AS weight
      FROM ({EVENT_LOG_SQL}) GROUP BY 1""",
)
def append_log_widened(spark: SparkSession, sf: str) -> DataFrame:
    """A batch whose column has a narrower type and another case than the log's goes in without loss."""
    log = event_log(spark, sf)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    name = f"{scratch_database(spark)}.inference_log"
    scored_log.append(log.where(F.col("inference_ts") < middle).withColumn("weight", F.lit(5_000_000_000)), name, many_days=True)
    scored_log.append(log.where(F.col("inference_ts") >= middle).withColumn("Weight", F.lit(3)), name, many_days=True)
    day = F.date_format("inference_date", "yyyy-MM-dd").alias("inference_date")
    return spark.table(name).groupBy(day).agg(F.count("*").alias("n_rows"), F.sum("weight").alias("weight"))


@query(
    "q_csv_table",
    """SELECT o_orderstatus, count(*) AS n_rows, max(o_orderkey + 9007199254740993) AS top FROM orders GROUP BY 1""",
)
def csv_table(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV and loaded into a catalog table; numbers beyond 2^53 keep every digit."""
    path = scratch_path(spark, "orders-csv")
    long_key = (F.col("o_orderkey") + F.lit(9007199254740993)).alias("long_key")
    table(spark, sf, "orders").select(long_key, "o_orderstatus").write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("long_key", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    loaded = load_csv_table(spark, path, schema, f"{scratch_database(spark)}.orders", ["long_key"])
    return loaded.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.max("long_key").alias("top"))


_WIDE = Config(key="l_orderkey", target="l_linestatus", numeric=("l_quantity", "price"), categorical=("l_orderkey", "l_partkey", "l_returnflag"))
_WIDE_LINES = "SELECT *, CASE WHEN l_linenumber < 6 THEN l_extendedprice END AS price, l_linenumber < 4 AS seen FROM lineitem"
_WIDE_VALUES = " UNION ALL ".join(
    f"SELECT DISTINCT {i} AS ordinal, coalesce(CAST({c} AS VARCHAR), 'Unknown') AS category FROM f" for i, c in enumerate(_WIDE.categorical)
)
_WIDE_FIGURES = ", ".join(f"median({c}) AS m{i}" for i, c in enumerate(_WIDE.numeric))
_WIDE_MOMENTS = ", ".join(
    f"avg(coalesce({c}, m{i})) AS mean{i}, stddev_pop(coalesce({c}, m{i})) AS std{i}" for i, c in enumerate(_WIDE.numeric)
)


@query(
    "q_encode_wide",
    f"""WITH l AS ({_WIDE_LINES}), f AS (SELECT * FROM l WHERE seen),
     d AS (SELECT *, 1 + row_number() OVER (ORDER BY ordinal, category) AS position FROM ({_WIDE_VALUES})),
     m AS (SELECT {_WIDE_FIGURES} FROM f), s AS (SELECT {_WIDE_MOMENTS} FROM f, m)
    SELECT l_orderkey, l_linenumber, (SELECT 2 + count(*) FROM d) AS size,
      '[' || concat_ws(',', '0', '1', x.position, y.position, z.position) || ']' AS places,
      round((coalesce(l_quantity, m0) - mean0) / std0, 6) AS quantity, round((coalesce(price, m1) - mean1) / std1, 6) AS price
    FROM l, m, s
    LEFT JOIN d AS x ON x.ordinal = 0 AND x.category = CAST(l_orderkey AS VARCHAR)
    LEFT JOIN d AS y ON y.ordinal = 1 AND y.category = coalesce(CAST(l_partkey AS VARCHAR), 'Unknown')
    LEFT JOIN d AS z ON z.ordinal = 2 AND z.category = coalesce(l_returnflag, 'Unknown')""",
)
def encode_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Lines encoded with a dictionary of all orders, fitted on the first three lines of each order."""
    lines = table(spark, sf, "lineitem").withColumn("price", F.when(F.col("l_linenumber") < 6, F.col("l_extendedprice")))
    encoder = WideEncoder(_WIDE, f"{scratch_database(spark)}.dictionary").fit(lines.where("l_linenumber < 4"))
    encoded = encoder.transform(lines).withColumn("_v", F.unwrap_udt(FEATURES))
    return encoded.select(
        "l_orderkey",
        "l_linenumber",
        F.col("_v.size").cast("bigint").alias("size"),
        F.concat(F.lit("["), F.array_join("_v.indices", ","), F.lit("]")).alias("places"),
        F.round(F.col("_v.values")[0], 6).alias("quantity"),
        F.round(F.col("_v.values")[1], 6).alias("price"),
    )
