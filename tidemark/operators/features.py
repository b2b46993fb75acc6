"""From a raw table to model input: project, dedupe, combine, prepare, encode."""

from __future__ import annotations

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import Config
from tidemark.functions.numeric import is_positive, number_literal, to_number
from tidemark.operators.quantiles import column_medians
from tidemark.session import cut_lineage

LABEL, FEATURES = "label", "features"

# Fixed value: category that stands for a missing one.
UNKNOWN = "Unknown"


def project_features(df: DataFrame, config: Config) -> DataFrame:
    return df.select(config.key, *config.features)


def project_labels(df: DataFrame, config: Config) -> DataFrame:
    return df.select(config.key, config.target)


def dedupe(df: DataFrame, keys: list[str], newest_first: list[Column] | None = None) -> DataFrame:
    """One row per key: any row, or the first in the given order.

    The rank filter runs within each input partition before the shuffle too, so a key with very many
    copies sends one row per partition and not all of them.
    """
    if not newest_first:
        return df.dropDuplicates(keys)
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def combine(base: DataFrame, new: DataFrame) -> DataFrame:
    """Base and new training rows below each other, columns matched by name."""
    return base.unionByName(new, allowMissingColumns=True)


def combine_newest(base: DataFrame, new: DataFrame, key: str, newest_first: list[Column] | None = None) -> DataFrame:
    """One whole row per key of base and new rows: new ones win, then the given order, then a hash of the row.

    Features and labels that are projected from the result come from the same row, and from the same one each time.
    """
    tagged = combine(base.withColumn("_batch", F.lit(0)), new.withColumn("_batch", F.lit(1)))
    columns = [c for c in tagged.columns if c != "_batch"]
    order = [F.desc("_batch"), *(newest_first or []), F.xxhash64(*columns), *[F.col(c) for c in columns]]
    return dedupe(tagged, [key], order).drop("_batch")


def exclude_keys(df: DataFrame, held_out: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not held out."""
    return df.join(held_out.select(key), key, "left_anti")


def prepare(df: DataFrame, config: Config, keep_key: bool = False) -> DataFrame:
    """Features with the right types and, if the table has the target, `label` 0/1.

    Columns that are neither configured nor key or target pass through, as only the encoder selects.
    """
    names = [c for c in df.columns if c != config.target and (keep_key or c != config.key)]
    columns = [F.col(c).cast("string").alias(c) if c in config.as_string else F.col(c) for c in names]
    if config.target in df.columns:
        columns.append(is_positive(F.col(config.target), config.positive).cast("int").alias(LABEL))
    return df.select(*columns)


class TableEncoder(Estimator):
    """Median-imputed, standardised numbers and one-hot categories as one feature vector.

    `fit` returns a PipelineModel of built-in stages that carry the fitted constants, so it can be saved
    and scores any table alike. Medians are exact and the deviation is that of the population.
    """

    def __init__(self, config: Config):
        super().__init__()
        self.config = config

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        numeric, categorical = list(self.config.numeric), list(self.config.categorical)
        constants = fit_numbers(dataset, numeric)

        parts = [number_expression(c, *constants[c]) + f" AS `{c}__num`" for c in numeric]
        parts += [f"coalesce(CAST(`{c}` AS STRING), '{UNKNOWN}') AS `{c}__cat`" for c in categorical]
        fill = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
        stages, frame = [fill], fill.transform(dataset)

        inputs = [f"{c}__num" for c in numeric]
        if categorical:
            _require_small(frame, categorical, self.config.most_categories)
            # the slot kept for unseen values is last, and the encoder drops it: unseen gives all zeros
            indexer = StringIndexer(
                inputCols=[f"{c}__cat" for c in categorical],
                outputCols=[f"{c}__idx" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ).fit(frame)
            encoder = OneHotEncoder(
                inputCols=[f"{c}__idx" for c in categorical],
                outputCols=[f"{c}__hot" for c in categorical],
                dropLast=True,
            ).fit(indexer.transform(frame))
            stages += [indexer, encoder]
            inputs += [f"{c}__hot" for c in categorical]
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
        scratch = [f"`{c}`" for c in inputs + [f"{c}__cat" for c in categorical] + [f"{c}__idx" for c in categorical]]
        stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(scratch)}) FROM __THIS__"))
        return PipelineModel(stages)


def _require_small(frame: DataFrame, categorical: list[str], most: int) -> None:
    """Refuse dictionaries that the driver should not hold; the estimate is within a few percent."""
    sizes = frame.agg(*[F.approx_count_distinct(f"{c}__cat").alias(c) for c in categorical]).first()
    large = [c for c in categorical if sizes[c] > most]
    if large:
        raise ValueError(f"{', '.join(large)}: more than {most} categories (most_categories); use WideEncoder, which stores its dictionary")


def fit_numbers(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float, float]]:
    """Median, and mean and population deviation after imputing it, for every column.

    A column without any value is imputed with zero; a deviation of zero is replaced by one.
    """
    if not columns:
        return {}
    numbers = df.select(*[to_number(df, c).alias(c) for c in columns])
    medians = {c: 0.0 if m is None else m for c, m in column_medians(numbers, columns).items()}
    filled = {c: F.coalesce(F.col(c), F.lit(medians[c])) for c in columns}
    row = numbers.agg(
        *[F.avg(filled[c]).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(filled[c]).alias(f"std_{c}") for c in columns],
    ).first()
    return {c: (medians[c], row[f"mean_{c}"] or 0.0, row[f"std_{c}"] or 1.0) for c in columns}


def number_expression(column: str, median: float, mean: float, std: float) -> str:
    # the same rule as `to_number`: blanks are trimmed, and the suffixes d and f are no part of a number
    text = f"trim(CAST(`{column}` AS STRING))"
    value = f"CASE WHEN NOT {text} RLIKE '(?i)[0-9.][df]$' THEN try_cast({text} AS DOUBLE) END"
    filled = f"CASE WHEN {value} IS NULL OR isnan({value}) THEN {number_literal(median)} ELSE {value} END"
    return f"({filled} - {number_literal(mean)}) / {number_literal(std)}"


def feature_names(encoder: PipelineModel, config: Config) -> list[str]:
    """Names of the vector's positions: number columns, then `column=category`."""
    names = list(config.numeric)
    for stage in encoder.stages:
        if isinstance(stage, StringIndexerModel):
            for column, labels in zip(config.categorical, stage.labelsArray):
                names += [f"{column}={label}" for label in labels]
    return names


def encoded_columns(df: DataFrame, encoder: PipelineModel, config: Config, *keep: str) -> DataFrame:
    """The encoded vector as one column per position, for reading."""
    values = vector_to_array(F.col(FEATURES))
    rows = encoder.transform(df).select(*keep, values.alias("_v"))
    names = feature_names(encoder, config)
    return rows.select(*keep, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])


def dummy_columns(df: DataFrame, columns: list[str], most: int = 10_000) -> DataFrame:
    """0/1 columns `column_value` in place of each column, the first value left out; null gives zeros.

    The result has a column per value, so the values are brought to the driver. A column with more than `most` values is
    refused; `WideEncoder` takes it.
    """
    out = [F.col(c) for c in df.columns if c not in columns]
    for c in columns:
        found = df.select(c).where(F.col(c).isNotNull()).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{c} has more than {most} values, too many for a column each; use WideEncoder")
        for value in sorted(row[0] for row in found)[1:]:
            out.append(F.col(c).eqNullSafe(F.lit(value)).cast("int").alias(f"{c}_{value}"))
    return df.select(*out)


def category_positions(df: DataFrame, column: str) -> DataFrame:
    """Dictionary of a column as a table: each value, as text with null as `UNKNOWN`, and its position from 0 in order.

    Values are dealt to sorted ranges and numbered within each, so a dictionary of any size is spread over the tasks.
    """
    values = df.select(F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN)).alias("category")).distinct()
    placed = cut_lineage(values.repartitionByRange("category").withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sums = placed.groupBy("_range").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("category")) - 1
    return placed.withColumn("_place", within).join(sums, "_range").select("category", (F.col("before") + F.col("_place")).alias("position"))


def positions_of(df: DataFrame, column: str, positions: DataFrame, name: str = "position") -> DataFrame:
    """`df` with the position of each row's value; null for a value that the dictionary lacks."""
    known = positions.select(F.col("category").alias("_category"), F.col("position").alias(name))
    value = F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
    return df.join(known, value == F.col("_category"), "left").drop("_category")
