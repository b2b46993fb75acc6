"""Encode categories of any number of values: the dictionary is a stored table, and vectors are sparse.

`TableEncoder` keeps its dictionaries in the fitted model and so on the driver. Here the dictionary of all category
columns is one table of column, value and position in the vector, numbered by sorted ranges. The fitted stage holds
its name, the constants of the number columns and the length of the vector; rows meet the table in joins, which Spark
broadcasts by its own size rules or shuffles, and whose repeated side it splits where a value is hot.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Config
from tidemark.functions.numeric import to_number
from tidemark.operators.features import FEATURES, UNKNOWN, fit_numbers, number_expression
from tidemark.operators.quantiles import in_ranges
from tidemark.sources.tables import read_table


def build_dictionary(df: DataFrame, columns: list[str], first: int = 0) -> DataFrame:
    """`ordinal` of the column, `category` (as text, null as `UNKNOWN`) and `position`, counted on from `first`.

    Values stand in order of column and text. Each sorted range of them is numbered on its own, beginning after the
    number of values in the ranges before.
    """
    pairs = [F.struct(F.lit(i).alias("ordinal"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("category")) for i, c in enumerate(columns)]
    placed = in_ranges(df.select(F.inline(F.array(*pairs))).distinct(), ["ordinal"], "category")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    sums = placed.groupBy("_range").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("_range").orderBy("ordinal", "category")) - 1
    numbered = placed.withColumn("_place", within).join(sums, "_range")
    return numbered.select("ordinal", "category", (F.lit(first) + F.col("before") + F.col("_place")).cast("int").alias("position"))


class _Named(Params):
    dictionary = Param(Params._dummy(), "dictionary", "table or folder of the stored dictionary", TypeConverters.toString)
    numeric = Param(Params._dummy(), "numeric", "number columns", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)
    constants = Param(Params._dummy(), "constants", "median, mean and deviation of each number column", TypeConverters.toListFloat)
    length = Param(Params._dummy(), "length", "length of the vector", TypeConverters.toInt)


#: Types whose way over text and back, which `number_expression` goes, changes no value.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType)


def _number(df: DataFrame, column: str, median: float, mean: float, std: float) -> Column:
    """Imputed and standardised as by `number_expression`; columns that hold numbers are not made text for it."""
    if not isinstance(df.schema[column].dataType, _EXACT):
        return F.expr(number_expression(column, median, mean, std))
    return (F.coalesce(to_number(df, column), F.lit(median)) - F.lit(mean)) / F.lit(std)


class WideEncoderModel(Model, _Named, DefaultParamsReadable, DefaultParamsWritable):
    """Imputed, standardised numbers and one-hot categories as one sparse vector; an unseen category is all zeros.

    A saved model names its dictionary, which has to stay where it is.
    """

    @keyword_only
    def __init__(self, *, dictionary=None, numeric=None, categorical=None, constants=None, length=None):
        super().__init__()
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric, categorical = self.getOrDefault("numeric"), self.getOrDefault("categorical")
        figures = self.getOrDefault("constants")
        known = read_table(dataset.sparkSession, self.getOrDefault("dictionary"))
        rows = dataset
        for i, column in enumerate(categorical):
            own = known.where(F.col("ordinal") == i).select(F.col("category").alias("_category"), F.col("position").alias(f"_position{i}"))
            value = F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))
            rows = rows.join(own, value == F.col("_category"), "left").drop("_category")
        numbers = [_number(dataset, c, *figures[3 * i : 3 * i + 3]) for i, c in enumerate(numeric)]
        positions = [F.col(f"_position{i}") for i in range(len(categorical))]
        # columns have rising positions, so those found are in order
        found = F.filter(F.array(*positions), lambda p: p.isNotNull()) if positions else F.array().cast("array<int>")
        places = F.concat(F.array(*[F.lit(i) for i in range(len(numeric))]).cast("array<int>"), found)
        values = F.concat(F.array(*numbers).cast("array<double>"), F.array_repeat(F.lit(1.0), F.size(found)))
        vector = F.struct(F.lit(0).alias("type"), F.lit(self.getOrDefault("length")).alias("size"), places.alias("indices"), values.alias("values"))
        # the one way from a struct to a vector that stays in the engine
        shape = T.StructType([T.StructField(FEATURES, VectorUDT())])
        text = F.to_json(F.struct(vector.alias(FEATURES)))
        return rows.withColumn(FEATURES, F.from_json(text, shape)[FEATURES]).drop(*[f"_position{i}" for i in range(len(categorical))])


class WideEncoder(Estimator):
    """Fits medians, means and deviations, and stores the dictionary under `dictionary` (a table, or a folder if the
    name holds a slash), which must not be there yet."""

    def __init__(self, config: Config, dictionary: str):
        super().__init__()
        self.config, self.dictionary = config, dictionary

    def _fit(self, dataset: DataFrame) -> WideEncoderModel:
        numeric, categorical = list(self.config.numeric), list(self.config.categorical)
        figures = fit_numbers(dataset, numeric)
        length = len(numeric)
        if categorical:
            writer = build_dictionary(dataset, categorical, length).write
            writer.parquet(self.dictionary) if "/" in self.dictionary else writer.format("parquet").saveAsTable(self.dictionary)
            length += read_table(dataset.sparkSession, self.dictionary).count()
        if length >= 1 << 31:
            raise ValueError(f"{length} positions are more than a vector has")
        return WideEncoderModel(
            dictionary=self.dictionary, numeric=numeric, categorical=categorical, constants=[x for c in numeric for x in figures[c]], length=length
        )


def wide_names(spark: SparkSession, model: WideEncoderModel) -> DataFrame:
    """`position` and `name` of the vector's places: number columns, then `column=category`."""
    numeric, categorical = model.getOrDefault("numeric"), model.getOrDefault("categorical")
    names = spark.createDataFrame(list(enumerate(numeric)), "position int, name string")
    if not categorical:
        return names
    column = F.element_at(F.array(*[F.lit(c) for c in categorical]), F.col("ordinal") + 1)
    return names.unionByName(read_table(spark, model.getOrDefault("dictionary")).select("position", F.concat(column, F.lit("="), "category").alias("name")))
