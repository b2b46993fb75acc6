"""Small helpers of the operators: names, row keys, stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


#: Bytes of the batches that go to Python workers and come back; texts are long, so rows are no measure.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. For this session, it also bounds the batches that workers are sent by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` does not have, compared as Spark compares names."""
    held = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in held:
        name += "_"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: later steps start from the files, also after losses."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    held = df.sparkSession.read.schema(df.schema).parquet(path)
    held._scratch_path = path
    return held


def release(*frames: DataFrame) -> None:
    """Delete the files of frames that `stored` made, once all that is worked out from them is stored itself."""
    for frame in frames:
        context = frame.sparkSession._jsc
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame._scratch_path)
        path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a stored table by file split and place, the same at every reading of the same files.

    Small tables are split by the number of cores, which falls when an executor is lost; so that number is held fixed
    for the session, unless the session has one.
    """
    conf, cores = df.sparkSession.conf, "spark.sql.files.minPartitionNum"
    if conf.get(cores, None) is None:
        conf.set(cores, str(df.sparkSession.sparkContext.defaultParallelism))
    return df.withColumn(name, F.monotonically_increasing_id())
