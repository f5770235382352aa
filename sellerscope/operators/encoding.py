"""Category codes from a dictionary table.

A dictionary has one row (column, value, code) per distinct value: the code is the
value's rank in text order within its column. Values are combined before the shuffle;
beyond TARGET_ROWS_PER_BUCKET of them they are parted into ranges of (column, value),
ranked inside each range, and shifted by the rows of the ranges before it, so no task
and no driver ever holds all of a large column's values.
Encoding is a join. ``DictionaryEncoder`` makes it a pipeline stage whose model is
saved with the table.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerscope.operators.ranking import TARGET_ROWS_PER_BUCKET, materialize
from sellerscope.operators.scalars import attach_scalars

SCHEMA = "column string, value string, code long"


def build_dictionary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code) of the distinct non-null values of ``columns``, as text.

    Written once below the checkpoint folder: the ranges that rank the values must
    not be drawn again when the table is read."""
    from sellerscope.session import scratch_path
    spark = df.sparkSession
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    distinct = (df.select(F.explode(cells).alias("x")).select("x.*").filter(F.col("value").isNotNull())
                .groupBy("column", "value").agg(F.lit(1).alias("_one")).drop("_one"))
    distinct = materialize(distinct)
    most = distinct.groupBy("column").count().agg(F.max("count")).first()[0] or 0
    ranged = distinct.withColumn("part", F.lit(0))
    if most > TARGET_ROWS_PER_BUCKET:
        # more values than one window should order: ranges of them, drawn once and written
        path = scratch_path(spark, "dictionary_ranges")
        distinct.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()).write.parquet(path)
        ranged = spark.read.parquet(path)
    # rows of earlier ranges of the same column: one row per column and range
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n"))
               .select("column", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = F.row_number().over(Window.partitionBy("column", "part").orderBy("value"))
    coded = (ranged.withColumn("i", inside).join(offsets, ["column", "part"])
             if most > TARGET_ROWS_PER_BUCKET else ranged.withColumn("i", inside).withColumn("offset", F.lit(0)))
    coded = (coded.select("column", "value", (F.col("offset") + F.col("i") - 1).alias("code")))
    path = scratch_path(spark, "dictionary")
    coded.write.parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def encode(df: DataFrame, dictionary: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with one code column (double) per ``columns`` entry {input: output};
    a value the dictionary lacks, and NULL, get the extra code after the last one."""
    sizes = dictionary.agg(*[F.count(F.when(F.col("column") == c, True)).alias(f"_n_{c}") for c in columns])
    out = attach_scalars(df, sizes)
    for c, name in columns.items():
        own = dictionary.filter(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_k_{c}"))
        out = out.join(own, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
        out = out.withColumn(name, F.coalesce(F.col(f"_k_{c}"), F.col(f"_n_{c}")).cast("double"))
    return out.drop(*[f"_{x}_{c}" for c in columns for x in "nvk"])


class DictionaryEncoder(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the dictionary of ``inputCols``; the model writes codes to ``outputCols``."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> DictionaryEncoderModel:
        return self._copyValues(DictionaryEncoderModel(build_dictionary(dataset, self.getInputCols())))


class DictionaryEncoderModel(Model, HasInputCols, HasOutputCols, MLReadable, MLWritable):
    """Encodes by a join with its dictionary, which is saved as a table beside the parameters."""

    def __init__(self, dictionary: DataFrame | None = None):
        super().__init__()
        self.dictionary = dictionary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return encode(dataset, self.dictionary, dict(zip(self.getInputCols(), self.getOutputCols())))

    def write(self) -> MLWriter:
        return _DictionaryWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _DictionaryReader()


class _DictionaryWriter(MLWriter):
    def __init__(self, model: DictionaryEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.dictionary.write.parquet(path + "/dictionary")


class _DictionaryReader(MLReader):
    def load(self, path: str) -> DictionaryEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = DictionaryEncoderModel(self.sparkSession.read.schema(SCHEMA).parquet(path + "/dictionary"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
