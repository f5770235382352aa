"""Table registry: name -> lazily read DataFrame.

``load_all`` checks that every registered file exists (raising like the
reference when one is missing) but scans nothing; Catalyst later prunes the
columns and pushes the filters of whatever query runs into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sellerscope.sources import schemas


CORRUPT = "_corrupt_record"


def _path_exists(spark: SparkSession, path: str) -> bool:
    """Existence probe through the Hadoop FileSystem (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str | None = None) -> DataFrame:
    """Read one extract; CSV with header, declared schema where known."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if schema is None:
            return reader.csv(path)
        # read as text and cast by name: extracts carry extra columns and a
        # column order we do not want to depend on
        raw = reader.csv(path)
        cols = []
        for f in schema.fields:
            if f.name in raw.columns:
                cols.append(_cast_text(F.col(f.name), f.dataType).alias(f.name))
        return raw.select(*cols)
    return spark.read.parquet(path)


def _cast_text(c, dtype):
    if isinstance(dtype, T.StringType):
        return c
    return c.try_cast(dtype)


def malformed_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(column, malformed, missing) of a CSV extract: values that do not parse as
    the declared type (they read as NULL), and whether the column is absent."""
    raw = spark.read.option("header", True).csv(path)
    counts = [F.struct(F.lit(f.name).alias("column"),
                       (F.count_if(F.col(f.name).isNotNull() & _cast_text(F.col(f.name), f.dataType).isNull())
                        if f.name in raw.columns else F.lit(0).cast("long")).alias("malformed"),
                       F.lit(f.name not in raw.columns).alias("missing")) for f in schema.fields]
    return raw.agg(F.array(*counts).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def quarantine(spark: SparkSession, path: str, schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined) rows of a CSV extract. A record whose number of values differs from
    the header's is malformed (the reader's corrupt-record column holds its text), and so
    is one with a value that does not parse as its declared type; quarantined rows are
    (record, reasons). Clean rows have the declared columns that exist."""
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    # every value is parsed, whatever the query selects: a record is malformed or not
    raw = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    declared = [f for f in (schema.fields if schema else []) if f.name in names]
    bad = [F.when(F.col(f.name).isNotNull() & _cast_text(F.col(f.name), f.dataType).isNull(), F.lit(f.name)) for f in declared]
    # the reader refuses a query that reads the corrupt-record column alone; this one names a value too
    malformed = F.col(CORRUPT).isNotNull() & (F.coalesce(F.length(names[0]), F.lit(0)) >= 0)
    reasons = F.when(malformed, F.array(F.lit("record"))).otherwise(
        F.array_compact(F.array(*bad, F.lit(None).cast("string"))))
    raw = raw.withColumn("_reasons", reasons)
    clean = raw.filter(F.size("_reasons") == 0)
    clean = clean.select(*[_cast_text(F.col(f.name), f.dataType).alias(f.name) for f in declared]) if schema else clean.select(*names)
    record = F.coalesce(F.col(CORRUPT), F.to_json(F.struct(*names)))
    return clean, raw.filter(F.size("_reasons") > 0).select(record.alias("record"), F.col("_reasons").alias("reasons"))


def safe_read(spark: SparkSession, path: str, schema: T.StructType | None = None,
              fmt: str | None = None) -> DataFrame:
    """Read when present, else an empty table of the declared schema."""
    if _path_exists(spark, path):
        return read_table(spark, path, schema, fmt)
    return spark.createDataFrame([], schema or T.StructType([]))


class TableRegistry:
    """Named extracts below one folder (``<stem>.csv`` or ``<stem>.parquet``)."""

    def __init__(self, spark: SparkSession, data_path: str, fmt: str = "csv",
                 tables: dict | None = None):
        self.spark = spark
        self.data_path = data_path
        self.fmt = fmt
        self.tables = tables or schemas.TABLES
        self.data: dict[str, DataFrame] = {}
        self.quarantined: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        stem = self.tables[name][0]
        return os.path.join(self.data_path, f"{stem}.{self.fmt}")

    def load_all(self, set_aside: bool = False) -> dict[str, DataFrame]:
        """Every table; with ``set_aside`` malformed CSV records go to ``quarantined``
        instead of being read with NULLs."""
        for name, (_, schema) in self.tables.items():
            p = self.path(name)
            if not _path_exists(self.spark, p):
                raise FileNotFoundError(p)
            if set_aside and self.fmt == "csv":
                self.data[name], self.quarantined[name] = quarantine(self.spark, p, schema)
            else:
                self.data[name] = read_table(self.spark, p, schema, self.fmt)
        return self.data


def parse_dates(data: dict[str, DataFrame], date_columns: dict | None = None) -> dict[str, DataFrame]:
    """Cast the listed date columns to timestamp_ntz where present.

    Text that does not parse becomes NULL; no session time zone takes part.
    """
    date_columns = date_columns or schemas.DATE_COLUMNS
    out = dict(data)
    for table, cols in date_columns.items():
        if table not in out:
            continue
        df = out[table]
        changes = {}
        for c in cols:
            if c in df.columns:
                dtype = df.schema[c].dataType
                if isinstance(dtype, T.StringType):
                    changes[c] = F.col(c).try_cast("timestamp_ntz")
                elif not isinstance(dtype, T.TimestampNTZType):
                    changes[c] = F.col(c).cast("timestamp_ntz")
        if changes:
            df = df.withColumns(changes)
        out[table] = df
    return out


def row_counts(data: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for every table: one counting job per table,
    unioned so the driver sees a single small result."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in data.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
