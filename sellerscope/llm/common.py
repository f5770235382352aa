"""Shared helpers: table reads, tables cut in the shared folder, components, ranks.

Tables that cut lineage are written below ``spark.checkpoint.dir``, the folder that
driver and executors share, and are read back: a lost executor then costs a re-read,
not a recomputation. The folder's owner clears it, as with any checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separators of words in the contracts
WHITE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a private folder is made only for a local master."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast ``value`` as bytes that hold its classes too: a plain broadcast names them, and executors need no copy of
    the library. ``shipped`` reads it in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast) -> object:
    return cloudpickle.loads(sent.value)


def unused(name: str) -> str:
    """A column name that no table has."""
    return f"_{name}_{uuid.uuid4().hex}"


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable from every id in ``edges`` (u, v).

    Alternating large-star and small-star rounds: each hangs a node's neighbours on
    the smallest of them, and the edge set ends as one star per component. A hub's
    edges are read in a join that AQE splits; nothing is gathered into one row.
    """
    cur = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              name)
    mark = None
    while True:
        both = cur.union(cur.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(least, F.col("u") == F.col("k"))
        cur = cut(small.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                                 F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                  .select("e.u", "e.v").where("u <> v").distinct(), name)
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    top = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).union(top)
