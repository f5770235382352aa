import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from sellerscope.llm import exact_dedup, near_dedup, quality

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_names_and_text_ids(spark, docs):
    named = docs
    for c in ("_kept_id", "_out", "_rows", "_rank", "_kept", "kept_id"):
        named = named.withColumn(c, F.lit(1))
    ids = lambda df: sorted(str(r.doc_id) for r in df.select("doc_id").collect())
    assert ids(exact_dedup.drop_exact_copies(named)) == ids(exact_dedup.drop_exact_copies(docs))
    assert ids(near_dedup.drop_near_copies(named)) == ids(near_dedup.drop_near_copies(docs))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    assert ids(quality.drop_low_quality(named, labels)) == ids(quality.drop_low_quality(docs, labels))
    texts = spark.createDataFrame([("b", "x y"), ("a", "xy"), ("c", "x  y"), (None, "x  y"), ("10", "q"), ("9", "q")], "doc_id string, text string")
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_groups(texts).collect()}
    assert got == {("a", "c", 4), ("b", "c", 4), ("c", "c", 4), (None, "c", 4), ("10", "10", 2), ("9", "10", 2)}


def test_workers_need_no_library():
    """op1, op4 and op8 with the library on the driver's path alone."""
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark.sql import SparkSession, functions as F
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
        from sellerscope.llm import classlm, langid, licenses
        docs = spark.createDataFrame([(i, f"some words of text {{i}} here", "en" if i % 2 else "de") for i in range(12)], "doc_id long, text string, lang string")
        print(langid.identify(docs, langid.fit(docs, F.lit(True))).count(), classlm.score(docs, F.lit(True)).count(),
              licenses.scan(docs, licenses.fit(docs)).count())
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd="/tmp", env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.split() == ["12", "12", "12"], out.stderr[-2000:]
