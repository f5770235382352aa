"""The dictionary table: codes in text order, by a join, saved with the pipeline."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sellerscope.operators import encoding
from sellerscope.operators import evaluation as EV
from sellerscope.plans import features as FE


@pytest.mark.parametrize("most", [1_000_000, 100])
def test_codes_of_many_values(spark, monkeypatch, most):
    """One range or several, no list of values anywhere: codes are the ranks in text order."""
    monkeypatch.setattr(encoding, "TARGET_ROWS_PER_BUCKET", most)
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("many"), (F.col("id") % 3).alias("few"),
                                    F.lit(None).cast("string").alias("none"))
    d = encoding.build_dictionary(df.union(df), ["many", "few", "none"])
    got = {(r.column, r.value): r.code for r in d.collect()}
    want = {("many", v): i for i, v in enumerate(sorted(r.many for r in df.select("many").collect()))}
    assert got == want | {("few", str(i)): i for i in range(3)}


def test_unseen_and_null_get_the_extra_code(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "c string")
    d = encoding.build_dictionary(df, ["c"])
    new = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    assert sorted((str(r.c), r.k) for r in encoding.encode(new, d, {"c": "k"}).collect()) == [("None", 2.0), ("a", 0.0), ("b", 1.0), ("zz", 2.0)]
    empty = encoding.build_dictionary(df.limit(0), ["c"])
    assert {r.k for r in encoding.encode(new, empty, {"c": "k"}).collect()} == {0.0}


def test_saved_with_the_pipeline(spark, tmp_path):
    cols = [*FE.CATEGORICALS, *FE.PRE_NUMERIC]
    df = spark.createDataFrame([("s1", *"abcdef", 1, 2, 3), ("s2", *"bbbbbb", None, 0, 1)], ["seller_id", *cols])
    model = FE.pre_activation_pipeline().fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert loaded.stages[1].dictionary.count() == model.stages[1].dictionary.count() > 6
    rows = lambda m: sorted(map(str, m.transform(df).select("seller_id", "features").collect()))
    assert rows(loaded) == rows(model)


def test_candidate_metrics(spark):
    rows = [("a", 1.0, .9), ("a", 0.0, .9), ("a", 1.0, .4), ("a", 0.0, .1), ("b", 1.0, .2), ("b", 0.0, .8), ("b", 1.0, .8), ("b", 0.0, None)]
    df = spark.createDataFrame(rows, "k string, y double, p double")
    got = {r.k: r for r in EV.candidate_metrics(df, "k", "y", "p").collect()}
    for k in "ab":
        own = df.filter((F.col("k") == k) & F.col("p").isNotNull())
        assert got[k].roc_auc == EV.roc_auc(own, "y", "p").first()[0]
        m = EV.binary_metrics(EV.with_prediction(own, "p"), "y").first()
        assert (got[k].accuracy, got[k].precision, got[k].recall, got[k].f1_score) == tuple(m)
