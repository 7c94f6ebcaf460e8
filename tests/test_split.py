"""Split / fold properties: disjoint, covering, exact sizes, balanced folds."""

from pyspark.sql import functions as F

from autoprice.operators import split as S


def _ids(spark, n=1003):
    return spark.range(n).withColumnRenamed("id", "k")


def test_exact_split_sizes_and_cover(spark):
    d = S.split_random(_ids(spark), "k", 0.2, exact=True)
    c = dict(d.groupBy("split").count().collect())
    assert c["test"] == 201 and c["train"] == 802


def test_threshold_split_is_deterministic(spark):
    a = S.split_random(_ids(spark), "k", 0.3).where("split = 'test'")
    b = S.split_random(_ids(spark).repartition(7), "k", 0.3).where("split = 'test'")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_kfold_sizes_differ_by_at_most_one(spark):
    d = S.kfold_assign(_ids(spark), "k", 5)
    sizes = sorted(r["count"] for r in d.groupBy("fold").count().collect())
    assert sizes == [200, 200, 201, 201, 201]
    first = [r.fold for r in d.orderBy("k").limit(202).collect()]
    assert first[:201] == [0] * 201 and first[201] == 1


def test_kfold_small_input_fallback(spark):
    d = S.kfold_assign(_ids(spark, 7), "k", 5)
    assert d.select(F.countDistinct("fold")).first()[0] == 2


def test_time_ordered_segments(spark):
    d = S.split_time_ordered(_ids(spark, 100), "k")
    c = dict(d.groupBy("segment").count().collect())
    assert c == {"old": 60, "new_train": 28, "new_test": 12}


def test_stratified_folds_balanced_per_label(spark):
    df = spark.range(300).selectExpr("id as k", "case when id % 10 = 0 then 'a' else 'b' end as label")
    d = S.kfold_stratified(df, "k", "label", 3)
    for lab, n in (("a", 30), ("b", 270)):
        sizes = [r["count"] for r in d.where(F.col("label") == lab).groupBy("fold").count().collect()]
        assert sorted(sizes) == [n // 3] * 3


def test_guarded_split_rejects_tiny_input(spark):
    import pytest
    with pytest.raises(ValueError):
        S.split_small_guarded(_ids(spark, 3), "k")
