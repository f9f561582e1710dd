import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from medallion.operators.features import (
    MedianImputer,
    ModeImputer,
    NumericScaler,
    build_preprocessor,
    check_cardinality,
    feature_columns,
    hash_split,
    most_frequent,
)


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, 1.0, "b", 10.0), (2, 4.0, "a", 20.0), (3, None, None, 30.0), (4, float("nan"), "a", 40.0), (5, 7.0, "b", 50.0)]
    return spark.createDataFrame(rows, "n int, x double, c string, y double")


def test_feature_columns_leave_the_target_out(small):
    assert feature_columns(small, "Y") == (["n", "x"], ["c"])
    assert feature_columns(small, "c", ["N"]) == (["x", "y"], [])


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    parts = [hash_split(d, key=["id"]) for d in (df, df.repartition(7), df.orderBy(F.desc("id")))]
    tests = [{r.id for r in test.collect()} for _, test in parts]
    assert tests[0] == tests[1] == tests[2]
    trains = {r.id for r in parts[0][0].collect()}
    assert trains | tests[0] == set(range(5000)) and not trains & tests[0]
    assert 800 < len(tests[0]) < 1200
    assert {r.id for r in hash_split(df, seed=7, key=["id"])[1].collect()} != tests[0]


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 997])
def test_exact_split_size(spark, n):
    train, test = hash_split(spark.range(n), key=["id"], exact=True)
    assert test.count() == math.ceil(0.2 * n) and train.count() == n - math.ceil(0.2 * n)


def test_split_without_a_key_uses_the_whole_row(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (2, None)] * 50, "a int, b string")
    train, test = hash_split(df)
    assert train.count() + test.count() == 150
    assert not {tuple(r) for r in train.collect()} & {tuple(r) for r in test.collect()}


def test_split_puts_null_keys_somewhere(spark):
    df = spark.createDataFrame([(None,), (1,)], "id int")
    train, test = hash_split(df, key=["id"])
    assert train.count() + test.count() == 2


def test_median_is_interpolated(small):
    model = MedianImputer(inputCols=["x", "n"], outputCols=["xf", "nf"]).fit(small)
    assert [r.xf for r in model.transform(small).orderBy("n").collect()] == [1.0, 4.0, 4.0, 4.0, 7.0]
    pair = small.where("n <= 2")
    assert MedianImputer(inputCols=["x"], outputCols=["xf"]).fit(pair).getOrDefault("medians") == [2.5]


def test_median_of_nothing_is_an_error(small):
    with pytest.raises(ValueError):
        MedianImputer(inputCols=["x"], outputCols=["f"]).fit(small.where("n = 3"))


def test_mode_takes_the_smallest_of_equals(small):
    assert most_frequent(small, ["c"]) == {"c": "a"}
    model = ModeImputer(inputCols=["c"], outputCols=["cf"]).fit(small)
    assert [r.cf for r in model.transform(small).orderBy("n").collect()] == ["b", "a", "a", "a", "b"]
    with pytest.raises(ValueError):
        ModeImputer(inputCols=["c"], outputCols=["f"]).fit(small.where("n = 3"))


def test_scaler_population_and_sample(small):
    for ddof, spread in ((0, math.sqrt(200)), (1, math.sqrt(250))):
        model = NumericScaler(inputCols=["y"], outputCols=["z"], ddof=ddof).fit(small)
        assert model.transform(small).agg(F.max("z")).first()[0] == pytest.approx(20 / spread)
    constant = small.withColumn("k", F.lit(3.0))
    assert NumericScaler(inputCols=["k"], outputCols=["z"]).fit(constant).transform(constant).first().z == 0.0


def features(model, df):
    return [r.v for r in model.transform(df).select(vector_to_array("features").alias("v")).collect()]


def test_preprocessor_end_to_end(small, spark, tmp_path):
    model = build_preprocessor(["x"], ["c"]).fit(small)
    spread = math.sqrt(((1 - 4) ** 2 + (7 - 4) ** 2) / 5)
    assert features(model, small.where("n = 1"))[0] == pytest.approx([-3 / spread, 0, 1])
    unseen = spark.createDataFrame([(9, None, "zzz", 0.0)], small.schema)
    assert features(model, unseen)[0] == pytest.approx([0, 0, 0])
    model.write().overwrite().save(str(tmp_path / "prep"))
    assert features(PipelineModel.load(str(tmp_path / "prep")), small) == features(model, small)


def test_unfitted_pipeline_can_be_stored(small, tmp_path):
    build_preprocessor(["x"], ["c"], ddof=1).write().overwrite().save(str(tmp_path / "p"))
    assert features(Pipeline.load(str(tmp_path / "p")).fit(small), small)


def test_whole_vector_scaling_and_approximate_median(small):
    model = build_preprocessor(["n", "x"], ["c"], scope="all", median="approx").fit(small)
    rows = features(model, small)
    for column in zip(*rows):
        assert sum(column) == pytest.approx(0, abs=1e-9)


def test_hashed_categories(small):
    rows = features(build_preprocessor(["x"], ["c"], encoding="hash", hash_features=16).fit(small), small)
    assert len(rows[0]) == 17 and sum(rows[0][1:]) == 1


def test_cardinality_is_checked(spark, small):
    check_cardinality(small, ["c"])
    many = spark.range(300).select(F.concat(F.lit("v"), "id").alias("c"))
    with pytest.raises(ValueError, match="too many categories"):
        check_cardinality(many, ["c"], limit=100)


def test_bad_choices(small):
    for bad in ({"scope": "some"}, {"encoding": "label"}):
        with pytest.raises(ValueError):
            build_preprocessor(["x"], [], **bad)
    with pytest.raises(ValueError):
        build_preprocessor([], [])
    with pytest.raises(ValueError):
        hash_split(small, 0)
