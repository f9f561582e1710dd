import pytest
from pyspark.errors import ArithmeticException, NumberFormatException, PySparkException

from medallion.operators.clean import cast_columns, derive_columns, drop_columns, project, split_target


@pytest.fixture(scope="module")
def cars(spark):
    rows = [("a", "12", 2010, 1000.0), ("b", "x", 2024, 50.0), ("c", "2.9", None, None), ("d", " -7 ", 2020, float("nan"))]
    return spark.createDataFrame(rows, "Model string, Doors string, Mfg_Year int, cc double")


def test_permissive_cast_gives_null(cars):
    out = cast_columns(cars, {"doors": "int", "CC": "int"})
    assert out.columns == ["Model", "Doors", "Mfg_Year", "cc"]
    assert [(r.Doors, r.cc) for r in out.collect()] == [(12, 1000), (None, 50), (2, None), (-7, None)]


def test_strict_cast_raises(cars):
    with pytest.raises(NumberFormatException):
        cast_columns(cars, {"Doors": "int"}, "strict").collect()
    with pytest.raises(ArithmeticException):
        cast_columns(cars, {"cc": "int"}, "strict").collect()


def test_cast_of_a_missing_column_raises(cars):
    for mode in ("permissive", "strict"):
        with pytest.raises(ValueError):
            cast_columns(cars, {"Gears": "int"}, mode)
    with pytest.raises(ValueError):
        cast_columns(cars, {"Doors": "int"}, "loose")


def test_derived_columns_build_on_each_other(cars):
    out = derive_columns(
        cars, {"Car_Age": "year({as_of}) - Mfg_Year", "Mileage": "try_divide(cc, Car_Age)"}, as_of="2024-05-01"
    )
    assert [(r.Car_Age, r.Mileage) for r in out.collect()][:3] == [(14, 1000.0 / 14), (0, None), (None, None)]


def test_division_by_zero_raises_unless_guarded(cars):
    with pytest.raises(ArithmeticException):
        derive_columns(cars, {"m": "cc / (Mfg_Year - 2024)"}).collect()


def test_bad_expression(cars):
    with pytest.raises(PySparkException):
        derive_columns(cars, {"x": "no_such + 1"})
    assert derive_columns(cars, {"x": "no_such + 1", "y": "(", "z": "cc * 2"}, on_error="skip").columns == [*cars.columns, "z"]


def test_drop_ignores_missing_names(cars):
    assert drop_columns(cars, ["Doors", "Cylinders"]).columns == ["Model", "Mfg_Year", "cc"]
    assert drop_columns(cars, None) is cars


def test_project_and_split(cars):
    assert project(cars, ["CC", "Model"]).columns == ["cc", "Model"]
    assert split_target(cars, "CC") == (["Model", "Doors", "Mfg_Year"], "cc")


def test_awkward_names(spark):
    df = spark.createDataFrame([("1", 2)], ["a.b", "c d"])
    assert cast_columns(df, {"a.b": "int"}).first()[0] == 1
