import pytest
from pyspark.errors import AnalysisException

from medallion import session
from medallion.session import scratch_dir
from medallion.sources.documents import message_stream, read_messages
from medallion.sources.relational import equal_slices, jdbc_options, read_sql, slice_predicates
from medallion.sources.sinks import preview, write_csv, write_delta, write_if_any, write_predictions, write_table
from medallion.sources.tables import from_pandas, load_data, read_csv, read_delta, read_table


def test_latin1_with_inferred_types(spark, tmp_path):
    (tmp_path / "cars.csv").write_bytes("Model,KM,Price\r\nCitroën,12,9.5\r\n\"a \"\"b\"\", c\",,1.0\r\n".encode("latin-1"))
    df = read_csv(spark, str(tmp_path / "cars.csv"))
    assert df.dtypes == [("Model", "string"), ("KM", "int"), ("Price", "double")]
    assert [tuple(r) for r in df.collect()] == [("Citroën", 12, 9.5), ('a "b", c', None, 1.0)]


def test_utf8_variant(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\né;1\n", encoding="utf-8")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "x.csv"), encoding="UTF-8", delimiter=";").collect()] == [("é", 1)]


def test_misfit_rows_raise(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, str(tmp_path / "x.csv"), schema="a INT, b STRING").collect()
    assert read_csv(spark, str(tmp_path / "x.csv"), multiline=True).first().b == "two\nlines"


def test_missing_object_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_csv(spark, str(tmp_path / "none.csv"))


def test_text_keeps_blanks_quotes_breaks_and_nulls(spark, tmp_path):
    rows = [(1, "  lead and trail  "), (2, 'say "hi", \\ok\\'), (3, "two\nlines"), (4, ""), (5, None), (6, "tab\there")]
    df = spark.createDataFrame(rows, "id int, t string")
    write_csv(df, str(tmp_path / "o"))
    back = read_csv(spark, str(tmp_path / "o"), encoding="UTF-8", multiline=True, schema="id INT, t STRING")
    # Empty text and null are the same thing in CSV.
    assert sorted(tuple(r) for r in back.collect()) == [(i, t or None) for i, t in rows]


def test_headerless_and_blank_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, t string").coalesce(1)
    write_csv(df, str(tmp_path / "o"), header=False, blank_empty=True)
    (part,) = (tmp_path / "o").glob("*.csv")
    assert part.read_text() == "1,\n2,\n"


def test_save_modes(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(3)
    write_table(df, path)
    with pytest.raises(AnalysisException):
        write_table(df, path, mode="error")
    write_table(df, path, mode="ignore")
    write_table(df, path, mode="append")
    assert load_data(spark, path, "parquet").count() == 6
    write_table(df, path, mode="overwrite")
    assert load_data(spark, path, "parquet").count() == 3
    with pytest.raises(ValueError):
        write_table(df, path, mode="merge")


def test_format_dispatch(spark, tmp_path):
    with pytest.raises(ValueError):
        load_data(spark, "x", "csv")
    with pytest.raises(ValueError):
        load_data(spark, "x", "parquet", version=3)
    # The Delta package is not on this classpath: the request must reach Spark's lookup.
    with pytest.raises(Exception, match="(?i)delta"):
        read_delta(spark, str(tmp_path))
    with pytest.raises(Exception, match="(?i)delta"):
        write_delta(spark.range(1), str(tmp_path / "d"))


@pytest.mark.parametrize("fmt", ["json", "orc", "parquet"])
def test_generic_formats(spark, tmp_path, fmt):
    write_table(spark.range(5), str(tmp_path / fmt), fmt)
    assert read_table(spark, str(tmp_path / fmt), fmt, schema="id BIGINT").count() == 5


def test_empty_input_writes_nothing(spark, tmp_path):
    path = tmp_path / "o"
    assert not write_if_any(spark.range(0), lambda df: write_csv(df, str(path)))
    assert not path.exists()
    assert write_if_any(spark.range(1), lambda df: write_csv(df, str(path))) and path.exists()


def test_predictions_directory(spark, tmp_path):
    path = write_predictions(spark.range(2), str(tmp_path), "2024-01-02_03-04-05")
    assert path.endswith("/predictions_2024-01-02_03-04-05") and spark.read.parquet(path).count() == 2
    assert preview(spark.read.parquet(path), 1).count() == 1


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "SELECT 1") == {"url": "jdbc:x", "fetchsize": "10000", "query": "SELECT 1"}
    sliced = jdbc_options("jdbc:x", "SELECT * FROM t", partition_column="id", bounds=(0, 9), num_partitions=3, user="u")
    assert sliced["dbtable"] == "(SELECT * FROM t) extracted" and "query" not in sliced
    assert (sliced["lowerBound"], sliced["upperBound"], sliced["numPartitions"], sliced["user"]) == ("0", "9", "3", "u")
    for bad in ({}, {"query": "a", "dbtable": "b"}, {"query": "a", "partition_column": "id"}):
        with pytest.raises(ValueError):
            jdbc_options("jdbc:x", **bad)


@pytest.mark.parametrize("keys", [
    "if(id % 3 = 0, NULL, id * id)", "if(id < 400, 7, id)", "cast(id as decimal(38,10)) / 7", "cast(NULL as bigint)", "9007199254740993 + id", "id * 1e-3", "5",
])
def test_equal_slices_are_disjoint_and_cover_everything(spark, keys):
    rows = spark.range(1000).selectExpr(f"{keys} AS k")
    predicates = slice_predicates("k", equal_slices(rows, "k", 8))
    hits = rows.selectExpr(*[f"coalesce({p}, false) AS p{i}" for i, p in enumerate(predicates)])
    names = [f"p{i}" for i in range(len(predicates))]
    found = hits.selectExpr(" + ".join(f"int({n})" for n in names) + " AS n", *names)
    assert found.where("n <> 1").count() == 0
    sizes = found.selectExpr(*[f"count_if({n})" for n in names]).first()
    if len(predicates) > 2 and "400" not in keys:
        assert max(sizes[:-1]) <= 2 * max(1, sum(sizes[:-1]) // 8)


def test_slice_predicates_of_other_types():
    assert slice_predicates("d", ["b", "it's"]) == ["d < 'b'", "d >= 'b' AND d < 'it''s'", "d >= 'it''s'", "d IS NULL"]
    assert slice_predicates("d", []) == ["d IS NOT NULL", "d IS NULL"]
    for bad in ([None], [True], [b"x"]):
        with pytest.raises(ValueError):
            slice_predicates("d", bad)
    with pytest.raises(ValueError):
        equal_slices(None, "d", 0)


def test_sql_over_frames(spark):
    assert read_sql(spark, "SELECT max(id) AS m FROM {t}", t=spark.range(4)).first().m == 3


def test_topics_reach_the_kafka_source(spark):
    # The Kafka package is not on this classpath: the request must reach Spark's lookup.
    for read in (read_messages, message_stream):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            read(spark, "host:9092", "topic")


def test_pandas_frame(spark):
    import pandas as pd

    df = from_pandas(spark, pd.DataFrame({"Name": ["Ann"], "Age": [30], "City": ["Rome"]}))
    assert [tuple(r) for r in df.collect()] == [("Ann", 30, "Rome")]


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "a")
    assert path != scratch_dir(spark, "a")
    assert root is None or path.startswith(f"{root}/a-")


def test_staged_rows_go_away(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda spark, name: str(tmp_path / name))
    with session.staged(spark.range(3), "rows") as rows:
        assert rows.count() == 3 and (tmp_path / "rows").exists()
    assert not (tmp_path / "rows").exists()
