"""Casts, derived columns, fences, outlier treatments and the transformation job."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from medallion.functions.columns import run_stamp
from medallion.operators.clean import cast_columns, derive_columns, drop_columns, project
from medallion.operators.features import feature_columns, hash_split
from medallion.operators.ordering import approx_quantiles, exact_quantiles, order_statistics
from medallion.operators.outliers import fences_from_frame, fences_to_frame, fit_fences, flag_outliers, treat_outliers
from medallion.operators.sketches import merge_sketches, read_sketches, sketched_fences, store_sketches
from medallion.plans.config import TransformConfig
from medallion.plans.jobs import transform
from medallion.session import scratch_dir
from workload import query, table

AS_OF = "2024-06-30"
FENCE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

#: Allowed rank error of merged sketches.
SKETCH_ERROR = 0.01

# Quartile fences of events.value as a one-row table.
EVENT_FENCES = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, median(value) AS q2, quantile_cont(value, 0.75) AS q3 FROM events),
f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, q2 FROM q)
"""


@query("""
SELECT c_custkey, TRY_CAST(split_part(c_name, '#', 2) AS INTEGER) AS serial,
       TRY_CAST(c_mktsegment AS INTEGER) AS segment, CAST(trunc(c_acctbal) AS INTEGER) AS balance
FROM customer
""")
def cast_permissive(spark, sf_dir):
    raw = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.substring_index("c_name", "#", -1).alias("serial"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("string").alias("balance"),
    )
    return cast_columns(raw, {"SERIAL": "int", "segment": "int", "balance": "int"})


@query("""
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice
FROM lineitem
""")
def cast_strict(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return cast_columns(lines, {"l_quantity": "int", "l_extendedprice": "int"}, mode="strict")


@query("""
SELECT l_orderkey, l_linenumber, net, net / l_quantity AS unit_net,
       CASE WHEN l_tax = 0 THEN NULL ELSE net / l_tax END AS per_tax
FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem)
""")
def derive_chain(spark, sf_dir):
    derived = derive_columns(
        table(spark, sf_dir, "lineitem"),
        {
            "net": "l_extendedprice * (1 - l_discount)",
            "unit_net": "try_divide(net, l_quantity)",
            "per_tax": "try_divide(net, l_tax)",
        },
    )
    return project(derived, ["l_orderkey", "l_linenumber", "net", "unit_net", "per_tax"])


@query("""
SELECT o_orderkey, CAST(2024 - year(o_orderdate) AS INTEGER) AS order_age,
       strftime(o_orderdate, '%d-%m-%y') AS stamp
FROM orders
""")
def derive_age(spark, sf_dir):
    aged = derive_columns(table(spark, sf_dir, "orders"), {"order_age": "year({as_of}) - year(o_orderdate)"}, as_of=AS_OF)
    return aged.select("o_orderkey", "order_age", run_stamp(F.col("o_orderdate")).alias("stamp"))


@query("SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def drop_listed(spark, sf_dir):
    return drop_columns(table(spark, sf_dir, "part"), ["p_name", "no_such_column"])


FEATURE_TARGETS = {"customer": "c_acctbal", "orders": "o_totalprice", "lineitem": "l_extendedprice", "part": "p_retailprice"}
FEATURE_KINDS = {
    "customer": {"c_custkey": "numeric", "c_nationkey": "numeric", "c_mktsegment": "text", "c_name": "text"},
    "orders": {"o_custkey": "numeric", "o_orderkey": "numeric", "o_orderpriority": "text", "o_orderstatus": "text"},
    "lineitem": {
        "l_discount": "numeric", "l_linenumber": "numeric", "l_orderkey": "numeric", "l_partkey": "numeric",
        "l_quantity": "numeric", "l_suppkey": "numeric", "l_tax": "numeric", "l_linestatus": "text", "l_returnflag": "text",
    },
    "part": {"p_partkey": "numeric", "p_size": "numeric", "p_brand": "text", "p_name": "text", "p_type": "text"},
}


@query(
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS source, '{c}' AS feature, '{k}' AS kind, count({c}) AS filled FROM {t}"
        for t, kinds in FEATURE_KINDS.items()
        for c, k in kinds.items()
    )
)
def feature_kinds(spark, sf_dir):
    """The features of four tables by kind, with their filled rows."""
    out = None
    for name, target in FEATURE_TARGETS.items():
        df = table(spark, sf_dir, name)
        numeric, text = feature_columns(df, target)
        kinds = {**dict.fromkeys(numeric, "numeric"), **dict.fromkeys(text, "text")}
        filled = df.agg(*[F.count(c).alias(c) for c in kinds])
        cells = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.lit(k).alias("kind"), F.col(c).alias("filled")) for c, k in kinds.items()]
        )
        rows = filled.select(F.lit(name).alias("source"), F.inline(cells))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(q1 - 1.5 * (q3 - q1), 6) AS lower, round(q3 + 1.5 * (q3 - q1), 6) AS upper,
        round(q2, 6) AS median
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""
        for c in FENCE_COLUMNS
    )
)
def iqr_fences(spark, sf_dir):
    fences = fit_fences(table(spark, sf_dir, "lineitem"), FENCE_COLUMNS, method="median")
    return fences_to_frame(spark, fences).select(
        "column", *[F.round(c, 6).alias(c) for c in ("lower", "upper", "median")]
    )


@query()
def approx_fences(spark, sf_dir):
    fences = fit_fences(table(spark, sf_dir, "lineitem"), FENCE_COLUMNS, quantiles="approx", method="median")
    return fences_to_frame(spark, fences).select("column", "lower", "upper", "median")


@query(
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, true AS first, true AS second, true AS third FROM lineitem""" for c in FENCE_COLUMNS
    )
)
def approx_quartiles(spark, sf_dir):
    """Whether each approximate quartile lies within 5 % of its rank."""
    lines, error, shares = table(spark, sf_dir, "lineitem"), 0.05, (0.25, 0.5, 0.75)
    found = approx_quantiles(lines, FENCE_COLUMNS, list(shares), error)

    def within(c, value, share):
        n = F.count(c)
        return (F.count_if(F.col(c) < value) <= n * (share + error)) & (F.count_if(F.col(c) <= value) >= n * (share - error))

    names = ("first", "second", "third")
    rows = [
        F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), *[within(c, v, s).alias(name) for name, v, s in zip(names, found[c], shares)])
        for c in FENCE_COLUMNS
    ]
    return lines.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query(EVENT_FENCES + "SELECT event_id, coalesce(value < lo OR value > hi, false) AS outlier_value FROM events, f")
def outlier_flags(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    fences = fit_fences(events, ["value"], method="cap")
    return flag_outliers(events, fences).drop("value")


@query(EVENT_FENCES + """
, e AS (SELECT min(value) AS low, max(value) AS high FROM events, f WHERE value BETWEEN lo AND hi)
SELECT event_id, CASE WHEN value < lo THEN low WHEN value > hi THEN high ELSE value END AS value FROM events, f, e
""")
def outlier_clamp(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    return treat_outliers(events, fit_fences(events, ["value"]), "clamp")


@query(EVENT_FENCES + """
SELECT event_id, round(CASE WHEN value < lo OR value > hi THEN q2 ELSE value END, 4) AS value FROM events, f
""")
def outlier_median(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    treated = treat_outliers(events, fit_fences(events, ["value"], method="median"), "median")
    return treated.select("event_id", F.round("value", 4).alias("value"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE greatest(50000.0::DOUBLE, least(400000.0::DOUBLE, o_totalprice)) END AS o_totalprice
FROM orders
""")
def outlier_cap(spark, sf_dir):
    """Fixed limits; every seventh price is made null to show that nulls stay null."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice")
    )
    fences = fit_fences(orders, ["o_totalprice"], bounds=(50_000.0, 400_000.0), method="cap")
    return treat_outliers(orders, fences, "cap")


def _sketched(name, condition):
    return f"""SELECT '{name}' AS stage, '{{c}}' AS "column", count({{c}}) AS n, min({{c}}) AS least, max({{c}}) AS greatest,
        true AS first, true AS second, true AS third FROM lineitem WHERE {condition}"""


@query(
    "\nUNION ALL ".join(
        text.format(c=c) for text in (_sketched("first", "l_orderkey % 3 <> 0"), _sketched("both", "true")) for c in FENCE_COLUMNS
    )
)
def sketched_fences_merge(spark, sf_dir):
    """Two deliveries, sketched as they come (the second twice): the quartiles behind the merged fences, tested against the ranks in all
    rows delivered so far. The fences are made from the stored sketches alone."""
    lines, path = table(spark, sf_dir, "lineitem"), scratch_dir(spark, "sketches")
    late = F.col("l_orderkey") % 3 == 0
    out = []
    for stage, deliveries, seen in (("first", {"1": lines.where(~late)}, lines.where(~late)), ("both", {"2": lines.where(late)}, lines)):
        for _ in range(2):
            for name, rows in deliveries.items():
                store_sketches(rows, FENCE_COLUMNS, path, name)
        sketches = read_sketches(spark, path)
        ends = {r["column"]: r for r in merge_sketches(sketches).select("column", "n", "least", "greatest").collect()}
        rows = []
        for fence in sketched_fences(sketches):
            c, spread = fence.column, (fence.upper - fence.lower) / 4
            quartiles = (fence.lower + 1.5 * spread, fence.median, fence.upper - 1.5 * spread)
            n = F.count(c)
            within = [
                (F.count_if(F.col(c) < q - 1e-6) <= n * (s + SKETCH_ERROR)) & (F.count_if(F.col(c) <= q + 1e-6) >= n * (s - SKETCH_ERROR))
                for q, s in zip(quartiles, (0.25, 0.5, 0.75))
            ]
            fixed = [F.lit(v).alias(k) for k, v in (("stage", stage), ("column", c), ("n", ends[c].n), ("least", ends[c].least), ("greatest", ends[c].greatest))]
            rows.append(F.struct(*fixed[:2], fixed[2].cast("long").alias("n"), *fixed[3:], *[w.alias(k) for w, k in zip(within, ("first", "second", "third"))]))
        out.append(seen.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))
    return out[0].unionByName(out[1])


@query(EVENT_FENCES + """
, w AS (SELECT event_id, value, lag(value) OVER (ORDER BY value, event_id) AS before,
               lead(value) OVER (ORDER BY value, event_id) AS after FROM events)
SELECT event_id, CASE WHEN value < lo OR value > hi THEN coalesce(before, after, value) ELSE value END AS value FROM w, f
""")
def outlier_neighbor(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "value")
    fences = fit_fences(events, ["value"], method="neighbor")
    return treat_outliers(events, fences, "neighbor", key=["event_id"])


ORDER_TEST = "('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT % 100 < 20"


@query(f"""
WITH s AS (SELECT o_orderkey, o_totalprice, {ORDER_TEST} AS test FROM orders),
q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM s WHERE NOT test),
f AS (SELECT q1 - 0.1 * (q3 - q1) AS lo, q3 + 0.1 * (q3 - q1) AS hi FROM q),
e AS (SELECT min(o_totalprice) AS low, max(o_totalprice) AS high FROM s, f WHERE NOT test AND o_totalprice BETWEEN lo AND hi)
SELECT o_orderkey, CASE WHEN o_totalprice < lo THEN low WHEN o_totalprice > hi THEN high ELSE o_totalprice END AS o_totalprice
FROM s, f, e WHERE test
""")
def scoring_fences(spark, sf_dir):
    """Fences fitted on the training rows, stored, and applied to the test rows."""
    train, test = hash_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), key=["o_orderkey"])
    quartiles = exact_quantiles(train, ["o_totalprice"], [0.25, 0.75])["o_totalprice"]
    margin = 0.1 * (quartiles[1] - quartiles[0])
    fences = fit_fences(train, ["o_totalprice"], bounds=(quartiles[0] - margin, quartiles[1] + margin))
    path = scratch_dir(spark, "fences")
    fences_to_frame(spark, fences).write.parquet(path)
    return treat_outliers(test, fences_from_frame(spark.read.parquet(path)))


_TYPED = {
    "huge": "l_orderkey * 1000003 + l_partkey + 9007199254740993",
    "signed": "CASE WHEN l_linenumber % 2 = 0 THEN 9223372036854775807 - l_orderkey ELSE l_orderkey - 9223372036854775807 END",
    "fine": "CAST(concat(CASE WHEN l_linenumber % 3 = 0 THEN '-' ELSE '' END, '99999999999999', lpad(CAST(l_orderkey AS VARCHAR(20)), 12, '0'), '.', lpad(CAST(l_partkey AS VARCHAR(20)), 12, '0')) AS DECIMAL(38,12))",
    "vast": "CAST(concat(CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '' END, '99999999999999999999999999', lpad(CAST(l_orderkey AS VARCHAR(20)), 12, '0')) AS DECIMAL(38,0))",
}
_TYPED_SHARES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


@query(
    "WITH t AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _TYPED.items()) + " FROM lineitem), "
    + "n AS (SELECT count(*) - 1 AS last FROM t), shares AS (SELECT unnest([" + ", ".join(map(str, _TYPED_SHARES)) + "]::DOUBLE[]) AS share) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, share, v::VARCHAR AS value FROM shares, n, (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) - 1 AS place FROM t) WHERE place = floor(share * last)::BIGINT"
        for c in _TYPED
    )
)
def typed_order(spark, sf_dir):
    """Values at given ranks of whole numbers above 2^53, of both signs up to the ends of their type, and of decimals of 38 digits."""
    rows = table(spark, sf_dir, "lineitem").select(*[F.expr(e).alias(c) for c, e in _TYPED.items()])
    found = order_statistics(rows, list(_TYPED), lambda n: {math.floor(p * (n - 1)) for p in _TYPED_SHARES})
    out = [(c, p, f"{values[math.floor(p * (n - 1))]:f}" if "DECIMAL" in _TYPED[c] else str(values[math.floor(p * (n - 1))])) for c, (n, values) in found.items() for p in _TYPED_SHARES]
    return spark.createDataFrame(out, "name string, share double, value string")


ETL = TransformConfig(
    source="lineitem",
    destination="silver",
    column_types_to_convert={"l_linenumber": "string", "l_quantity": "int"},
    feature_engineering_transformations={
        "net": "l_extendedprice * (1 - l_discount)",
        "unit_net": "try_divide(net, l_quantity)",
        "ship_age": "year({as_of}) - year(l_shipdate)",
    },
    columns_to_remove=["l_suppkey", "l_shipdate", "no_such_column"],
    numerical_columns_list=["l_quantity", "l_extendedprice", "net", "unit_net", "ship_age"],
    as_of=AS_OF,
)

_ETL_TREATED = ETL.numerical_columns_list


def _clamped(column):
    return (
        f"CASE WHEN {column} < {column}_lo THEN {column}_min WHEN {column} > {column}_hi THEN {column}_max "
        f"ELSE {column} END AS {column}"
    )


@query(
    """
WITH s AS (
  SELECT l_orderkey, l_partkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_extendedprice * (1 - l_discount) AS net,
         l_extendedprice * (1 - l_discount) / CAST(trunc(l_quantity) AS INTEGER) AS unit_net,
         CAST(2024 - year(l_shipdate) AS INTEGER) AS ship_age
  FROM lineitem),
q AS (SELECT """
    + ", ".join(f"quantile_cont({c}::DOUBLE, 0.25) AS {c}_q1, quantile_cont({c}::DOUBLE, 0.75) AS {c}_q3" for c in _ETL_TREATED)
    + " FROM s), f AS (SELECT "
    + ", ".join(f"{c}_q1 - 1.5 * ({c}_q3 - {c}_q1) AS {c}_lo, {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) AS {c}_hi" for c in _ETL_TREATED)
    + " FROM q), e AS (SELECT "
    + ", ".join(
        f"min({c}) FILTER ({c} BETWEEN {c}_lo AND {c}_hi) AS {c}_min, max({c}) FILTER ({c} BETWEEN {c}_lo AND {c}_hi) AS {c}_max"
        for c in _ETL_TREATED
    )
    + " FROM s, f) SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_tax, l_returnflag, l_linestatus, "
    + ", ".join(_clamped(c) for c in _ETL_TREATED)
    + " FROM s, f, e"
)
def etl_job(spark, sf_dir):
    """Cast, derive, drop and clamp: the transformation job on its whole table."""
    silver, _ = transform(table(spark, sf_dir, "lineitem"), ETL)
    return silver
