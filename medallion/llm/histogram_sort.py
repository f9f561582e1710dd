"""Sharding by histogram sort, in DataFrame operations only.

Rows are ordered by (hash of the text, id, a running number). Exact bytes below candidate boundaries are counted over all
partitions by one aggregate; every range between two neighbouring boundaries that still holds more than the tolerance
gets new probes between its smallest and largest key and is counted again, on the next part of the key where one value
fills it. When no range is above the tolerance, shards are runs of ranges with nearly equal bytes, and the rows are
exchanged once, by range.

Equal texts have one hash and so stay next to each other, in one shard unless their group alone is above the
tolerance and spans a boundary: then it is split by id, never dropped. The driver holds the ranges and their
counts only: at most ``shards / tolerance`` of them (or one for each GiB) are probed in a round, whatever the number of rows.

Nulls and edges: a null text counts as one byte and has the hash of the empty key; null ids come first; rows equal in
text and id are told apart by a running number, fixed by writing the keys to the shared folder before counting; an
empty table gives an empty result; all other columns pass through, whatever their names.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from medallion.llm.common import saved

KEY = ("__k0", "__k1", "__k2")
SIZE, NODE = "__size", "__node"


@dataclass(frozen=True)
class ShardSpec:
    shards: int = 8
    #: A range is probed again while it holds more than this share of a shard.
    tolerance: float = 0.01
    #: Nor does a range hold more bytes than this, so that one task can order it.
    range_bytes: int = 1 << 30
    first_probes: int = 4096
    probes: int = 64


@dataclass
class Range:
    """Rows between two probes: counts, and smallest and largest value of each part of the key."""

    path: tuple[int, ...]
    size: int
    rows: int
    low: list[int]
    high: list[int]
    shard: int = 0
    before: int = 0


@dataclass
class Plan:
    """The probes of each round and the final ranges in order."""

    rounds: list[list[tuple[int, int, int, int, int]]] = field(default_factory=list)  # node, part, low, step, first child
    leaves: dict[int, Range] = field(default_factory=dict)


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with key parts and size in bytes (a null text: none) plus 1."""
    running = F.monotonically_increasing_id()
    return docs.withColumns({
        KEY[0]: F.shiftrightunsigned(F.xxhash64(F.col("text")), 1),
        KEY[1]: F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
        KEY[2]: running,
        SIZE: F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1,
    })


def _probe(rows: DataFrame, probes: list[tuple[int, int, int, int, int]], width: int, how: str = "left") -> DataFrame:
    """Move rows of probed ranges to the child between their two probes; children are numbered from ``first``."""
    if len(probes) == 1 and probes[0][0] == 0:  # all rows are in the first range
        table = None
        found = dict(zip(("__part", "__low", "__step", "__first"), map(F.lit, probes[0][1:])))
        rows = rows.withColumns(found)
    else:
        table = rows.sparkSession.createDataFrame(probes, f"{NODE} long, __part int, __low long, __step long, __first long")
    part = F.when(F.col("__part") == 0, F.col(KEY[0])).when(F.col("__part") == 1, F.col(KEY[1])).otherwise(F.col(KEY[2]))
    child = F.floor((part.cast("decimal(20,0)") - F.col("__low").cast("decimal(20,0)")) / F.col("__step").cast("decimal(20,0)")).cast("long")
    out = rows if table is None else rows.join(F.broadcast(table), NODE, how)
    return out.withColumn(NODE, F.coalesce(F.col("__first") + F.least(child, F.lit(width - 1)), F.col(NODE))).drop("__part", "__low", "__step", "__first")


def _count(rows: DataFrame) -> dict[int, Range]:
    ends = [f(k).alias(f"{n}{i}") for i, k in enumerate(KEY) for n, f in (("lo", F.min), ("hi", F.max))]
    found = rows.groupBy(NODE).agg(F.sum(SIZE).alias("size"), F.count("*").alias("rows"), *ends).collect()
    return {r[NODE]: Range((), r["size"], r["rows"], [r[f"lo{i}"] for i in range(3)], [r[f"hi{i}"] for i in range(3)]) for r in found}


def find_splitters(keys: DataFrame, spec: ShardSpec) -> Plan:
    """Refine probes until every range is within the tolerance or is a single row, then deal ranges to shards."""
    plan = Plan()
    rows = keys.withColumn(NODE, F.lit(0).cast("long"))
    live = _count(rows)
    if not live:
        return plan
    total = live[0].size
    limit = max(1, min(spec.range_bytes, int(total * spec.tolerance / spec.shards)))
    splits = lambda r: any(a < b for a, b in zip(r.low, r.high))
    open_, next_node = {n: r for n, r in live.items() if splits(r)}, 1
    plan.leaves = {n: r for n, r in live.items() if not splits(r)}
    while open_:
        width = spec.first_probes if not plan.rounds else spec.probes
        probes, parents = [], {}
        for node, r in sorted(open_.items(), key=lambda x: x[1].path):
            part = next(i for i in range(3) if r.low[i] < r.high[i])
            step = (r.high[part] - r.low[part]) // width + 1
            probes.append((node, part, r.low[part], step, next_node))
            parents[next_node] = r
            next_node += width
        plan.rounds.append(probes)
        rows = _probe(rows, probes, width, "inner")
        starts = sorted(parents)
        found, open_ = _count(rows), {}
        for node, r in found.items():
            first = starts[bisect.bisect_right(starts, node) - 1]
            r.path = (*parents[first].path, node - first)
            if r.size > limit and splits(r):
                open_[node] = r
            else:
                plan.leaves[node] = r
    _deal(plan, total, spec.shards)
    return plan


def _deal(plan: Plan, total: int, shards: int) -> None:
    """Shard of each range: where the middle of its bytes lies; and the rows before it in its shard."""
    below, rows_in = 0, dict.fromkeys(range(shards), 0)
    for r in sorted(plan.leaves.values(), key=lambda r: r.path):
        r.shard = min(shards - 1, (2 * below + r.size) * shards // (2 * total))
        r.before = rows_in[r.shard]
        rows_in[r.shard] += r.rows
        below += r.size


def ranges(spark: SparkSession, plan: Plan) -> DataFrame:
    rows = [(n, r.shard, r.before) for n, r in plan.leaves.items()]
    return spark.createDataFrame(rows, f"{NODE} long, __shard int, __before long")


def shard(docs: DataFrame, spec: ShardSpec = ShardSpec(), columns: dict[str, Column] | None = None) -> DataFrame:
    """``docs`` with ``size``, ``shard`` (from 0) and ``slot`` (its place in the shard, gapless from 0).

    ``columns`` names what to carry through the exchange in place of all columns.
    """
    rows = keyed(docs)
    kept = [c if columns is None else columns[c].alias(c) for c in (columns or docs.columns)]
    rows = saved(rows.select(*kept, *KEY, SIZE), "keys")
    plan = find_splitters(rows.select(*KEY, SIZE), spec)
    out = rows.withColumn(NODE, F.lit(0).cast("long"))
    for i, probes in enumerate(plan.rounds):
        out = _probe(out, probes, spec.first_probes if i == 0 else spec.probes)
    out = out.join(F.broadcast(ranges(docs.sparkSession, plan)), NODE)
    place = F.row_number().over(Window.partitionBy(NODE).orderBy(*KEY)) - 1
    out = out.withColumn("__slot", F.col("__before") + place)
    names = list(columns or docs.columns)
    taken = {n.lower() for n in names}
    new = {n: (n if n not in taken else f"{n}_assigned") for n in ("size", "shard", "slot")}
    return out.select(*names, F.col(SIZE).alias(new["size"]), F.col("__shard").alias(new["shard"]), F.col("__slot").cast("long").alias(new["slot"]))
