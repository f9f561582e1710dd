"""WARC fixity audit with Merkle trees.

A replica is a set of archives; an archive is a row of records at byte offsets. ``manifest`` holds a digest per record.
``tree`` hashes records in ordered offset ranges of ``range_bytes``, these in ranges ``fan`` times as wide up to the archive,
and archives in groups of ``fan`` up to one root. Every node hashes the ordered list of its children, whose number is bounded,
so no hash is made over an unbounded group. ``audit`` compares the roots of two replicas and then, level by level, only the
children of nodes that differ, until it reaches records: only these are missing, extra or corrupt.

Nulls and edges: a null payload is an empty record; records without an archive or offset are not part of a tree and are
refused by ``manifest``'s caller through ``lay_out``, which gives each record a place; two records at one place are both hashed,
in the order of their digests; an empty replica has no root and differs from any other at every record; two empty ones agree.
Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import saved


@dataclass(frozen=True)
class FixitySpec:
    records_per_archive: int = 256
    range_bytes: int = 1 << 16
    fan: int = 16


def record(url: Column, body: Column) -> Column:
    """A WARC response record as text."""
    body = F.coalesce(body, F.lit(""))
    size = F.octet_length(body).cast("string")
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "), size, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def lay_out(records: DataFrame, key: str, payload: str, spec: FixitySpec = FixitySpec()) -> DataFrame:
    """``records`` with ``archive``, ``offset`` and ``length``: archives of neighbouring keys, records in order of key and text.

    An archive with more rows than keys allow (repeated or null keys) is split by a hash of the text into several.
    """
    span = spec.records_per_archive
    number = F.coalesce(F.floor(F.col(key) / span).cast("long"), F.lit(-1 << 40))
    rows = records.withColumn("__number", number)
    sizes = rows.groupBy("__number").agg(F.ceil(F.count("*") / span).cast("long").alias("__splits"))
    rows = rows.join(sizes, "__number")
    part = F.when(F.col("__splits") > 1, F.pmod(F.xxhash64(payload), F.col("__splits"))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumns({"__part": part, "length": F.octet_length(payload).cast("long")})
    before = Window.partitionBy("__number", "__part").orderBy(key, payload).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")))
    return rows.withColumn("archive", F.concat_ws("-", F.col("__number").cast("string"), F.col("__part").cast("string"))).drop("__number", "__part", "__splits")


def manifest(records: DataFrame, payload: Column) -> DataFrame:
    """``archive, offset, length, digest`` of one replica."""
    payload = F.coalesce(payload, F.lit(""))
    return records.select("archive", F.col("offset").cast("long").alias("offset"), F.octet_length(payload).cast("long").alias("length"), F.sha2(payload, 256).alias("digest"))


@dataclass(frozen=True)
class Tree:
    """``levels[0]`` are records (archive, place, hash); above, nodes (archive or group, place, hash), the root last."""

    levels: list[DataFrame]
    archive_levels: int

    def root(self) -> str | None:
        row = self.levels[-1].first()
        return row["hash"] if row else None


def _joined(children: DataFrame, owner: Column, place: Column) -> DataFrame:
    """Nodes over their children, which are hashed in order of place."""
    listed = F.sort_array(F.collect_list(F.struct("owner", "place", "hash")))
    text = F.array_join(F.transform(listed, lambda c: F.concat_ws(":", c["owner"], c["place"].cast("string"), c["hash"])), ";")
    return children.groupBy(owner.alias("o"), place.alias("p")).agg(F.sha2(text, 256).alias("hash")).select(F.col("o").alias("owner"), F.col("p").alias("place"), "hash")


def depth(*manifests: DataFrame, spec: FixitySpec) -> tuple[int, int]:
    """Levels of offset ranges, and of groups of archives, that reach one node for all of the replicas."""
    ranges, groups = 1, 1
    for m in manifests:
        top, archives = m.agg(F.max("offset"), F.approx_count_distinct("archive")).first()
        while spec.range_bytes * spec.fan ** (ranges - 1) <= (top or 0):
            ranges += 1
        while spec.fan**groups < archives:
            groups += 1
    return ranges, groups


def tree(manifest_: DataFrame, spec: FixitySpec, ranges: int, groups: int) -> Tree:
    """All levels, each written to the shared folder."""
    leaf = F.sha2(F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "digest"), 256)
    levels = [saved(manifest_.select(F.col("archive").alias("owner"), F.col("offset").alias("place"), leaf.alias("hash")), "leaves")]
    for i in range(ranges):
        wide = spec.range_bytes if i == 0 else spec.fan
        levels.append(saved(_joined(levels[-1], F.col("owner"), F.floor(F.col("place") / wide)), "ranges"))
    # archives are dealt to fan ** groups buckets by hash, which are joined by fan up to the root
    bucket = F.pmod(F.xxhash64("owner"), F.lit(spec.fan**groups))
    levels.append(saved(_joined(levels[-1], F.lit("archives"), bucket), "groups"))
    for _ in range(groups):
        levels.append(saved(_joined(levels[-1], F.lit("archives"), F.floor(F.col("place") / spec.fan)), "groups"))
    return Tree(levels, ranges)


def _parent(level: int, spec: FixitySpec, ranges: int, groups: int) -> tuple[Column, Column]:
    """Owner and place of the node above a node of a level."""
    if level == 0:
        return F.col("owner"), F.floor(F.col("place") / spec.range_bytes)
    if level < ranges:
        return F.col("owner"), F.floor(F.col("place") / spec.fan)
    if level == ranges:
        return F.lit("archives"), F.pmod(F.xxhash64("owner"), F.lit(spec.fan**groups))
    return F.lit("archives"), F.floor(F.col("place") / spec.fan)


def audit(left: DataFrame, right: DataFrame, spec: FixitySpec = FixitySpec()) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Records in which the replicas ``left`` and ``right`` (manifests) differ: ``archive, offset, status`` with status
    ``missing`` (only left), ``extra`` (only right) or ``corrupt``; and (level, nodes compared) of the descent."""
    ranges, groups = depth(left, right, spec=spec)
    one, two = tree(left, spec, ranges, groups), tree(right, spec, ranges, groups)
    wrong, steps = None, []
    for level in range(len(one.levels) - 1, -1, -1):
        sides = []
        for side in (one, two):
            nodes = side.levels[level]
            if wrong is not None:
                owner, place = _parent(level, spec, ranges, groups)
                up = wrong.select(F.col("owner").alias("uo"), F.col("place").alias("up"))
                nodes = nodes.join(up, (owner == F.col("uo")) & (place == F.col("up")), "left_semi")
            if level == 0:  # several records at one place are compared as one list
                nodes = nodes.groupBy("owner", "place").agg(F.concat_ws(",", F.sort_array(F.collect_list("hash"))).alias("hash"))
            sides.append(nodes)
        a, b = sides[0].withColumnRenamed("hash", "a"), sides[1].withColumnRenamed("hash", "b")
        compared = saved(a.join(b, ["owner", "place"], "full"), "compared")
        wrong = compared.where("a is distinct from b")
        steps.append((level, compared.count()))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    return wrong.select(F.col("owner").alias("archive"), F.col("place").alias("offset"), status.alias("status")), steps
