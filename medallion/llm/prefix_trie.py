"""Prefix trie of conversations by van Emde Boas recursion.

A node is a distinct sequence of first turns; its members are the conversations that start with it. A trie of height ``H`` (a
power of two above the longest conversation) is cut at half its height: the prefixes at the cut get names, the upper trie holds
what is above them, and every name is the root of a lower trie. Upper and lower tries are cut the same way. All
tries of one height are one table, so a level of the recursion is a few joins however long or many the conversations are.

1. *Blocks.* A turn is the digest of its role and text. Digests of 2, 4, 8 ... turns that start at a multiple of their number
   come from those of half the size.
2. *Names, downwards.* At height ``s`` a prefix of ``a`` turns (``a`` a multiple of ``s``) and the block of ``s / 2`` turns after it
   name the prefix of ``a + s / 2`` turns. After the last level every prefix of every conversation has a name.
3. *Nodes.* Names are counted, with the smallest member; its shorter prefix is the parent.
4. *Totals, upwards.* From the smallest tries to the largest: what the lower trie of a cut prefix adds up to is grafted on that
   prefix and on those above it in the upper trie, which are the prefixes of its smallest member.

Rows are keyed by conversation and place, so a conversation of any length is spread over tasks; a turn that very many conversations
share is one name, counted before the exchange. Turns are numbered by ranges of the order, not by a window over a conversation.
Names are 128-bit digests.

Nulls and edges: a null role or text is empty; turns are in the order of ``turn`` (null first), then role, then text, and repeated
rows are turns of their own; rows without ``conv_id`` are one conversation, before all others, written ``null`` among the members; a
table without rows has no nodes; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import partitions, saved

#: Stands for a missing conversation id.
NULL_ID = -(2**63)
#: Conversation ids written by one row of an aggregate: those with one quotient.
IDS_SHIFT = 12


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered(conversations: DataFrame) -> DataFrame:
    """``(conv, place, role, text)``: turns from 0 in the order of each conversation."""
    spark = conversations.sparkSession
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text", "tie"]
    ranged = rows.repartitionByRange(partitions(spark), "conv", *order).withColumn("part", F.spark_partition_id())
    ranged = saved(ranged, "ranged")
    # Only the first conversation of a range can have turns in earlier ones: one row per range at most.
    sizes = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = sizes.withColumn("base", F.sum("n").over(before)).where("base > 0").drop("n")
    here = F.row_number().over(Window.partitionBy("part", "conv").orderBy(*order)) - 1
    placed = ranged.withColumn("at", here).join(F.broadcast(begun), ["conv", "part"], "left")
    return saved(placed.select("conv", (F.col("at") + F.coalesce("base", F.lit(0))).cast("long").alias("place"), "role", "text"), "numbered")


def branched(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first ``h`` turns taken from the first of its family, ``h`` a hash of its id below ``heads``.

    Returns the turns of all, and ``(conv, length)`` with those that have none.
    """
    known = turns.groupBy("conv").agg(F.count("*").alias("size"))
    null = F.col("conv") == NULL_ID
    head = F.when(null, 0).otherwise(F.crc32(F.col("conv").cast("string").cast("binary")) % heads)
    first = F.when(null, F.col("conv")).otherwise(F.col("conv") - F.col("conv") % family)
    known = known.withColumns({"head": head, "first": first})
    of_first = known.select(F.col("conv").alias("first"), F.col("size").alias("given"))
    known = known.join(of_first, "first", "left").withColumn("given", F.least("head", F.coalesce("given", F.lit(0))))
    known = saved(known.select("conv", "first", "size", "head", "given"), "families")
    lead = turns.where(F.col("place") < heads - 1).withColumnRenamed("conv", "first")
    lead = known.select("conv", "first", "head").join(lead, "first").where("place < head").select("conv", "place", "role", "text")
    own = turns.join(known.select("conv", "head", "given"), "conv").where("place >= head")
    own = own.select("conv", (F.col("place") - F.col("head") + F.col("given")).alias("place"), "role", "text")
    lengths = known.select("conv", (F.col("given") + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("length"))
    return lead.unionByName(own), lengths


def _names(turns: DataFrame, lengths: DataFrame, height: int) -> DataFrame:
    """``(conv, depth, name)`` of every prefix of every conversation."""
    blocks, size = [turns.select("conv", F.col("place").alias("block"), "digest")], 1
    while 2 * size < height:
        halves = [F.max(F.when(F.col("block") % 2 == side, F.col("digest"))) for side in (0, 1)]
        both = blocks[-1].groupBy("conv", F.shiftright("block", 1).alias("up")).agg(halves[0].alias("l"), halves[1].alias("r")).where("r IS NOT NULL")
        blocks.append(saved(both.select("conv", F.col("up").alias("block"), _digest("l", "r").alias("digest")), "blocks"))
        size *= 2
    names = lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit("")).alias("name"))
    while size:
        # all tries of height 2 * size are cut at half
        after = blocks.pop().withColumn("depth", F.col("block") * size).where(F.col("depth") % (2 * size) == 0)
        cut = names.where(F.col("depth") % (2 * size) == 0).join(after, ["conv", "depth"])
        cut = cut.select("conv", (F.col("depth") + size).alias("depth"), _digest("name", "digest").alias("name"))
        names = names.unionByName(saved(cut, "names"))
        size //= 2
    return names


def _grafted(nodes: DataFrame, names: DataFrame, height: int) -> DataFrame:
    """``nodes`` with ``leaves`` and ``saved`` added up over their subtrees."""
    half = 1
    while half < height:
        # tops of the lower tries, added up per cut prefix
        tops = nodes.where(F.col("parent_depth") % (2 * half) == half)
        lower = tops.groupBy("parent_depth", "parent", "parent_conv").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        above = F.explode(F.sequence(F.col("parent_depth") - half + 1, F.col("parent_depth"))).alias("depth")
        lower = lower.select(F.col("parent_conv").alias("conv"), above, "leaves", "saved").join(names, ["conv", "depth"])
        more = lower.groupBy("depth", "name").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        grown = {x: F.col(x) + F.coalesce(y, F.lit(0)) for x, y in (("leaves", "l"), ("saved", "s"))}
        nodes = saved(nodes.join(more, ["depth", "name"], "left").withColumns(grown).drop("l", "s"), "nodes")
        half *= 2
    # the root lies above all cuts
    whole = nodes.where("depth = 1").agg(F.sum("leaves"), F.sum("saved")).first()
    grown = {x: F.col(x) + F.when(F.col("depth") == 0, n or 0).otherwise(0) for x, n in zip(("leaves", "saved"), whole)}
    return nodes.withColumns(grown)


def _ends(names: DataFrame, lengths: DataFrame) -> DataFrame:
    """``(depth, name, ends)``: SHA-256 of the ids of the conversations that end in a node, ascending, joined by commas.

    Ids near each other are joined by an aggregate; a task then passes over these pieces in order, one after the other.
    """
    ending = names.join(lengths.withColumnRenamed("length", "depth"), ["conv", "depth"])
    written = F.transform(F.array_sort(F.collect_list("conv")), lambda c: F.when(c == NULL_ID, "null").otherwise(c.cast("string")))
    pieces = ending.groupBy("depth", "name", F.shiftright("conv", IDS_SHIFT).alias("piece")).agg(F.array_join(written, ",").alias("ids"))

    def digest(batches):
        now, done = None, None
        for batch in batches:
            out = []
            for depth, name, ids in zip(batch["depth"].tolist(), batch["name"], batch["ids"]):
                if (depth, name) != now:
                    if now is not None:
                        out.append((*now, done.hexdigest()))
                    now, done = (depth, name), hashlib.sha256(ids.encode())
                else:
                    done.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=["depth", "name", "ends"])
        if now is not None:
            yield pd.DataFrame([(*now, done.hexdigest())], columns=["depth", "name", "ends"])

    spread = pieces.repartition(partitions(names.sparkSession), "depth", "name").sortWithinPartitions("depth", "name", "piece")
    return spread.select("depth", "name", "ids").mapInPandas(digest, "depth long, name binary, ends string")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of ``turns(conv, place, role, text)``; ``lengths(conv, length)`` also lists conversations without turns.

    ``name, depth, conv_id`` (smallest member), ``parent, parent_conv_id, n_convs, n_children, n_leaves``, ``saved_tokens`` (words
    of the last turn for every member but one, over the subtree) and ``ends_sha256``. The last turn of a node is the
    turn at place ``depth - 1`` of ``conv_id``.
    """
    text = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    turns = saved(turns.select("conv", "place", _digest(text).alias("digest"), words.alias("words")), "turns")
    lengths = saved(lengths, "lengths")
    height = 1 << ((lengths.agg(F.max("length")).first()[0] or 0)).bit_length()
    names = saved(_names(turns, lengths, height), "prefixes")

    last = turns.select("conv", (F.col("place") + 1).alias("depth"), "words")
    counted = names.join(last, ["conv", "depth"], "left").groupBy("depth", "name")
    counted = saved(counted.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.coalesce(F.min("words"), F.lit(0)).alias("words")), "counted")
    shorter = names.select("conv", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = counted.join(shorter, ["conv", "depth"], "left").withColumn("parent_depth", F.when(F.col("depth") > 0, F.col("depth") - 1))
    nodes = saved(nodes, "parents")
    above = counted.select(F.col("depth").alias("parent_depth"), F.col("name").alias("parent"), F.col("conv").alias("parent_conv"))
    children = nodes.where("depth > 0").groupBy(F.col("parent_depth").alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "name"], "left").fillna(0, ["n_children"]).join(above, ["parent_depth", "parent"], "left")
    own = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}
    nodes = _grafted(saved(nodes.withColumns(own), "nodes"), names, height)

    none = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = nodes.join(_ends(names, lengths), ["depth", "name"], "left")
    ids = [F.when(F.col(c) != NULL_ID, F.col(c)).alias(f"{c}_id") for c in ("conv", "parent_conv")]
    totals = F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", none).alias("ends_sha256")
    return nodes.select("name", "depth", "parent", *ids, "n_convs", "n_children", *totals)
