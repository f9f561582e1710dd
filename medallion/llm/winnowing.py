"""Document fingerprints by winnowing, in DataFrame operations only.

A text's words (runs without white space, as they are) give one hash per run of ``gram`` words. From every ``window``
neighbouring hashes the smallest is chosen, of equal ones the rightmost, and kept once with its position. Two texts
that share ``gram + window - 1`` words in a row share a chosen hash (the guarantee); a shared run below ``gram`` words
is never seen. A text with fewer words gives one hash of all its words.

All work is on arrays inside a row; names bound with ``let`` are evaluated once. The likeness of two fingerprints is the
Jaccard similarity of their hash sets; two empty ones are alike (1.0), an empty and another one are not (0.0).

Nulls and edges: a null text counts as empty and has no hashes; a text without white space is one word, however long; rows
without id come before all others, and rows of one id are in the order of their text's hash, so repeated rows follow each
other; a table of one row is its own next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import partitions

#: The words of a text: every other byte sequence is white space.
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class WinnowSpec:
    gram: int = 5
    window: int = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def gram_hashes(tokens: Column, spec: WinnowSpec) -> Column:
    """Hashes of all runs of ``gram`` words; of all words where there are fewer; none where there are none."""
    count = F.size(tokens)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), count - spec.gram + 1)), lambda i: F.xxhash64(F.slice(tokens, i, spec.gram)))
    return F.when(count == 0, F.array().cast("array<long>")).otherwise(runs)


def chosen(hashes: Column, spec: WinnowSpec) -> Column:
    """Positions (from 0, ascending) of the smallest hash of each window, the rightmost of equal ones."""
    count = F.size(hashes)
    marked = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), (-i).alias("p")))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), count - spec.window + 1))
    picks = let(marked, lambda m: F.transform(starts, lambda i: -F.array_min(F.slice(m, i, spec.window))["p"]))
    return F.when(count == 0, F.array().cast("array<int>")).otherwise(F.array_distinct(picks))


def fingerprint(text: Column, spec: WinnowSpec = WinnowSpec()) -> Column:
    """``array<struct<hash: bigint, position: int>>`` of a whole text; a null text counts as empty."""

    def pick(h: Column) -> Column:
        return F.transform(chosen(h, spec), lambda p: F.struct(F.get(h, p).alias("hash"), p.alias("position")))

    tokens = words(F.coalesce(text, F.lit("")))
    return let(tokens, lambda t: let(gram_hashes(t, spec), pick))


def written(print_: Column) -> Column:
    """A fingerprint as text: hash (hex) and position of each choice, in order."""
    return F.array_join(F.transform(print_, lambda f: F.concat(F.lower(F.hex(f["hash"])), F.lit("@"), f["position"].cast("string"))), " ")


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of the sets of hashes."""
    a, b = F.array_distinct(one["hash"]), F.array_distinct(two["hash"])

    def ratio(x: Column, y: Column, both: Column) -> Column:
        union = F.size(x) + F.size(y) - both
        return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union)

    return let(a, lambda x: let(b, lambda y: let(F.size(F.array_intersect(x, y)), lambda n: ratio(x, y, n))))


#: Rows per range and ranges at most, of the exchange that brings neighbours together.
RANGE_ROWS, MAX_RANGES = 2000, 1 << 16


def range_of(value: Column, starts: list[int]) -> Column:
    """How many of the ascending ``starts`` are at or below a value, less one; 0 for null. A binary search."""
    steps = max(1, len(starts).bit_length())
    known = F.lit(starts).cast("array<long>")
    reach = [1 << i for i in reversed(range(steps))]
    found = F.aggregate(F.lit(reach), F.lit(0), lambda at, step: F.when(F.get(known, at + step) <= value, at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))


def range_starts(docs: DataFrame) -> list[int]:
    """Smallest id of each of several ranges of about as many rows: rough quantiles, then the exact smallest ids."""
    rows = docs.count()
    wanted = min(MAX_RANGES, max(partitions(docs.sparkSession), rows // RANGE_ROWS))
    rough = docs.where("doc_id is not null").approxQuantile("doc_id", [i / wanted for i in range(wanted)], 0.25 / wanted)
    if not rough:
        return []
    rough = sorted({int(e) for e in rough})
    found = docs.where("doc_id is not null").groupBy(range_of(F.col("doc_id"), rough).alias("r")).agg(F.min("doc_id").alias("first"))
    return sorted(r["first"] for r in found.collect())


def with_next(docs: DataFrame, values: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs(doc_id, text)`` with ``text``, and the columns that ``values`` adds, of the next row in ascending order of
    (doc_id, hash of the text), null ids first; after the last comes the first.

    Rows are exchanged once, by ranges of ids; the first row of each range is also sent to the range before it.
    """
    starts = range_starts(docs.select("doc_id"))
    bare = docs.select("doc_id").where("doc_id is null").limit(1).count() > 0
    last = max(0, len(starts) - 1)
    rows = docs.withColumns({"__range": range_of(F.col("doc_id"), starts), "__tie": F.xxhash64("text")})
    here = F.struct(F.col("__range").alias("r"), F.lit(0).alias("peek"))
    before = F.struct((F.col("__range") - 1).alias("r"), F.lit(1).alias("peek"))
    wrapped = F.struct(F.lit(last).alias("r"), F.lit(1).alias("peek"))
    opens = F.coalesce(F.get(F.lit(starts).cast("array<long>"), F.col("__range")) == F.col("doc_id"), F.lit(False))
    first = F.col("doc_id").isNull() if bare else opens & (F.col("__range") == 0)
    places = F.when(first, F.array(here, wrapped)).when(opens & (F.col("__range") > 0), F.array(here, before)).otherwise(F.array(here))
    dealt = rows.withColumn("__place", F.explode(places))
    dealt = dealt.select(*docs.columns, "__tie", F.col("__place.r").alias("__range"), F.col("__place.peek").alias("__peek")).repartition("__range")
    made = values(dealt)
    extra = [c for c in made.columns if c not in dealt.columns]
    order = Window.partitionBy("__range").orderBy("__peek", F.col("doc_id").asc_nulls_first(), "__tie")
    ahead = made.withColumns({f"next_{c}": F.lead(c).over(order) for c in ["text", *extra]})
    return ahead.where("__peek = 0").drop("__range", "__peek", "__tie")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points replaced by as many first ones of the next text (or all it has)."""
    text, following = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def compare_edits(docs: DataFrame, spec: WinnowSpec = WinnowSpec()) -> DataFrame:
    """Every document's fingerprint (``print``), that of its edited text (``edited_print``) and of the next document
    (``next_print``)."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # a written column between two steps keeps an expression from being evaluated in both
    ahead = with_next(slim, lambda rows: rows.withColumn("print", fingerprint(F.col("text"), spec)))
    return ahead.withColumn("edited", edited(F.col("text"), F.col("next_text"))).withColumn("edited_print", fingerprint(F.col("edited"), spec))
