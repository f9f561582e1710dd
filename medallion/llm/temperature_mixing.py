"""Temperature mixing of sources, in DataFrame operations only.

Shares of tokens per source are raised to an exponent and normalised. The exponent is found by bisection, so that the
weights reach a target entropy (as a part of the largest possible one), or so that no source is repeated more than a
limit while the most plentiful one is taken once. The bisection aggregates the table of sources for many exponents
at once and needs a handful of jobs; the table itself stays distributed.

Weights become budgets of tokens: a source with ``e`` epochs gives every document ``floor(e)`` times and the documents at
the front of its last permutation once more, while their tokens fit. A permutation deals a source's documents to blocks
by a hash with the seed, orders blocks by number and documents inside a block by hash. Blocks before the cut are taken
whole by their totals; only the block at the cut is looked at row by row. So a source that holds a third of all rows is
cut without ever being sorted as one group.

Nulls and edges: a null source is a source of its own; a null or wordless text has no tokens and is kept once (it
weighs nothing); rows with equal id and text share a place in the permutation and are taken while their total
fits; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import saved

#: Exponents tried at once, and rounds: the interval shrinks by TRIES - 1 in each.
TRIES, ROUNDS = 17, 12


@dataclass(frozen=True)
class MixSpec:
    """One of ``entropy`` (0 to 1, part of the logarithm of the number of sources) and ``repeats`` (at least 1) is given.

    ``budget`` is the number of tokens to draw; None draws as many as there are with ``entropy``, and with ``repeats`` as
    many as take the most plentiful source once.
    """

    entropy: float | None = None
    repeats: float | None = None
    budget: int | None = None
    seed: int = 1
    block_tokens: int = 1 << 20


def token_count(text: Column) -> Column:
    """Words between white space."""
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def _scan(sources: DataFrame, low: float, high: float, measure) -> list[tuple[float, float]]:
    tries = [low + (high - low) * i / (TRIES - 1) for i in range(TRIES)]
    row = sources.agg(*[measure(F.lit(t)).alias(f"t{i}") for i, t in enumerate(tries)]).first()
    return [(t, row[f"t{i}"]) for i, t in enumerate(tries)]


def find_exponent(sources: DataFrame, spec: MixSpec) -> float:
    """Exponent in [0, 1] for ``sources(source, tokens, share)``; 1 keeps the natural shares, 0 makes them equal.

    Entropy falls and repetition falls as the exponent grows, so the interval that holds the target is narrowed. If
    the natural shares meet the target already, the exponent is 1.
    """
    if (spec.entropy is None) == (spec.repeats is None):
        raise ValueError("give either entropy or repeats")
    if spec.repeats is not None:
        if spec.repeats < 1:
            raise ValueError("repeats starts at 1")
        # epochs of a source over those of the most plentiful: (share / largest share) ** (exponent - 1)
        most = sources.agg(F.max("share")).first()[0] or 1.0
        value = lambda t: F.max(F.pow(F.col("share") / F.lit(most), t - 1))
        meets = lambda v: v <= spec.repeats
    else:
        powered = lambda t: F.sum(F.pow("share", t))
        value = lambda t: (F.log(powered(t)) - t * F.sum(F.pow("share", t) * F.log("share")) / powered(t)) / F.log(F.count("*"))
        meets = lambda v: v < spec.entropy
    known = sources.where("tokens > 0")
    if known.limit(2).count() < 2:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        found = _scan(known, low, high, value)
        if spec.entropy is not None and found[-1][1] >= spec.entropy and high == 1.0:
            return 1.0
        first = next((i for i, (_, v) in enumerate(found) if meets(v)), len(found) - 1)
        low, high = found[max(0, first - 1)][0], found[first][0]
        if high - low < 1e-12:
            break
    return high


def weigh(docs: DataFrame, spec: MixSpec) -> DataFrame:
    """``source, tokens, share, weight, epochs``: one row per source, by token counts over all documents."""
    counted = docs.groupBy("source").agg(F.sum("__tokens").alias("tokens"))
    counted = saved(counted, "sources")
    total = counted.agg(F.sum("tokens")).first()[0] or 0
    sources = counted.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    exponent = find_exponent(sources, spec)
    raised = sources.withColumn("__p", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    norm, most = raised.agg(F.sum("__p"), F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("__p")))).first()
    norm = norm or 1.0
    budget = spec.budget if spec.budget is not None else (total if spec.repeats is None else (most or 0.0) * norm)
    weight = F.col("__p") / F.lit(float(norm))
    epochs = F.when(F.col("tokens") > 0, F.lit(float(budget)) * weight / F.col("tokens")).otherwise(1.0)
    # an epoch count that misses a whole number by rounding only is that number
    near = F.round(epochs)
    epochs = F.when(F.abs(epochs - near) < 1e-9, near).otherwise(epochs)
    return saved(raised.select("source", "tokens", "share", weight.alias("weight"), epochs.alias("epochs"), F.lit(exponent).alias("exponent")), "weights")


def mix(docs: DataFrame, spec: MixSpec = MixSpec(repeats=4.0)) -> DataFrame:
    """``docs`` with ``copies``: how often each row is drawn (0 included), and its ``block`` in the permutation."""
    extra = {"copies", "block"} & {c.lower() for c in docs.columns}
    if extra:
        docs = docs.withColumnsRenamed({c: f"{c}_given" for c in docs.columns if c.lower() in extra})
    rows = docs.withColumns({
        "__tokens": token_count(F.col("text")),
        "__h": F.xxhash64(F.lit(spec.seed), F.col("doc_id").cast("string"), F.col("text")),
    })
    slim = saved(rows.select("source", "__h", "__tokens"), "tokens")
    weights = weigh(slim, spec)
    places = weights.select(
        F.col("source").alias("__s"),
        F.floor("epochs").cast("long").alias("__whole"),
        F.floor(F.col("tokens") * (F.col("epochs") - F.floor("epochs"))).cast("long").alias("__rest"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / spec.block_tokens)).cast("long").alias("__blocks"),
    )
    places = saved(places, "places")
    number = F.pmod(F.xxhash64("__h", F.lit(spec.seed)), F.col("__blocks"))

    def placed(df: DataFrame) -> DataFrame:
        return df.join(places, F.col("source").eqNullSafe(F.col("__s"))).withColumn("__block", number)

    by_hash = placed(slim).where("__tokens > 0").groupBy("__s", "__block", "__rest", "__h").agg(F.sum("__tokens").alias("__t"))
    by_hash = saved(by_hash, "permuted")
    totals = by_hash.groupBy("__s", "__block", "__rest").agg(F.sum("__t").alias("__sum"))
    before = _running(totals)
    cut = before.where("__before < __rest and __before + __sum > __rest")
    cut = saved(cut.select("__s", "__block", "__rest", "__before"), "cut")
    c, r = cut.alias("c"), by_hash.alias("r")
    inside = r.join(c, F.col("r.__s").eqNullSafe(F.col("c.__s")) & (F.col("r.__block") == F.col("c.__block")))
    order = Window.partitionBy("__s", "__block").orderBy("__h").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.select("r.__s", "r.__block", "r.__rest", "r.__h", "r.__t", "c.__before")
    fits = inside.withColumn("__upto", F.col("__before") + F.sum("__t").over(order)).where("__upto <= __rest")
    last = fits.groupBy("__s", "__block").agg(F.max("__h").alias("__last"))
    ends = cut.join(last.withColumnsRenamed({"__s": "s2", "__block": "b2"}), F.col("__s").eqNullSafe(F.col("s2")) & (F.col("__block") == F.col("b2")), "left")
    ends = ends.select(F.col("__s").alias("__s3"), F.col("__block").alias("__cut"), "__last")
    # a source whose blocks all fit (or none) has no cut block: everything before the rest is taken
    edges = places.join(ends, F.col("__s").eqNullSafe(F.col("__s3")), "left").drop("__s3")
    whole_blocks = before.where("__before + __sum <= __rest").groupBy("__s").agg(F.max("__block").alias("__full"))
    edges = edges.join(whole_blocks.withColumnRenamed("__s", "__s4"), F.col("__s").eqNullSafe(F.col("__s4")), "left").drop("__s4")
    edges = saved(edges, "edges")

    out = rows.join(edges, F.col("source").eqNullSafe(F.col("__s"))).withColumn("__block", number)
    again = (F.col("__block") <= F.coalesce("__full", F.lit(-1))) | ((F.col("__block") == F.col("__cut")) & (F.col("__h") <= F.col("__last")))
    copies = F.when(F.col("__tokens") == 0, F.lit(1)).otherwise(F.col("__whole") + F.coalesce(again, F.lit(False)).cast("long"))
    return out.select(*docs.columns, F.col("__tokens").alias("__tokens"), copies.cast("long").alias("copies"), F.col("__block").alias("block"))


def _running(totals: DataFrame) -> DataFrame:
    """Tokens in the blocks before each block of a source. Blocks are summed in runs of 1,024 first, so no group of a
    window is larger than that while a source has fewer than a million blocks."""
    totals = totals.withColumn("__run", F.floor(F.col("__block") / 1024))
    runs = totals.groupBy("__s", "__run").agg(F.sum("__sum").alias("__runsum"))
    upto = Window.partitionBy("__s").orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("__s").alias("s1"), F.col("__run").alias("r1"), F.coalesce(F.sum("__runsum").over(upto), F.lit(0)).alias("__r0"))
    inner = Window.partitionBy("__s", "__run").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    out = totals.withColumn("__b0", F.coalesce(F.sum("__sum").over(inner), F.lit(0)))
    out = out.join(runs, F.col("__s").eqNullSafe(F.col("s1")) & (F.col("__run") == F.col("r1")))
    return out.select("__s", "__block", "__rest", "__sum", (F.col("__r0") + F.col("__b0")).alias("__before"))


def drawn(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Every row as often as it is drawn."""
    often = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.where("copies > 0").select(*columns, often.alias("__copy")).drop("__copy")
