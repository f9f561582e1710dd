"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters: components, and links that span them.

How it runs:

1. One pass counts shingle occurrences in a table of ``order_cells`` counters. It has a fixed size, so it may be
   broadcast; it only decides the *order* of shingles (rare first, then by hash), and any common order gives the
   same links. Where the corpus has far more shingles than counters, rare shingles share a level and only frequent
   ones are told apart, which is what keeps them out of the prefixes.
2. Documents with equal shingle sets form one class, represented by its smallest id. Prefix shingles of all documents meet in
   one exchange, each with a 64-bit mark of its set; there copies go, then shingles of one class, and the rest becomes lists.
3. In the list of each prefix shingle, documents are ordered by its position in them (the least edited of a group of near
   copies comes first) and every document is a candidate with the first few and with the one before it.
4. Candidates that pass the length, positional and suffix filters are verified on their whole sets, and linked. The suffix
   filter bounds the difference of two whole sets from below by the parities of their parts by hash: 512 parts, and for
   larger sets as many as they have shingles (at most 4096), so that it tells long texts apart too.
5. Prefix shingles with longer lists than step 3 covers are joined again, now between different components only and with all
   filters in the join's condition: a group of thousands of near copies, already one component, makes no pairs with itself.
   A pair is made in the first of these lists that it shares only. Pairs verified before are not verified again.

Nulls and edges: a null or wordless text has an empty set and links with nothing; a row without id takes its class's
component (null if the whole class has no id); repeated rows and ids are kept, one result row per input row, and
rows that share an id count as one vertex; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import components, each_row, id_bitmap, may_hold, packed_chunks, saved, shingle_set, summed_cells

#: Words of 64 parity bits: of any set, and of the largest.
PARITY, MOST_PARITY = 8, 64


@dataclass(frozen=True)
class JoinSpec:
    """Link when ``100 * intersection >= percent * union`` of the sets of ``size``-word shingles."""

    size: int = 5
    percent: int = 75
    order_cells: int = 1 << 24

    def prefix(self, n: int) -> int:
        """Two linked sets share one of their first so many shingles."""
        return n - -(-self.percent * n // 100) + 1


def shingle_order(docs: DataFrame, spec: JoinSpec) -> np.ndarray:
    """Per cell, a level that grows with the occurrences of its shingles (about four levels to a doubling)."""
    cells, shift = spec.order_cells, np.uint64(64 - spec.order_cells.bit_length() + 1)

    def count(batches):
        total = np.zeros(cells, np.uint8)  # a task counts to 255, which is frequent enough for the order
        for batch in each_row(batches):
            for text in batch["text"]:
                at = (shingle_set(text, spec.size) >> shift).astype(np.int64)
                total[at] = np.minimum(total[at], 254) + 1
        yield packed_chunks(total)

    parts = docs.select("text").mapInPandas(count, "chunk int, cells binary")
    return summed_cells(parts, cells, lambda v: np.minimum(255, 8 * np.log2(1.0 + v)).astype(np.uint8))


def parities(s: np.ndarray) -> np.ndarray:
    """Words of parity bits of a set's parts by hash. ``folded`` gives those of fewer parts."""
    words = PARITY
    while words < MOST_PARITY and 64 * words < len(s):
        words *= 2
    odd = np.bincount((s >> np.uint64(32)).astype(np.int64) & (64 * words - 1), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(words: np.ndarray, count: int) -> np.ndarray:
    return np.bitwise_xor.reduce(words.reshape(-1, count), axis=0)


def prefixes(docs: DataFrame, levels, spec: JoinSpec) -> DataFrame:
    """Per row: set size, a 128-bit digest of the set, its rarest shingles in order, and the parities of its parts by hash."""
    shift = np.uint64(64 - spec.order_cells.bit_length() + 1)

    def cut(batches):
        for batch in each_row(batches):
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                s = shingle_set(text, spec.size)
                n = len(s)
                first = parity = digest = None
                if n:
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    order = np.lexsort((s, levels.value[(s >> shift).astype(np.int64)]))
                    first = s[order[: spec.prefix(n)]].view(np.int64)
                    parity = parities(s)
                rows.append((doc, n, digest, first, parity))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "digest", "first", "parity"])
            yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInPandas(
        cut, "doc_id long, n long, digest binary, first array<long>, parity array<long>"
    )


def needed(na: Column, nb: Column, spec: JoinSpec) -> Column:
    """Smallest intersection that links sets of these sizes."""
    return -F.floor(-(spec.percent * (na + nb)) / F.lit(100 + spec.percent))


def fits(na: Column, pa: Column, nb: Column, pb: Column, spec: JoinSpec) -> Column:
    """Length and positional filter for one shared prefix shingle (positions from 0)."""
    length = 100 * F.least(na, nb) >= spec.percent * F.greatest(na, nb)
    most = F.least(pa, pb) + 1 + F.least(na - pa - 1, nb - pb - 1)
    return length & (most >= needed(na, nb, spec))


def first_fits(na: Column, pa: Column, nb: Column, pb: Column, spec: JoinSpec) -> Column:
    """The same for the first shingle that two sets share in their common order: what stands before it is in one of them only."""
    length = 100 * F.least(na, nb) >= spec.percent * F.greatest(na, nb)
    return length & (F.least(na - pa, nb - pb) >= needed(na, nb, spec)) & (pa + pb <= na + nb - 2 * needed(na, nb, spec))


def alike(na: Column, pa: Column, nb: Column, pb: Column, spec: JoinSpec) -> Column:
    """Suffix filter on ``PARITY`` words: parts of odd difference are no more than the sets may differ by."""
    apart = sum((F.bit_count(pa[i].bitwiseXOR(pb[i])) for i in range(PARITY)), F.lit(0))
    return apart <= na + nb - 2 * needed(na, nb, spec)


def short(parity: Column) -> Column:
    """Parities folded to ``PARITY`` words."""
    word = lambda i: F.aggregate(F.filter(parity, lambda x, j: j % PARITY == i), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(x))
    return F.array(*[word(i) for i in range(PARITY)])


def all_alike(pairs: DataFrame, spec: JoinSpec) -> DataFrame:
    """Suffix filter on the most words that both sets of ``pairs(a, b, na, pa, nb, pb)`` have."""

    def test(batches):
        for batch in batches:
            ok = []
            for na, pa, nb, pb in zip(batch["na"].tolist(), batch["pa"], batch["nb"].tolist(), batch["pb"]):
                count = min(len(pa), len(pb))
                apart = int(np.bitwise_count((folded(pa, count) ^ folded(pb, count)).view(np.uint64)).sum())
                ok.append(apart <= na + nb + 2 * (-(spec.percent * (na + nb)) // (100 + spec.percent)))
            yield batch.loc[np.array(ok, bool), ["a", "b"]]

    return pairs.select("a", "b", "na", "pa", "nb", "pb").mapInPandas(test, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, spec: JoinSpec) -> DataFrame:
    """The pairs ``(a, b)`` that link. Sets are made again from the whole texts, only for documents that a fixed-size
    bitmap of candidate ids lets through; 48 bits of each shingle's hash are compared."""
    held = id_bitmap(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")), "rep")

    def sets(batches):
        for batch in each_row(batches):
            batch = batch[batch["doc_id"].notna() & batch["text"].notna()]
            batch = batch[may_hold(held.value, batch["doc_id"].to_numpy(np.int64))] if len(batch) else batch
            made = [shingle_set(t, spec.size) >> np.uint64(16) for t in batch["text"]]
            blobs = [s.view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for s in made]
            yield pd.DataFrame({"rep": batch["doc_id"].astype("int64").to_numpy(), "tokens": blobs})

    whole = docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(sets, "rep long, tokens binary").where(F.length("tokens") > 0)
    whole = saved(whole, "sets")
    one = whole.select(F.col("rep").alias("a"), F.col("tokens").alias("ta"))
    two = whole.select(F.col("rep").alias("b"), F.col("tokens").alias("tb"))

    def unpacked(data: bytes) -> np.ndarray:
        out = np.zeros((len(data) // 6, 8), np.uint8)
        out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
        return out.view(np.uint64).ravel()

    def test(batches):
        for batch in batches:
            ok = []
            for ta, tb in zip(batch["ta"], batch["tb"]):
                x, y = unpacked(ta), unpacked(tb)
                small, big = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(big, small), len(big) - 1)
                both = int((big[at] == small).sum())
                ok.append(100 * both >= spec.percent * (len(x) + len(y) - both))
            yield batch.loc[np.array(ok, bool), ["a", "b"]]

    return pairs.join(one, "a").join(two, "b").mapInPandas(test, "a long, b long").distinct()


@dataclass(frozen=True)
class JoinResult:
    """``rows``: one per document (doc_id, n, rep); ``links``: linked pairs of representatives, one spanning set of each
    component at least; ``labels``: (id, component) of linked representatives."""

    rows: DataFrame
    links: DataFrame
    labels: DataFrame

    def documents(self) -> DataFrame:
        out = self.rows.join(self.labels.withColumnRenamed("id", "rep"), "rep", "left")
        own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
        return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


#: First documents of a shingle's list that all others of the list are compared with.
LEADERS = 4


def _met(tokens: DataFrame) -> DataFrame:
    """One row (the smallest id) of each class whose shingle another class has too. Copies of a set have one ``mark``, and stand
    side by side in the list of each of its shingles."""
    near = Window.partitionBy("token").orderBy("pos", "mark", "rep")
    once = tokens.withColumn("__a", F.lag("mark").over(near)).where("__a is null or __a != mark")
    seen = once.withColumns({"__a": F.lag("mark").over(near), "__b": F.lead("mark").over(near)})
    return seen.where("__a is not null or __b is not null").drop("__a", "__b")


def _lists(tokens: DataFrame, spec: JoinSpec) -> DataFrame:
    """Rows whose shingle has another row, with the size of its list and the row's candidates there (``others``): the leaders
    of the list and the row before it."""
    near = Window.partitionBy("token").orderBy("pos", "rep")
    so_far = near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    me = F.struct("rep", "n", "pos")
    others = F.array(*[F.nth_value(me, i).over(so_far) for i in range(1, LEADERS + 1)], F.lag(me).over(near))
    rows = tokens.withColumns({"size": F.count("*").over(Window.partitionBy("token")), "others": others}).where("size > 1")
    good = F.filter("others", lambda o: o.isNotNull() & (o["rep"] != F.col("rep")) & fits(F.col("n"), F.col("pos"), o["n"], o["pos"], spec))
    return rows.withColumn("others", F.array_distinct(F.transform(good, lambda o: o["rep"])))


def _first_pairs(shared: DataFrame) -> DataFrame:
    """Every document with its candidates in the lists it is in."""
    found = shared.where(F.size("others") > 0).groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("others"))).alias("others"))
    pairs = found.select("rep", F.explode("others").alias("other"))
    return pairs.select(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).distinct()


def ngram_join(docs: DataFrame, spec: JoinSpec = JoinSpec()) -> JoinResult:
    """Join ``docs(doc_id, text, ...)`` with itself; see the module's text."""
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(shingle_order(docs, spec))
    cut = saved(prefixes(docs, levels, spec), "prefixes")
    levels.destroy()
    reps = cut.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"))
    rows = saved(cut.select("doc_id", "n", "digest").join(reps, "digest", "left").select("doc_id", "n", "rep"), "members")

    tokens = cut.where("n > 0 and doc_id is not null").select(
        F.col("doc_id").alias("rep"), F.col("n").cast("int").alias("n"), F.xxhash64("digest").alias("mark"), F.posexplode("first").alias("pos", "token")
    )
    shared = saved(_lists(_met(tokens), spec), "lists")
    members = shared.select("rep").distinct()
    profiles = cut.where("n > 0").select(F.col("doc_id").alias("rep"), F.col("n").cast("int").alias("n"), F.xxhash64("digest").alias("mark"), "parity")
    profiles = saved(profiles.join(members, "rep", "left_semi").distinct(), "profiles")

    tried = _first_pairs(shared)
    one = profiles.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    two = profiles.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    tried = saved(all_alike(tried.join(one, "a").join(two, "b"), spec).distinct(), "tried")
    links = saved(verified(tried, docs, spec), "links")
    labels = saved(components(links), "labels")

    late = saved(_late_pairs(shared, profiles, labels, spec).join(tried, ["a", "b"], "left_anti"), "late")
    if not late.limit(1).count():
        return JoinResult(rows, links, labels)
    late = saved(verified(late, docs, spec), "links")
    stars = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return JoinResult(rows, links.union(late), saved(components(stars.union(late)), "labels"))


def _late_pairs(shared: DataFrame, profiles: DataFrame, labels: DataFrame, spec: JoinSpec) -> DataFrame:
    """Pairs of different components that pass the filters in the longer lists, each from the first of these that it shares: in a
    list of up to LEADERS + 1 rows every pair has been tried, in one of a single component none is wanted."""
    named = shared.where(F.col("size") > LEADERS + 1).select("token", "rep", "mark", "n", "pos")
    named = named.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("group", F.coalesce("component", "rep")).drop("component")
    mixed = named.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi").select("token")
    named = saved(named.join(mixed, "token", "left_semi"), "mixed")
    # what stands before a shingle, of those lists; texts of one id are told apart by their marks
    before = Window.partitionBy("rep", "mark").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    full = named.withColumn("before", F.collect_list("token").over(before))
    full = full.join(profiles.select("rep", "mark", short(F.col("parity")).alias("parity")), ["rep", "mark"]).drop("mark")
    a, b = full.alias("a"), full.alias("b")
    both = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.rep") < F.col("b.rep")) & (F.col("a.group") != F.col("b.group"))
                  & first_fits(F.col("a.n"), F.col("a.pos"), F.col("b.n"), F.col("b.pos"), spec)
                  & alike(F.col("a.n"), F.col("a.parity"), F.col("b.n"), F.col("b.parity"), spec)
                  & ~F.arrays_overlap("a.before", "b.before"))
    return both.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``__vertex``: the id, but a number of its own (from 2 ** 62 on) for every further text of an id that has
    several. Texts are shuffled only for such ids, and the few their bitmap lets through."""
    mark = F.xxhash64("doc_id", "text")
    known = docs.where("doc_id is not null and text is not null").select("doc_id", mark.alias("mark"))
    clashes = saved(known.groupBy("doc_id").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo < hi").select("doc_id", "lo"), "clashes")
    own = F.col("doc_id").cast("long")
    if not clashes.limit(1).count():
        return docs.withColumn("__vertex", own)
    held = id_bitmap(clashes, "doc_id")
    at = docs.columns.index("doc_id")
    some = _side(docs, at, held, True).join(clashes.withColumnRenamed("doc_id", "__id").withColumnRenamed("lo", "__lo"), F.col("doc_id") == F.col("__id"), "left")
    other = mark.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    some = some.withColumn("__vertex", F.when(mark != F.col("__lo"), other).otherwise(own)).drop("__id", "__lo")
    return _side(docs, at, held, False).withColumn("__vertex", own).unionByName(saved(some, "apart"))


def _side(docs: DataFrame, at: int, held, maybe: bool) -> DataFrame:
    """The rows whose id, in column ``at``, a bitmap lets through, or the others."""

    def pick(batches):
        for batch in batches:
            ids = batch.column(at).cast("int64")
            hit = may_hold(held.value, ids.fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(hit if maybe else ~hit))

    return docs.mapInArrow(pick, docs.schema)


def keep_one(docs: DataFrame, spec: JoinSpec = JoinSpec()) -> DataFrame:
    """One document of each component stays: the one with the smallest id. Rows without words or id stay; of rows that
    repeat id and text, one stays. Different texts of one id are documents of their own here; all but one of them come after
    all other ids. Texts are shuffled only for ids that go or repeat, and the few their bitmap lets through."""
    docs = _told_apart(docs)
    found = saved(ngram_join(docs.select(F.col("__vertex").alias("doc_id"), "text"), spec).documents(), "components")
    gone = found.where("component_id is not null and doc_id != component_id").select("doc_id")
    again = found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").count().where("count > 1")
    marked = saved(gone.withColumn("goes", F.lit(1)).union(again.select("doc_id", F.lit(0))).groupBy("doc_id").agg(F.max("goes").alias("goes")), "marked")
    held = id_bitmap(marked, "doc_id")
    at = docs.columns.index("__vertex")
    some = _side(docs, at, held, True).alias("d").join(marked.alias("m"), F.col("d.__vertex") == F.col("m.doc_id"), "left")
    stay = some.where("m.goes is null").select("d.*")
    once = some.where("m.goes = 0").select("d.*").dropDuplicates(["__vertex"])
    return _side(docs, at, held, False).unionByName(stay).unionByName(once).drop("__vertex")
