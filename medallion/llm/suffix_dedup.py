"""Removal of repeated byte strings by merging Burrows-Wheeler transforms.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller id, or same document and earlier) is
removed. Strings do not cross documents.

1. *Anchors.* Of the ``gram``-byte hashes inside each string of ``length`` bytes, the smallest (rightmost of equal ones) is its
   anchor, so equal strings have equal anchors at the same distance. Anchors are met by hash in one exchange; an anchor
   that occurs once belongs to strings that occur once, and is dropped. The strings of one anchor start next to each other;
   together they are its *context*. Exact copies of whole documents are settled by their digest before this.
2. Equal contexts are settled by an aggregate: the first stays in the search, the others are repeats throughout.
3. *Transforms.* Contexts are dealt to ranges of anchors and, within each, to shards; each shard sorts its own suffixes
   and keeps their Burrows-Wheeler transform.
4. *Merge.* One task per range interleaves its shards' transforms: all suffixes start in one block, and each round moves
   every suffix to its predecessor (a stable distribution by the transform's symbol), so that after round ``h`` blocks hold
   suffixes with ``h`` common bytes. Suffixes alone in a block leave; the round in which neighbours part is their common
   prefix. What is left after ``length`` rounds are the repeated intervals. No suffix is sorted again.
5. In each interval the earliest string stays and the others' bytes are removed.

A range of anchors holds about ``range_bytes``. An anchor whose distinct contexts alone are more than ``anchor_bytes`` (the border of a passage that
very many documents share) is not merged in one task: its strings are dealt out one by one and equal ones met by an
aggregate, which gives the same result.

Nulls and edges: a null text is empty; null ids come first; rows equal in id and text count as one document, each is cut
alike; rows with one id and different texts are ordered by a checksum of the text; texts below ``length`` bytes lose nothing;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from medallion.llm.common import BYTE_CODES, each_row, id_bitmap, may_hold, mix, saved

NULL_ID = -(2**63)
#: Contexts that a task hands on at once: bounds its memory where documents hold many.
OUT_ROWS = 1 << 14


@dataclass(frozen=True)
class DedupSpec:
    length: int = 100
    gram: int = 40
    shards: int = 4
    range_bytes: int = 1 << 20
    #: Distinct contexts of one anchor that one task merges at most.
    anchor_bytes: int = 4 << 20

    @property
    def span(self) -> int:
        """Grams in a string."""
        return self.length - self.gram + 1


def as_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


# -- anchors ----------------------------------------------------------------------------------------------------


def gram_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` bytes, by doubling: runs of 1, 2, 4, ... bytes, then the runs that add up to ``size``."""
    base = np.uint64(0x9E3779B97F4A7C15)
    part, width, power = BYTE_CODES[raw], 1, base
    out, done, rest = None, 0, size
    while rest:
        if rest & 1:
            out = part if out is None else out[: len(raw) - done - width + 1] * power + part[done : len(raw) - width + 1]
            done += width
        rest >>= 1
        if rest:
            part = part[:-width] * power + part[width:]
            power, width = power * power, width * 2
    return mix(out[: len(raw) - size + 1])


def anchors(raw: np.ndarray, spec: DedupSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place, first and last string start of each anchor of a text, in order."""
    none = np.zeros(0, np.int64)
    if len(raw) < spec.length:
        return none.astype(np.uint64), none, none, none
    with np.errstate(over="ignore"):
        hashes = gram_hashes(raw, spec.gram)
    # smallest in each window of ``span`` hashes by doubling, with its place; on ties the right one
    least, at, width = hashes, np.arange(len(hashes)), 1
    while width < spec.span:
        step = min(width, spec.span - width)
        a, b = least[: len(least) - step], least[step:]
        right = b <= a
        least, at = np.where(right, b, a), np.where(right, at[step:], at[: len(at) - step])
        width += step
    cut = np.flatnonzero(np.concatenate(([True], np.diff(at) != 0)))
    return hashes[at[cut]], at[cut], cut, np.append(cut[1:], len(at)) - 1


# -- transforms and their merge ---------------------------------------------------------------------------------


def transform(strings: list[bytes]) -> np.ndarray:
    """Burrows-Wheeler transform (symbols 1 to 256, 0 for the end mark) of strings. The end mark of string ``i`` is smaller
    than that of ``i + 1`` and than every byte. Suffixes are sorted by doubling."""
    lengths = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.zeros(int(lengths.sum()) + len(strings), np.int64)
    mark = np.ones(len(symbols), bool)
    mark[ends] = False
    symbols[mark] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    rank = symbols + len(strings)
    rank[ends] = np.arange(len(strings))
    width, count = 1, 0
    while count < len(rank):
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-width or None] = rank[width:] + 1
        # what lies beyond an end mark never decides: the mark itself is unique
        key = rank * np.int64(len(rank) + len(strings) + 300) + ahead
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.concatenate(([0], (np.diff(key[order]) != 0).astype(np.int64))))
        count, width = int(rank.max()) + 1, width * 2
    before = symbols[order - 1]
    starts = ends - lengths
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    before[first[order]] = 0
    return before.astype(np.uint16)


def predecessors(bwt: np.ndarray) -> np.ndarray:
    """Row of the suffix one symbol longer, for every row; rows with an end mark as symbol lead nowhere (-1)."""
    order = np.argsort(bwt, kind="stable")
    out = np.empty(len(bwt), np.int32)
    out[order] = np.arange(len(bwt), dtype=np.int32)
    out[bwt == 0] = -1
    return out


def repeated_intervals(bwts: list[np.ndarray], depth: int, offsets: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Merge transforms: rows (numbered through all of them) whose suffixes share ``depth`` symbols with another's, and the
    interval each belongs to. Rows of an interval are next to each other, in the order of the merged suffixes.

    Every round leads a row one place back in its string, so a row of an offset below ``depth`` leaves before the last
    round. Where the ``offsets`` of the rows are given, such rows are left out from the start."""
    bwt = np.concatenate(bwts)
    base = np.cumsum([0, *map(len, bwts)])
    back = np.concatenate([np.where((p := predecessors(b)) >= 0, p + base[i], -1) for i, b in enumerate(bwts)])
    back = back.astype(np.int32)
    rows = np.arange(len(bwt), dtype=np.int32) if offsets is None else np.flatnonzero(offsets >= depth).astype(np.int32)
    block = np.zeros(len(rows), np.int32)
    for _ in range(depth):
        symbol = bwt[rows]
        go = symbol > 0
        if not go.all():
            rows, symbol, block = rows[go], symbol[go], block[go]
        if not len(rows):
            break
        symbol = (symbol - 1).astype(np.uint8)
        order = np.argsort(symbol, kind="stable")
        rows, symbol, block = back[rows[order]], symbol[order], block[order]
        opens = np.ones(len(rows) + 1, bool)
        opens[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        stay = ~(opens[:-1] & opens[1:])
        block = np.cumsum(opens[:-1], dtype=np.int32)
        if not stay.all():
            rows, block = rows[stay], block[stay]
    return rows, block


def places(bwts: list[np.ndarray], lengths: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """String (numbered through all transforms) and offset of the suffix of every row, read off the transforms."""
    first = 0
    owners, offsets = [], []
    for bwt, size in zip(bwts, lengths):
        back = predecessors(bwt)
        owner, offset = np.empty(len(bwt), np.int32), np.empty(len(bwt), np.int32)
        rows, live = np.arange(len(size)), np.arange(len(size))
        step = 0
        while len(live):
            owner[rows], offset[rows] = first + live, size[live] - step
            step += 1
            on = size[live] >= step
            live, rows = live[on], back[rows[on]]
        owners.append(owner)
        offsets.append(offset)
        first += len(size)
    return np.concatenate(owners), np.concatenate(offsets)


# -- the Spark job ----------------------------------------------------------------------------------------------

KEY = "id long, tie long"


def _keyed(batch: pd.DataFrame) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    texts = [as_bytes(t) for t in batch["text"]]
    return batch["id"].to_numpy(np.int64), texts, np.array([zlib.crc32(t) for t in texts], np.int64)


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"), "text")


def _mark(id_: Column, tie: Column) -> Column:
    return F.xxhash64(id_, tie)


def _repeating(rows: DataFrame) -> DataFrame:
    """Rows whose anchor has another row, next to it in order."""
    near = Window.partitionBy("h").orderBy("id", "tie", "at")
    seen = rows.withColumns({"__a": F.lag("at").over(near), "__b": F.lead("at").over(near)})
    return seen.where("__a is not null or __b is not null").drop("__a", "__b")


def _with_text(docs: DataFrame, wanted: DataFrame):
    """Two parts of the documents (id, text, tie): those that a bitmap of the keys in ``wanted`` lets through, and the rest."""
    held = id_bitmap(wanted.select(_mark(F.col("id"), F.col("tie")).alias("mark")), "mark")
    rows = _slim(docs).withColumn("tie", F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = rows.withColumn("mark", _mark(F.col("id"), F.col("tie")))

    def pick(hit: bool):
        def run(batches):
            for batch in batches:
                yield batch[may_hold(held.value, batch["mark"].to_numpy(np.int64)) == hit]

        return rows.mapInPandas(run, "id long, text string, tie long, mark long").drop("mark")

    return pick


def repeats(docs: DataFrame, spec: DedupSpec = DedupSpec()) -> DataFrame:
    """``id, tie, lo, hi``: documents and first and last start of strings that start earlier too (several rows each). A
    copy of an earlier document is one row from 0 to its last start."""
    rows = _slim(docs)

    def digests(batches):
        for batch in each_row(batches):
            ids, texts, ties = _keyed(batch)
            yield pd.DataFrame({"id": ids, "tie": ties, "n": [len(t) for t in texts], "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in texts]})

    slim = saved(rows.mapInPandas(digests, f"{KEY}, n long, digest binary").where(F.col("n") >= spec.length), "digests")
    first = slim.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    copies = saved(slim.join(first, "digest").where("id != first").select("id", "tie", "n").distinct(), "copies")

    def meet(batches):
        for batch in each_row(batches):
            ids, texts, ties = _keyed(batch)
            found = [anchors(np.frombuffer(t, np.uint8), spec)[:2] for t in texts]
            sizes = [len(f[0]) for f in found]
            yield pd.DataFrame({
                "h": np.concatenate([f[0] for f in found]).view(np.int64) if found else np.zeros(0, np.int64),
                "id": np.repeat(ids, sizes), "tie": np.repeat(ties, sizes),
                "at": np.concatenate([f[1] for f in found]).astype(np.int32) if found else np.zeros(0, np.int32),
            })

    met = saved(_repeating(rows.mapInPandas(meet, f"h long, {KEY}, at int")), "anchors")
    met = saved(_repeating(met.join(copies, ["id", "tie"], "left_anti").distinct()), "anchors")
    wanted = saved(met.groupBy("id", "tie").agg(F.collect_set("at").alias("at")), "wanted")

    names = ["h", "id", "tie", "lo", "hi", "digest", "part"]

    def contexts(batches):
        for batch in batches:
            out = []
            for id_, tie, text, at in zip(batch["id"], batch["tie"], batch["text"], batch["at"]):
                raw = as_bytes(text)
                h, place, lo, hi = anchors(np.frombuffer(raw, np.uint8), spec)
                for i in np.flatnonzero(np.isin(place, at)):
                    part = raw[lo[i] : hi[i] + spec.length]
                    out.append((int(h[i].view(np.int64)), id_, tie, int(lo[i]), int(hi[i]), hashlib.blake2b(part, digest_size=12).digest(), part))
                    if len(out) == OUT_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
            yield pd.DataFrame(out, columns=names)

    texts = _with_text(docs, wanted)(True).join(wanted, ["id", "tie"])
    parts = saved(texts.mapInPandas(contexts, f"h long, {KEY}, lo int, hi int, digest binary, part binary"), "contexts")
    own = F.struct("id", "tie", "lo", "hi", "part")
    firsts = saved(parts.groupBy("h", "digest").agg(F.min(own).alias("f")).select("h", "digest", "f.*"), "distinct")
    same = parts.drop("part").join(firsts.select("h", "digest", *(F.col(c).alias(f"f_{c}") for c in ("id", "tie", "lo"))), ["h", "digest"])
    same = same.where("not (id = f_id and tie = f_tie and lo = f_lo)").select("id", "tie", "lo", "hi")

    sizes = firsts.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.length("part") + 1).alias("bytes")).where("n > 1")
    sizes = saved(sizes, "sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(1, -(-total // spec.range_bytes))
    some = firsts.drop("digest").join(sizes, "h")
    merged = _merged(some.where(F.col("bytes") <= spec.anchor_bytes), ranges, spec)
    single = _single(some.where(F.col("bytes") > spec.anchor_bytes), spec)
    whole = copies.select("id", "tie", F.lit(0).alias("lo"), (F.col("n") - spec.length).cast("int").alias("hi"))
    return same.unionByName(merged).unionByName(single).unionByName(whole)


def _merged(some: DataFrame, ranges: int, spec: DedupSpec) -> DataFrame:
    """Repeats among distinct contexts: transforms per range and shard, then one merge per range."""
    dealt = some.select(
        F.pmod(F.xxhash64("h"), F.lit(ranges)).alias("range"), F.pmod(F.xxhash64("id", "lo"), F.lit(spec.shards)).cast("int").alias("shard"),
        "id", "tie", "lo", "part",
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["id", "tie", "lo"])
        made = transform(list(rows["part"]))
        return pd.DataFrame({
            "range": [rows["range"].iloc[0]], "shard": [rows["shard"].iloc[0]], "bwt": [zlib.compress(made.tobytes(), 1)],
            "size": [rows["part"].str.len().to_numpy(np.int64)], "id": [rows["id"].to_numpy()], "tie": [rows["tie"].to_numpy()], "lo": [rows["lo"].to_numpy(np.int64)],
        })

    shape = "range long, shard int, bwt binary, size array<long>, id array<long>, tie array<long>, lo array<long>"
    shards = saved(dealt.groupBy("range", "shard").applyInPandas(build, shape), "transforms")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard")
        bwts = [np.frombuffer(zlib.decompress(b), np.uint16) for b in rows["bwt"]]
        lengths = [np.asarray(s, np.int64) for s in rows["size"]]
        owner, offset = places(bwts, lengths)
        at, block = repeated_intervals(bwts, spec.length, offset)
        owner, offset = owner[at], offset[at]
        ids, ties, los = (np.concatenate([np.asarray(x, np.int64) for x in rows[c]]) for c in ("id", "tie", "lo"))
        id_, tie, start = ids[owner], ties[owner], los[owner] + offset
        order = np.lexsort((start, tie, id_, block))
        block, id_, tie, start = block[order], id_[order], tie[order], start[order]
        again = np.concatenate(([False], block[1:] == block[:-1])) if len(block) else np.zeros(0, bool)
        id_, tie, start = id_[again], tie[again], start[again]
        order = np.lexsort((start, tie, id_))
        id_, tie, start = id_[order], tie[order], start[order]
        opens = np.concatenate(([True], (np.diff(id_) != 0) | (np.diff(tie) != 0) | (np.diff(start) > 1))) if len(id_) else np.zeros(0, bool)
        lo = np.flatnonzero(opens)
        hi = np.append(lo[1:], len(id_)) - 1 if len(lo) else lo
        return pd.DataFrame({"id": id_[lo], "tie": tie[lo], "lo": start[lo].astype(np.int32), "hi": start[hi].astype(np.int32)})

    return shards.groupBy("range").applyInPandas(merge, f"{KEY}, lo int, hi int")


def _single(some: DataFrame, spec: DedupSpec) -> DataFrame:
    """The same for contexts of anchors too common for one task: every string is a row, equal ones meet in an aggregate."""
    at = F.explode(F.sequence(F.lit(0), F.length("part") - spec.length)).alias("at")
    each = some.select("h", "id", "tie", "lo", "part", at)
    each = each.select(F.md5(F.substring("part", F.col("at") + 1, F.lit(spec.length))).alias("s"), "id", "tie", (F.col("lo") + F.col("at")).alias("lo"))
    first = each.groupBy("s").agg(F.min(F.struct("id", "tie", "lo")).alias("f"), F.count("*").alias("n")).where("n > 1")
    return each.join(first, "s").where("struct(id, tie, lo) != f").select("id", "tie", "lo", F.col("lo").alias("hi"))


def covered(size: int, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
    """Which bytes of a text the strings that start from each lo to hi cover."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, np.minimum(hi + length, size), -1)
    return np.cumsum(edge[:size]) > 0


def deduplicate(docs: DataFrame, spec: DedupSpec = DedupSpec()) -> DataFrame:
    """``doc_id, n_bytes, removed (array of structs lo, hi), kept (binary)``: the bytes of each document that stay."""
    found = saved(repeats(docs, spec), "repeats")
    marks = saved(found.groupBy("id", "tie").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi")), "marks")
    pick = _with_text(docs, marks)

    def cut(batches):
        for batch in batches:
            out = []
            for id_, text, lo, hi in zip(batch["id"], batch["text"], batch["lo"], batch["hi"]):
                raw = np.frombuffer(as_bytes(text), np.uint8)
                spans: list[dict] = []
                if lo is not None:
                    gone = covered(len(raw), np.asarray(lo, np.int64), np.asarray(hi, np.int64), spec.length)
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
                    spans = [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2])]
                    kept = raw[~gone].tobytes()
                else:
                    kept = raw.tobytes()
                out.append((None if id_ == NULL_ID else id_, len(raw), spans, kept))
            made = pd.DataFrame(out, columns=["doc_id", "n_bytes", "removed", "kept"])
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    shape = "doc_id long, n_bytes long, removed array<struct<lo: long, hi: long>>, kept binary"
    some = pick(True).join(marks, ["id", "tie"], "left").select("id", "text", "lo", "hi").mapInPandas(cut, shape)
    rest = pick(False).select("id", F.coalesce("text", F.lit("")).alias("text"))
    doc = F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id")
    spans = F.array().cast("array<struct<lo: bigint, hi: bigint>>")
    rest = rest.select(doc, F.octet_length("text").cast("long").alias("n_bytes"), spans.alias("removed"), F.col("text").cast("binary").alias("kept"))
    return some.unionByName(rest)
