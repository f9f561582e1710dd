"""Benchmark decontamination by shared word pairs, without loss, and exact word edit distance.

Texts are sequences of lower-cased words. An item of ``n`` words occurs in a document where the document has a passage
within ``k = floor(max_error * n)`` word edits (insert, delete, replace) of it. Search:

1. An edit spoils two pairs of neighbouring words at most. So a passage within the bound holds the item's pairs at
   ``n - 1 - 2 k`` of its places at least, and it has ``n + k`` words at most. Where that number is below one (items of one
   word, bounds above two fifths) single words take the place of pairs: at least ``n - k``.
2. An index lists for each pair the items that hold it. The places of a document where an item's pairs stand, in order,
   give a candidate wherever as many as needed lie within the longest passage. This leaves out no passage: recall is 1.
3. Candidates are verified by the exact edit distance of the whole item to the best passage around them.

Items are read in blocks of at most ``block_words`` words, so what is broadcast has a fixed bound; documents are read
once per block, and never shuffled.

Nulls and edges: a null or wordless item or document matches nothing; repeated items are all reported; rows with equal
ids are searched each by itself; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from medallion.llm.common import BATCH_BYTES, ODD, each_row, mix, run_hashes

_WORDS = np.zeros(256, bool)
_WORDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class DecontaminationSpec:
    max_error: float = 0.3
    block_words: int = 1 << 18

    def __post_init__(self):
        if not 0 <= self.max_error < 1:
            raise ValueError("max_error is at least 0 and below 1")

    def bound(self, n: int) -> int:
        return int(self.max_error * n)


def lowered(text: str) -> str:
    """Lower case with as many code points as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def word_hashes(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, byte starts and ends of the words, and the bytes of the lowered text."""
    raw = np.frombuffer(lowered(text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return *run_hashes(raw, _WORDS[raw]), raw


def symbols(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the next; one fewer than words."""
    return mix(words[:-1] * ODD[40] + words[1:] * ODD[41])


#: Words of a piece of documents that is searched at once, and places of symbols that are listed at once, about.
PIECE_WORDS, PLACES = 1 << 20, 1 << 22


class Postings:
    """The items that hold a symbol, each once, for every symbol of ``made``: item numbers and their symbols."""

    def __init__(self, made: dict[int, np.ndarray]):
        symbol = np.concatenate([np.zeros(0, np.uint64), *(np.unique(m) for m in made.values())])
        owner = np.repeat(np.array(list(made), np.int64), [len(np.unique(m)) for m in made.values()])
        self.vocabulary, self.symbol = np.unique(symbol, return_inverse=True)
        order = np.lexsort((owner, self.symbol))
        self.symbol, self.owner = self.symbol[order], owner[order]

    def places(self, symbols_: np.ndarray):
        """``(items, places)`` of the symbols that items hold, ascending; whole items at a time, about PLACES of them or
        what one item has."""
        if not len(self.vocabulary):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, symbols_), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == symbols_)
        at = at[known]
        counts = np.bincount(at, minlength=len(self.vocabulary))
        totals = np.bincount(self.owner, weights=counts[self.symbol])
        part = (np.cumsum(totals) // PLACES).astype(np.int64)
        for p in np.unique(part[totals > 0]):
            held = part[self.owner] == p
            owner, sizes = self.owner[held], np.bincount(self.symbol[held], minlength=len(self.vocabulary))
            first, many = np.cumsum(sizes) - sizes, sizes[at]
            within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items = owner[np.repeat(first[at], many) + within]
            order = np.argsort(items, kind="stable")
            yield items[order], np.repeat(known, many)[order]


class Index:
    """The pairs of a block of items; small, bounded, the same on every worker."""

    def __init__(self, items: list[tuple[int, np.ndarray]], spec: DecontaminationSpec):
        self.spec = spec
        self.items = items
        sizes = np.array([len(w) for _, w in items])
        limits = np.array([spec.bound(len(w)) for _, w in items])
        by_pair = sizes - 1 - 2 * limits >= 1
        self.longest = sizes + limits
        self.least = np.where(by_pair, sizes - 1 - 2 * limits, sizes - limits)
        self.postings = {  # words of a symbol: items
            2: Postings({i: symbols(w) for i, (_, w) in enumerate(items) if by_pair[i]}),
            1: Postings({i: w for i, (_, w) in enumerate(items) if not by_pair[i]}),
        }

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(document, item, first word, end)``: apart from each other, the stretches that hold every passage within the
        bound, over several documents laid end to end; ``bounds``: where each begins."""
        found = []
        for width, postings in self.postings.items():
            for items, places in postings.places(symbols(words) if width == 2 else words):
                docs = np.searchsorted(bounds, places, "right") - 1
                if width == 2:  # no pair reaches into the next text
                    inside = places + 1 < bounds[docs + 1]
                    items, places, docs = items[inside], places[inside], docs[inside]
                last = np.arange(len(items)) + self.least[items] - 1
                one = np.flatnonzero(last < len(items))
                two = last[one]
                near = (items[one] == items[two]) & (docs[one] == docs[two]) & (places[two] - places[one] <= self.longest[items[one]] - width)
                one, two = one[near], two[near]
                i, d = items[one], docs[one]
                a = np.maximum(bounds[d], places[two] + width - self.longest[i])
                b = np.minimum(bounds[d + 1], places[one] + self.longest[i])
                opens = np.ones(len(i) + 1, bool)
                opens[1:-1] = (i[1:] != i[:-1]) | (d[1:] != d[:-1]) | (a[1:] > b[:-1])
                found += zip(*(x.tolist() for x in (d[opens[:-1]], i[opens[:-1]], a[opens[:-1]], b[opens[1:]])))
        return sorted(found)


def passage(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Edit distance of an item to the nearest passage of a text, and that passage's first word and end."""

    def nearest_end(x, y):
        steps = np.arange(len(y) + 1)
        row = np.zeros(len(y) + 1, np.int64)
        for i, w in enumerate(x):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != w))
            row = np.minimum.accumulate(new - steps) + steps
        end = int(np.argmin(row))
        return int(row[end]), end

    distance, end = nearest_end(item, text)
    start = end - nearest_end(item[::-1], text[:end][::-1])[1]
    return distance, start, end


def occurrences(index: Index, words: np.ndarray, bounds: np.ndarray):
    """Verified ``(document, item, distance, first word, end)``; of overlapping ones of an item, the nearest."""
    first = 0
    while first < len(bounds) - 1:  # a piece at a time, of one document at least
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PIECE_WORDS, "right")) - 1)
        base, piece = bounds[first], words[bounds[first] : bounds[last]]
        for doc, i, a, b in index.candidates(piece, bounds[first : last + 1] - base):
            item = index.items[i][1]
            n, limit = len(item), index.spec.bound(len(item))
            low = int(bounds[first + doc] - base)
            todo, hits = [(a, b)], set()
            while todo:  # the nearest passage, then what lies left and right of it
                x, y = todo.pop()
                if y - x < n - limit or y <= x:
                    continue
                distance, start, end = passage(item, piece[x:y])
                if distance <= limit:
                    hits.add((distance, x + start, x + end))
                    todo += [(x, x + start), (x + end, y)] if end > start else []
            for distance, x, y in sorted(hits):
                yield first + doc, i, distance, x - low, y - low
        first = last


def blocks(benchmark: DataFrame, spec: DecontaminationSpec):
    """Items in blocks whose words are bounded; an item longer than a block is a block by itself."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    sized = sized.withColumn("words", F.regexp_count("text", F.lit(r"[\p{L}\p{N}]+")) + 1)
    totals = sized.groupBy(F.pmod(F.xxhash64("item_id", "text"), F.lit(1 << 12)).alias("part")).agg(F.sum("words").alias("words")).orderBy("part").collect()
    groups, room = [[]], spec.block_words
    for r in totals:
        if r["words"] > room and groups[-1]:
            groups.append([])
            room = spec.block_words
        groups[-1].append(r["part"])
        room -= r["words"]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(1 << 12))
    for group in groups:
        if group:
            rows = sized.where(part.isin(group)).select("item_id", "text").collect()
            items = [(r["item_id"], word_hashes(r["text"])[0]) for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))]
            items = [(i, w) for i, w in items if len(w)]
            if items:
                yield Index(items, spec)


FOUND = "doc_id long, item_id long, distance int, n_words int, start long, end long, passage string"


def laid_out(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Words of several texts end to end, and where each text begins."""
    raws = [lowered(t or "").encode("utf-8", "surrogatepass") for t in texts]
    words, bounds, at = [], [np.zeros(1, np.int64)], 0
    while at < len(raws):  # a piece at a time, as many texts as fit in a cache
        to, size = at, 0
        while to < len(raws) and (to == at or size + len(raws[to]) < 1 << 18):
            size += len(raws[to]) + 1
            to += 1
        raw = np.frombuffer(b" ".join(raws[at:to]) + b" ", np.uint8)
        hashes, starts, _ = run_hashes(raw, _WORDS[raw])
        ends = np.cumsum([len(r) + 1 for r in raws[at:to]])
        words.append(hashes)
        bounds.append(bounds[-1][-1] + np.searchsorted(starts, ends))
        at = to
    return np.concatenate(words or [np.zeros(0, np.uint64)]), np.concatenate(bounds)


def find_passages(docs: DataFrame, benchmark: DataFrame, spec: DecontaminationSpec = DecontaminationSpec()) -> DataFrame:
    """Where items occur in ``docs(doc_id, text)``: item, word edits, words of the item, code points from and to."""
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = None
    for index in blocks(benchmark, spec):
        shared = spark.sparkContext.broadcast(index)

        def search(batches, shared=shared):
            index = shared.value
            for batch in each_row(batches):
                texts, ids_ = batch["text"].tolist(), batch["doc_id"].tolist()
                rows = []
                for d, i, distance, a, b in occurrences(index, *laid_out(texts)):
                    _, starts, ends, raw = word_hashes(texts[d])
                    ahead = np.cumsum((raw[: ends[b - 1]] & 0xC0) != 0x80)
                    begin, end = int(ahead[starts[a]]) - 1, int(ahead[-1])
                    rows.append((ids_[d], index.items[i][0], distance, len(index.items[i][1]), begin, end, texts[d][begin:end]))
                found = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "n_words", "start", "end", "passage"])
                yield found.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = slim.mapInPandas(search, FOUND)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], FOUND)


def decontaminated(docs: DataFrame, benchmark: DataFrame, spec: DecontaminationSpec = DecontaminationSpec()) -> DataFrame:
    """The documents in which no item occurs, as they are: one pass per block of items, without a shuffle."""
    at = docs.columns.index("text")
    for index in blocks(benchmark, spec):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, shared=shared):
            for batch in batches:
                column = batch.column(at)
                sizes = np.cumsum(pc.fill_null(pc.binary_length(column.cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False))
                for part in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(sizes // BATCH_BYTES)) + 1):
                    if len(part):
                        rows = batch.slice(int(part[0]), len(part))
                        hit = np.zeros(len(rows), bool)
                        for d, *_ in occurrences(shared.value, *laid_out(rows.column(at).to_pylist())):
                            hit[d] = True
                        yield rows.filter(pa.array(~hit))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
