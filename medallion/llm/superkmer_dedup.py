"""Removal of repeated word windows by super-k-mer partitioning.

Every word covered by a window of ``window`` words whose sequence also starts anywhere else, in the same document or in
another, is removed. Windows do not cross documents.

1. *Minimisers.* The smallest hash of the ``gram``-word runs inside a window is its key: equal windows have equal keys.
   Consecutive windows with one minimiser in one place overlap almost wholly and travel as one string, the super-k-mer.
2. *Census.* Only keys and digests are counted first. A key met once in the corpus belongs to windows that occur once: a
   bitmap of the others keeps those at home. Keys whose different super-k-mers are together larger than a bucket are cut again
   by a second order of the runs, and a third; the last order is the hash of the window itself.
3. *Buckets.* Super-k-mers go to the bucket of their key, equal ones of one task as one row with their number. A task
   takes whole keys one after the other, numbers their words, and sorts windows by the numbers of their halves (1, 2, 4 ...
   words), so that two windows have one number only if all their words are equal. Numbers met twice are the repeats.
4. *Way back.* Documents are scanned again; a super-k-mer meets the repeats found in its string by digest, and the word spans
   of a text meet the text by digest.

No group is gathered that more machines cannot split: copies are one row before the exchange, a frequent line is cut by the next
order, and the two joins have one row per digest on one side (adaptive execution splits the other).

Words are compared as they are; texts and super-k-mers are told apart by 128-bit digests.

Nulls and edges: a null text has no words and an empty kept text; texts below ``window`` words lose nothing; a window that
overlaps its own repetition counts; rows repeated in the table are documents of their own, so their windows repeat; ids
are carried along and never compared, so null or repeated ids do not matter; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from medallion.llm.common import ODD, id_bitmap, may_hold, mix, partitions, saved

#: Text taken at once in a task, and super-k-mers sorted at once (more only where one text, or one key, is larger).
CUT_BYTES = 1 << 20
SORT_BYTES = 2 << 20
#: Keys that are cut again, at most: a bucket is at least this part of all super-k-mers.
HOT_KEYS = 1 << 22
UPPER = np.uint64(0xFFFFFFFF00000000)


@dataclass(frozen=True)
class WindowSpec:
    window: int = 35
    gram: int = 6
    #: Bytes of different super-k-mers of one key.
    bucket_bytes: int = 4 << 20
    #: Orders of the runs before the window's own hash decides.
    orders: int = 3


def split(text: str | None) -> list[bytes]:
    """Words: runs of bytes other than space and 0x09 to 0x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def text_key(text: str | None) -> bytes:
    return hashlib.md5((text or "").encode("utf-8", "surrogatepass")).digest()


def cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        part = np.cumsum([len(t) if t else 0 for t in batch["text"]], dtype=np.int64) // CUT_BYTES
        for k in np.unique(part):
            yield batch[part == k]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of every ``width`` values in a row, by their upper halves; the left one of equals."""
    least, have = values & UPPER | np.arange(len(values), dtype=np.uint64), 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return (least & ~UPPER).astype(np.int64)


def run_sums(words: np.ndarray, size: int) -> np.ndarray:
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : i + len(total)] * ODD[i % len(ODD)]
    return total


def window_keys(words: np.ndarray, spec: WindowSpec, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of the window at every place: its key, the place of its minimiser, and whether the last order decided both.

    ``hot`` lists, order by order, the keys that the next order cuts again.
    """
    with np.errstate(over="ignore"):
        grams, span = run_sums(words, spec.gram), spec.window - spec.gram + 1
        hashes = mix(grams)
        places = sliding_least(hashes, span)
        keys = hashes[places]
        again = np.ones(len(keys), bool)
        for order, full in enumerate(hot, 1):
            again &= np.isin(keys, full)
            if not again.any():
                break
            if order < spec.orders:
                hashes = mix(grams ^ ODD[order])
                at = sliding_least(hashes, span)
                finer = hashes[at]
            else:
                finer, at = mix(run_sums(mix(words), spec.window)), np.arange(len(keys))
            keys[again], places[again] = mix(keys[again] * ODD[order] + finer[again]), at[again]
    return keys, places, again


def super_kmers(texts: list[list[bytes]], spec: WindowSpec, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Key, text number, first word and word after the last of every super-k-mer, and whether the last order cut it."""
    lengths = np.array([len(t) for t in texts], np.int64)
    long = np.flatnonzero(lengths >= spec.window)
    if not len(long):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, bool)
    words = np.concatenate([np.fromiter(map(zlib.crc32, texts[i]), np.uint64, len(texts[i])) for i in long])
    (keys, places, fresh), ends = window_keys(words, spec, hot), np.cumsum(lengths[long])
    owner = np.repeat(np.arange(len(long)), lengths[long])[: len(keys)]
    at = np.flatnonzero(np.arange(len(keys)) + spec.window <= ends[owner])
    keys, places, owner, fresh = keys[at], places[at], owner[at], fresh[at]
    # a change of place or key starts the next one; at the end of a text windows are left out
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (keys[1:] != keys[:-1]) | (places[1:] != places[:-1]) | (owner[1:] != owner[:-1]))))
    last = np.append(first[1:], len(at)) - 1
    shift = (ends - lengths[long])[owner[first]]
    return keys[first], long[owner[first]], at[first] - shift, at[last] + spec.window - shift, fresh[first]


def window_numbers(words: np.ndarray, size: int) -> np.ndarray:
    """Number of the run of ``size`` words at each place: equal numbers, equal words. Runs of 1, 2, 4 ... words are sorted
    by the numbers of their halves; the last two overlap."""
    numbers, width = words, 1
    while width < size:
        step = min(width, size - width)
        pairs = numbers[: len(numbers) - step] * np.int64(len(words) + 1) + numbers[step:]
        numbers = np.unique(pairs, return_inverse=True)[1]
        width += step
    return numbers


def repeats(strings: list[bytes], counts: np.ndarray, size: int) -> dict[int, list[tuple[int, int]]]:
    """Per string (by number) the word spans covered by windows that start at least twice; a string stands ``counts`` times."""
    numbers: dict[bytes, int] = {}
    split_up = [s.split(b" ") for s in strings]
    lengths = np.array([len(w) for w in split_up], np.int64)
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split_up for w in ws), np.int64, int(lengths.sum()))
    del split_up, numbers
    ends = np.cumsum(lengths)
    named = window_numbers(words, size)
    owner = np.repeat(np.arange(len(strings)), lengths)[: len(named)]
    at = np.flatnonzero(np.arange(len(named)) + size <= ends[owner])
    named, owner = named[at], owner[at]
    often = np.bincount(named, weights=counts[owner])[named] >= 2
    at, owner = at[often], owner[often]
    if not len(at):
        return {}
    # windows of one string join when they touch
    apart = np.concatenate(([True], (np.diff(at) > size) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(apart)
    last = np.append(first[1:], len(at)) - 1
    shift = (ends - lengths)[owner[first]]
    out: dict[int, list[tuple[int, int]]] = {}
    for o, lo, hi in zip(owner[first].tolist(), (at[first] - shift).tolist(), (at[last] + size - shift).tolist()):
        out.setdefault(o, []).append((lo, hi))
    return out


# -- the passes over the documents ------------------------------------------------------------------------------


def _census(texts: DataFrame, spec: WindowSpec, hot: list[np.ndarray]) -> DataFrame:
    """``(key, digest, size, n)`` of the super-k-mers; once something is cut again, of the newly cut ones only."""

    hot = texts.sparkSession.sparkContext.broadcast(hot)

    def scan(batches):
        for batch in cuts(batches):
            words = [split(t) for t in batch["text"]]
            rows = []
            for key, i, lo, hi, fresh in zip(*(x.tolist() for x in super_kmers(words, spec, hot.value))):
                if fresh:
                    packed = b" ".join(words[i][lo:hi])
                    rows.append((key - (1 << 63), xxhash.xxh3_64_intdigest(packed) - (1 << 63), len(packed)))
            found = pd.DataFrame(rows, columns=["key", "digest", "size"])
            yield found.groupby(["key", "digest"], sort=False).agg(size=("size", "first"), n=("size", "size")).reset_index()

    return texts.mapInPandas(scan, "key long, digest long, size long, n long")


def _orders(texts: DataFrame, spec: WindowSpec) -> tuple[list[np.ndarray], list[DataFrame]]:
    """Order by order the keys that are cut again, and the keys that occur at least twice."""
    hot: list[np.ndarray] = []
    often = []
    while True:
        counted = _census(texts, spec, hot).groupBy("key", "digest").agg(F.first("size").alias("size"), F.sum("n").alias("n"))
        counted = saved(counted.groupBy("key").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).where("n > 1"), "census")
        often.append(counted.select("key"))
        if len(hot) == spec.orders:
            return hot, often
        total = counted.agg(F.sum("size")).first()[0] or 0
        full = counted.where(F.col("size") > max(spec.bucket_bytes, total // HOT_KEYS)).select("key").toPandas()["key"]
        if not len(full):
            return hot, often
        hot.append(np.sort(full.to_numpy(np.int64).view(np.uint64) ^ np.uint64(1 << 63)))


def _packed(texts: DataFrame, spec: WindowSpec, hot, bitmap) -> DataFrame:
    """``(key, packed, n)``: super-k-mers whose key is not alone, equal ones of a piece of a task as one row."""

    def scan(batches):
        hot_keys, marks = hot.value, bitmap.value
        for batch in cuts(batches):
            words = [split(t) for t in batch["text"]]
            rows: dict[tuple[int, bytes], int] = {}
            for key, i, lo, hi in _candidates(words, spec, hot_keys, marks):
                piece = key - (1 << 63), b" ".join(words[i][lo:hi])
                rows[piece] = rows.get(piece, 0) + 1
            yield pd.DataFrame([(k, p, n) for (k, p), n in rows.items()], columns=["key", "packed", "n"])

    return texts.mapInPandas(scan, "key long, packed binary, n long")


def _candidates(words, spec, hot, marks):
    found = super_kmers(words, spec, hot)
    keep = may_hold(marks, (found[0] ^ np.uint64(1 << 63)).view(np.int64))
    return zip(*(x[keep].tolist() for x in found[:4]))


def _sorted_buckets(packed: DataFrame, spec: WindowSpec) -> DataFrame:
    """``(digest, spans)`` of the super-k-mers with repeated windows."""

    def settle(pieces: dict[bytes, int]) -> pd.DataFrame:
        strings = list(pieces)
        spans = repeats(strings, np.fromiter(pieces.values(), np.float64, len(pieces)), spec.window)
        rows = [(xxhash.xxh3_128_digest(strings[i]), np.array(s, "<i4").tobytes()) for i, s in spans.items()]
        return pd.DataFrame(rows, columns=["digest", "spans"])

    def count(batches):
        pieces: dict[bytes, int] = {}
        size, before = 0, None
        for batch in batches:
            for key, packed, n in zip(batch["key"].tolist(), batch["packed"], batch["n"].tolist()):
                if key != before and size >= SORT_BYTES:
                    yield settle(pieces)
                    pieces, size = {}, 0
                before = key
                if packed not in pieces:
                    size += len(packed)
                pieces[packed] = pieces.get(packed, 0) + n
        if pieces:
            yield settle(pieces)

    spread = packed.repartition(partitions(packed.sparkSession), "key").sortWithinPartitions("key")
    return spread.mapInPandas(count, "digest binary, spans binary")


def _occurrences(texts: DataFrame, spec: WindowSpec, hot, bitmap, found) -> DataFrame:
    """``(digest, text_key, start)`` of super-k-mers that may hold repeated windows."""

    def scan(batches):
        hot_keys, marks, wanted = hot.value, bitmap.value, found.value
        for batch in cuts(batches):
            words = [split(t) for t in batch["text"]]
            digests, owners, starts = [], [], []
            for _, i, lo, hi in _candidates(words, spec, hot_keys, marks):
                digests.append(xxhash.xxh3_128_digest(b" ".join(words[i][lo:hi])))
                owners.append(i)
                starts.append(lo)
            keep = np.flatnonzero(may_hold(wanted, np.frombuffer(b"".join(digests), "<i8")[::2]))
            texts_ = batch["text"].tolist()
            keys = {i: text_key(texts_[i]) for i in {owners[j] for j in keep.tolist()}}
            rows = {(digests[j], keys[owners[j]], starts[j]) for j in keep.tolist()}
            yield pd.DataFrame(list(rows), columns=["digest", "text_key", "start"])

    return texts.mapInPandas(scan, "digest binary, text_key binary, start int").distinct()


def _cut(texts: pd.Series, starts: pd.Series, found: pd.Series) -> pd.DataFrame:
    """Number of words, repeated spans, and the other words of each text."""
    rows = []
    for text, begins, spans in zip(texts, starts, found):
        words, merged = split(text), []
        if begins is not None:
            for lo, hi in sorted((s + lo, s + hi) for s, b in zip(begins, spans) for lo, hi in np.frombuffer(b, "<i4").reshape(-1, 2).tolist()):
                if merged and lo <= merged[-1]["hi"]:
                    merged[-1]["hi"] = max(merged[-1]["hi"], hi)
                else:
                    merged.append({"lo": lo, "hi": hi})
        kept, at = [], 0
        for span in merged:
            kept += words[at : span["lo"]]
            at = span["hi"]
        rows.append((len(words), merged, b" ".join(kept + words[at:]).decode("utf-8", "surrogatepass")))
    return pd.DataFrame(rows, columns=["n_words", "removed", "kept"])


def deduplicate(docs: DataFrame, spec: WindowSpec = WindowSpec()) -> DataFrame:
    """``doc_id, text, n_words, removed, kept``: word spans ``[lo, hi)`` that repeat, and the other words joined by one space.

    One row per row of ``docs``.
    """
    if not 0 < spec.gram <= spec.window:
        raise ValueError("a run of words is as long as the window at most")
    spark, texts = docs.sparkSession, docs.select("text")
    hot, often = _orders(texts, spec)
    keys = often[0]
    for more in often[1:]:
        keys = keys.unionByName(more)
    bitmap, hot = id_bitmap(keys, "key"), spark.sparkContext.broadcast(hot)
    found = saved(_sorted_buckets(_packed(texts, spec, hot, bitmap), spec), "repeats")
    wanted = id_bitmap(_digest_ids(found), "id")
    places = _occurrences(texts, spec, hot, bitmap, wanted).join(found, "digest")
    spans = places.groupBy("text_key").agg(F.collect_list(F.struct("start", "spans")).alias("found"))
    spans = saved(spans.select("text_key", F.col("found.start").alias("starts"), F.col("found.spans").alias("spans")), "spans")
    key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    cut = F.pandas_udf(_cut, "n_words long, removed array<struct<lo:long,hi:long>>, kept string")
    keyed = docs.select("doc_id", "text", key.alias("text_key")).join(spans, "text_key", "left")
    return keyed.select("doc_id", "text", cut("text", "starts", "spans").alias("cut")).select("doc_id", "text", "cut.*")


def _digest_ids(found: DataFrame) -> DataFrame:
    def ids(batches):
        for batch in batches:
            yield pd.DataFrame({"id": np.frombuffer(b"".join(batch["digest"]), "<i8")[::2]})

    return found.select("digest").mapInPandas(ids, "id long")
