"""Helpers the operators share: scratch tables, word hashes, bounded bitmaps, connected components."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from medallion.session import scratch_dir

#: Documents per Arrow batch: bounds a worker's memory also where texts are long.
BATCH_BYTES = 32 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(range(256)).lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: lost executors cannot lose them."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping arithmetic)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: One random 64-bit value per byte, and odd multipliers, from a fixed seed.
BYTE_CODES = np.random.default_rng(20240517).integers(1, 2**63, 256, dtype=np.uint64)
ODD = np.random.default_rng(77).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(4096, _BASE, np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.cumprod(np.full(1 << (n - 1).bit_length(), _BASE, np.uint64))
    return _POWERS


def run_hashes(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every run of word bytes."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    at = np.flatnonzero(is_word)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    within = np.arange(len(at)) - np.repeat(first, lengths)
    sums = np.add.reduceat(BYTE_CODES[raw[at]] * _powers(int(lengths.max()))[within], first)
    return mix(sums + lengths.astype(np.uint64)), starts, ends


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.frombuffer(_LOWER, np.uint8)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a whole text; fewer words make one shingle, none make none."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = _FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    words = run_hashes(raw, ~_SPACE[raw])[0]
    if not len(words):
        return words
    if len(words) < size:
        return mix(np.sum(words * ODD[size : size + len(words)], keepdims=True) + np.uint64(len(words)))
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * ODD[i]
    return np.unique(mix(total))


def each_row(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut so that the texts of one hold at most about BATCH_BYTES."""
    for batch in batches:
        cut = np.cumsum([len(t) if t else 0 for t in batch["text"]], dtype=np.int64) // BATCH_BYTES
        for k in np.unique(cut):
            yield batch[cut == k]


# -- sketches of fixed size, summed in chunks -------------------------------------------------------------------

CHUNK = 1 << 16


def packed_chunks(cells: np.ndarray) -> pd.DataFrame:
    """The chunks of an array of counts that hold anything, compressed."""
    rows = []
    for k in range(0, len(cells), CHUNK):
        part = cells[k : k + CHUNK]
        if part.any():
            part = part.astype(np.uint8) if part.max() < 256 else part.astype("<u4")
            rows.append((k // CHUNK, zlib.compress(part.tobytes(), 1)))
    return pd.DataFrame(rows, columns=["chunk", "cells"])


def unpacked(data: bytes) -> np.ndarray:
    raw = zlib.decompress(data)
    return np.frombuffer(raw, np.uint8 if len(raw) == CHUNK else "<u4").astype(np.uint32)


def summed_cells(parts: DataFrame, cells: int, shrink) -> np.ndarray:
    """Sum the packed chunks of all tasks chunk by chunk; ``shrink`` turns a summed chunk into bytes (one per cell at most).

    A task holds only the sums of its chunks, however many parts arrive; the driver gets ``cells`` bytes at most.
    """
    spark = parts.sparkSession

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch["chunk"], batch["cells"]):
                had = sums.get(chunk)
                new = unpacked(data)
                sums[chunk] = new if had is None else np.minimum(had.astype(np.uint64) + new, 0xFFFFFFFF).astype(np.uint32)
        yield pd.DataFrame([(k, shrink(v).tobytes()) for k, v in sums.items()], columns=["chunk", "cells"])

    count = max(1, min(cells // CHUNK, partitions(spark)))
    out = parts.repartition(count, "chunk").mapInPandas(total, "chunk int, cells binary")
    found = {r["chunk"]: bytes(r["cells"]) for r in out.collect()}
    width = len(next(iter(found.values()))) if found else CHUNK
    blank = bytes(width)
    return np.frombuffer(b"".join(found.get(k, blank) for k in range(cells // CHUNK)), np.uint8)


def id_bitmap(ids: DataFrame, column: str, bits: int = 1 << 24) -> Broadcast:
    """A bitmap of hashed ids with a fixed size. It lets every listed id through, and some others: a filter before a
    join on the ids, never in its place. Test with ``may_hold``."""

    def mark(batches):
        cells = np.zeros(bits, np.uint8)
        for batch in batches:
            got = batch[column].dropna().to_numpy(np.int64).view(np.uint64)
            cells[(mix(got) % np.uint64(bits)).astype(np.int64)] = 1
        yield packed_chunks(cells)

    out = ids.select(column).mapInPandas(mark, "chunk int, cells binary")
    found = summed_cells(out, bits, lambda v: np.packbits(v > 0))
    return ids.sparkSession.sparkContext.broadcast(found)


def may_hold(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(len(bitmap) * 8)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


# -- connected components ---------------------------------------------------------------------------------------


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id in ``edges(a, b)``: the smallest id reachable.

    Alternating large-star and small-star steps; each step is two aggregates and two joins over the links, its
    result written to the shared folder. No group of links is ever gathered.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    now, before = saved(now, "links"), None
    for _ in range(rounds):
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        now = saved(small.where("u != v").distinct(), "links")
        mark = tuple(now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("sum(cast(xxhash64(v, u) as decimal(38,0)))")).first())
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return ids.join(now.select(F.col("u").alias("id"), "v"), "id", "left").select("id", F.coalesce("v", "id").alias("component"))


def local_scratch(spark: SparkSession) -> None:
    """A scratch folder for a session on one machine that has none set, as in tests; removed when Python ends."""
    import atexit
    import os
    import shutil
    import tempfile

    if spark.sparkContext.master.split("[")[0] == "local":  # its Python workers find this package where the driver did
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        env = spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="medallion-llm-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{root}")


def remove_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


