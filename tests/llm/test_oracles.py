"""Whole rows of queries without SQL against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from medallion.llm import decontamination, queries, temperature_mixing
from medallion.llm.common import local_scratch
from llm_rows import DOCS, edge_rows, prose
from test_operators import brute_components, nearest_passage


def signed(n):
    return n - (1 << 64) if n >> 63 else n


# -- winnowing


def brute_print(text, gram, window):
    """Fingerprint by the definition: every window's smallest hash, the rightmost of equal ones."""
    tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", text) if t]
    hashes = []
    for i in range(max(1, len(tokens) - gram + 1) if tokens else 0):
        h = 42
        for t in tokens[i : i + gram]:
            h = xxhash.xxh64_intdigest(t.encode(), h)
        hashes.append(signed(h))
    kept = []
    for s in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = hashes[s : s + window]
        at = s + max(i for i, h in enumerate(part) if h == min(part))
        if at not in kept:
            kept.append(at)
    return [(hashes[p], p) for p in sorted(kept)]


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing_query_row_by_row(spark, tmp_path):
    spec = queries.FINE
    texts = [t for t in dict.fromkeys(r[1] for r in edge_rows()) if t is None or len(t) < 3000] + ["la " * 40, "a b a b a b a b a b a b", prose(70, 15)]
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    prints = {i: brute_print(t or "", spec.gram, spec.window) for i, t in rows}
    write = lambda p: " ".join(f"{h & (1 << 64) - 1:x}@{at}" for h, at in p)
    want = {}
    for (i, text), (j, ahead) in zip(rows, rows[1:] + rows[:1]):
        text, ahead = text or "", ahead or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + ahead[:half]
        new = brute_print(changed, spec.gram, spec.window)
        want[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), write(prints[i]), write(new), likeness(prints[i], new), likeness(prints[i], prints[j]))
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op8_winnowing"](spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    for i in want:
        assert got[i][:4] == want[i][:4], i
        assert got[i][4:] == pytest.approx(want[i][4:])


# -- sharding


def check_shards(rows, shards=8, tolerance=0.02):
    """``(key, size, shard, slot)``: shards are runs of the key order, slots their places, cuts near the equal ones."""
    ordered = sorted(rows)
    by_place = sorted(rows, key=lambda r: (r[2], r[3]))
    assert [r[0] for r in by_place] == [r[0] for r in ordered]
    assert all([r[3] for r in part] == list(range(len(part))) for part in (list(g) for _, g in itertools.groupby(by_place, key=lambda r: r[2])))
    total, below = sum(r[1] for r in rows), 0
    for s in range(shards - 1):
        below += sum(r[1] for r in rows if r[2] == s)
        assert abs(below - total * (s + 1) / shards) <= tolerance * total / shards + max(r[1] for r in rows)


def test_sharding_query_row_by_row(spark, tmp_path):
    rows = [(i, prose(i % 300, 5 + i % 50) if i % 2 else None if i % 50 == 0 else prose(1, 30)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    hashes = {r.doc_id: (r.h, r.c) for r in docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("h"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c")).collect()}
    texts, seen = dict(rows), []
    for r in queries.QUERIES["op7_sharding"](spark, str(tmp_path)).collect():
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len((texts[r.doc_id] or "").encode()) + 1, hashes[r.doc_id][1], "bytes", None)
        seen.append(((hashes[r.doc_id][0], r.doc_id), r["size"], r.shard, r.slot))
    assert len(seen) == len(rows)
    check_shards(seen)


# -- mixing


def brute_copies(rows, spec):
    """``rows(source, hash, block hash, tokens)`` to the number of times each is drawn. Weights by bisection, budgets cut in the order of
    blocks and hashes."""
    tokens = Counter()
    for source, *_, n in rows:
        tokens[source] += n
    total = sum(tokens.values())
    shares = {s: n / total for s, n in tokens.items() if n}
    most = max(shares.values())
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if max((v / most) ** (middle - 1) for v in shares.values()) <= spec.repeats else (middle, high)
    weights = {s: v**high for s, v in shares.items()}
    budget = max(tokens[s] / weights[s] for s in shares)
    out = {}
    for s in shares:
        epochs = budget * weights[s] / tokens[s]
        epochs = round(epochs) if abs(epochs - round(epochs)) < 1e-6 else epochs
        rest, blocks = math.floor(tokens[s] * (epochs - math.floor(epochs))), max(1, -(-tokens[s] // spec.block_tokens))
        own, upto, again = defaultdict(int), 0, set()
        for source, h, b, n in rows:
            if source == s and n:
                own[b % blocks, h] += n
        for (b, h), n in sorted(own.items()):
            upto += n
            if upto <= rest:
                again.add(h)
        for source, h, _, n in rows:
            if source == s:
                out[source, h] = 1 if not n else math.floor(epochs) + (h in again)
    return out


@pytest.mark.parametrize("spec", [temperature_mixing.MixSpec(repeats=4.0), temperature_mixing.MixSpec(repeats=2.5, block_tokens=60)], ids=["one block", "blocks"])
def test_mixing_row_by_row(spark, spec):
    local_scratch(spark)
    rng = random.Random(2)
    rows = [(i, prose(i, rng.randrange(1, 30)) if i % 31 else "", rng.choice(["a"] * 12 + ["b"] * 4 + ["c"])) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    h = F.xxhash64(F.lit(spec.seed), F.col("doc_id").cast("string"), F.col("text"))
    keyed = docs.select("doc_id", "source", "text", h.alias("h"), F.xxhash64(h, F.lit(spec.seed)).alias("b")).collect()
    want = brute_copies([(r.source, r.h, r.b, len(r.text.split())) for r in keyed], spec)
    names = {r.doc_id: (r.source, r.h) for r in keyed}
    got = {names[r.doc_id]: r.copies for r in temperature_mixing.mix(docs, spec).collect()}
    assert got == {k: want.get(k, 1) for k in got}


# -- the pipeline


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Bad documents, near copies, edited benchmark passages and sources of different size, through all five stages."""
    import corpus_pipeline

    rng, rows = random.Random(9), []
    for i in range(150):
        text = prose(i, 80 + i % 40)
        if i % 10 == 3:  # bad
            text = "\n".join(["CLICK HERE !!! $$$ 100% FREE >>> 12345"] * 12 + [str(rng.random())])
        elif 100 <= i < 130:  # near copies of earlier ones
            words = prose(i - 100, 80 + (i - 100) % 40).split()
            words[rng.randrange(len(words))] = f"edit{i}"
            text = " ".join(words)
        rows.append((i, text, "en", "web" if i % 7 else "books", len(text)))
    items = [(k, prose(1000 + k, 30)) for k in range(4)]
    for k, item in items:
        words = item.split()
        for at in rng.sample(range(30), 6):
            words[at] = f"x{at}"
        i = 50 + 2 * k
        rows[i] = (i, prose(i, 40) + " " + " ".join(words) + " " + prose(i + 1, 20), "en", "web", 0)
    docs = spark.createDataFrame(rows, DOCS.split(", hash")[0]).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 10 != 3), 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages, now, sf = dict(corpus_pipeline.STAGES), docs, str(tmp_path)
    rows_of = lambda df: sorted(tuple(r) for r in df.collect())

    now = stages["quality classifier"](spark, now, sf)
    left = [r for r in rows if r[0] % 10 != 3]
    assert rows_of(now) == sorted(left)

    now = stages["n-gram Jaccard join"](spark, now, sf)
    least = {d: c for d, _, c in brute_components([(r[0], r[1]) for r in left])}
    left = [r for r in left if least[r[0]] == r[0]]
    assert rows_of(now) == sorted(left) and len(left) < 130

    now = stages["benchmark decontamination"](spark, now, sf)
    bound = decontamination.DecontaminationSpec().bound
    left = [r for r in left if all(nearest_passage(item.split(), r[1].split()) > bound(30) for _, item in items)]
    assert rows_of(now) == sorted(left) and not {50, 52, 54, 56} & {r[0] for r in left}

    h = F.xxhash64(F.lit(1), F.col("doc_id").cast("string"), F.col("text"))
    keyed = docs.select("doc_id", "source", h.alias("h"), F.xxhash64(h, F.lit(1)).alias("b"), "text").where(F.col("doc_id").isin([r[0] for r in left])).collect()
    want = brute_copies([(r.source, r.h, r.b, len(r.text.split())) for r in keyed], corpus_pipeline.MIX)
    names = {r.doc_id: (r.source, r.h) for r in keyed}
    left = [r for r in left for _ in range(want[names[r[0]]])]
    now = stages["mixing sources to target weights"](spark, now, sf)
    assert rows_of(now) == sorted(left) and len(left) > len(names)

    now = stages["sharding"](spark, now, sf)
    keys = {r.doc_id: r.k for r in docs.select("doc_id", F.shiftrightunsigned(F.xxhash64("text"), 1).alias("k")).collect()}
    found = now.collect()
    assert sorted(tuple(r)[:5] for r in found) == sorted(left)
    check_shards([((keys[r.doc_id], r.doc_id), r["size"], r.shard, r.slot) for r in found])
    final = corpus_pipeline.run(spark, sf)
    assert sorted(tuple(r)[:5] for r in final.collect()) == sorted(left)
