"""Repeated word windows against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import superkmer_dedup
from medallion.llm.common import local_scratch
from llm_rows import DOCS, edge_rows, prose


def brute(texts, size):
    words = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def rows_of(out):
    found = out.withColumn("n", F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["hi"] - r["lo"])).collect()
    return sorted(((r.doc_id, r.text, r.n_words, r.n, r.kept) for r in found), key=repr)


def check(docs, spec):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(((i, t, *b) for (i, t), b in zip(rows, brute([t for _, t in rows], spec.window))), key=repr)
    assert rows_of(superkmer_dedup.deduplicate(docs, spec)) == want


def texts():
    shared, line = prose(50, 70), prose(51, 9)
    rng = random.Random(3)
    out = [prose(i, 40) + " " + shared + " " + prose(i + 500, 25) for i in range(12)]
    out += [prose(600 + i, 30) + "\n" + line + "\t" + prose(700 + i, 30) for i in range(60)]
    out += ["la " * 90, "la " * 70 + "lu", "ka lo mi " * 30, prose(8, 3) + " " + "ka lo mi " * 12, shared, shared.replace(" ", " \n")]
    out += [" ".join(rng.choice("ab") for _ in range(300)), "é " * 40 + "\x85 \x1c " + shared, shared.upper()]
    return out


@pytest.mark.parametrize("spec", [
    superkmer_dedup.WindowSpec(window=8, gram=3),
    # keys are cut again: some by a second order, all by it and by the window's hash
    superkmer_dedup.WindowSpec(bucket_bytes=600),
    superkmer_dedup.WindowSpec(window=8, gram=3, bucket_bytes=1, orders=2),
], ids=str)
def test_repeated_windows(spark, spec):
    local_scratch(spark)
    check(spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(5), spec)


def test_repeated_windows_of_edge_rows(spark):
    """Null ids and texts, repeated rows and ids, empty texts, and columns with names used inside."""
    local_scratch(spark)
    docs = spark.createDataFrame(edge_rows(), DOCS).selectExpr("*", "1 key", "2 digest", "3 text_key", "4 starts", "5 spans", "6 cut")
    check(docs, superkmer_dedup.WindowSpec())
    assert superkmer_dedup.deduplicate(docs.limit(0)).collect() == []
    text_ids = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    assert superkmer_dedup.deduplicate(text_ids).where("doc_id = 'd0'").count() == 2


def test_numbers_are_exact():
    words = np.random.default_rng(1).integers(0, 3, 2000)
    for size in (1, 2, 3, 7, 35):
        numbers = superkmer_dedup.window_numbers(words, size)
        named = collections.defaultdict(set)
        for i, n in enumerate(numbers):
            named[n].add(tuple(words[i : i + size]))
        assert all(len(v) == 1 for v in named.values()) and len(named) == len(set().union(*named.values()))


def test_frequent_lines_are_cut_again(spark):
    """A line in every text makes one key too large; its windows are spread over finer keys."""
    local_scratch(spark)
    line = prose(9, 30)
    docs = spark.createDataFrame([(i, prose(2 * i, 20) + " " + line + " " + prose(2 * i + 1, 20)) for i in range(300)], "doc_id long, text string")
    spec = superkmer_dedup.WindowSpec(bucket_bytes=4000)
    hot, _ = superkmer_dedup._orders(docs.select("text"), spec)
    assert len(hot) >= 1 and len(hot[0]) >= 1
    bitmap = spark.sparkContext.broadcast(np.full(1 << 10, 255, np.uint8))
    sizes = superkmer_dedup._packed(docs.select("text"), spec, spark.sparkContext.broadcast(hot), bitmap)
    most = sizes.groupBy("key").agg(F.sum(F.length("packed")).alias("s")).agg(F.max("s")).first()[0]
    whole = superkmer_dedup._packed(docs.select("text"), spec, spark.sparkContext.broadcast([]), bitmap)
    assert most < whole.groupBy("key").agg(F.sum(F.length("packed")).alias("s")).agg(F.max("s")).first()[0] / 3
    check(docs, spec)
