"""Quality classifier: votes of the nearest labelled documents in a latent-semantic space.

A text becomes counts of hashed features: words, and runs of 3 and 5 byte classes (upper and lower case, digits, spaces,
each punctuation sign), which tell its form; and how varied its words and lines are. Counts are damped, weighted by inverse
document frequency and projected on the leading singular vectors of a bounded sample of labelled documents, found by
subspace iteration over Spark partitions. The projected labelled documents are broadcast (``sample_rows * rank``
numbers); every document's exact cosine with each of them is computed in blocks by one matrix product per block, and
the labels of its ``neighbours`` nearest (with all that tie with the last) are averaged, weighted by similarity.

Vectors are rounded and cosines compared to 6 digits, so that copies tie. The driver holds ``width * (rank + extra)``
numbers per partition of the sample (``sample_parts`` of them).

Nulls and edges: an empty or null text is a vector of zeros and gets the labelled share of ones; so does every text
where nothing is labelled alike, and 0.5 where nothing is labelled; rows without a label are not learned from, of a
document labelled twice the mean counts; rows with equal ids are each scored by themselves; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from medallion.llm.common import ODD, each_row, mix, run_hashes, saved

_WORDS = np.zeros(256, bool)
_WORDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Letters, digits and bytes above ASCII are classes; any other byte is a class of its own.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[0x41:0x5B], _CLASS[0x61:0x7B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 1, 2, 3, 2


@dataclass(frozen=True)
class KnnSpec:
    sample_rows: int = 4000
    sample_parts: int = 8
    width: int = 1 << 12
    rank: int = 64
    extra: int = 16
    passes: int = 4
    neighbours: int = 25
    seed: int = 3


def counts(text: str | None, width: int) -> np.ndarray:
    """Damped counts of the features of a whole text."""
    out = np.zeros(width, np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    folded = _FOLD[raw]
    words = run_hashes(folded, _WORDS[folded])[0]
    cells = width // 2
    kinds = _CLASS[raw]
    form = np.zeros(width - cells - 64)
    for size in (3, 5):
        if len(kinds) >= size:
            h = sum(kinds[i : len(kinds) - size + 1 + i] * ODD[i] for i in range(size))
            form += np.bincount((mix(h + np.uint64(size)) % np.uint64(len(form))).astype(np.int64), minlength=len(form))
    out[cells : cells + len(form)] = np.log1p(form)
    if len(words):
        out[:cells] = np.log1p(np.bincount((words % np.uint64(cells)).astype(np.int64), minlength=cells))
    lines = [x for x in text.split("\n") if x]
    # spread over 64 places: how varied, how long, how often upper case, digits and signs
    place = width - 64
    if lines:
        out[place + int(15 * len(set(lines)) / len(lines))] = 4
    if len(words):
        out[place + 16 + int(15 * len(np.unique(words)) / len(words))] = 2
    upper = float((kinds == 1).mean())
    signs = float(((kinds > 3) & (kinds != 0x20) & (kinds != 0x0A)).mean())
    out[place + 32 + min(15, int(30 * upper))] = 4
    out[place + 48 + min(15, int(60 * signs))] = 4
    return out


def matrix(texts, width: int) -> np.ndarray:
    return np.stack([counts(t, width) for t in texts]) if len(texts) else np.zeros((0, width), np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass
class Model:
    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, texts) -> np.ndarray:
        return np.round(unit(unit(matrix(texts, len(self.idf)) * self.idf) @ self.basis), 6)


def train(docs: DataFrame, labels: DataFrame, spec: KnnSpec = KnnSpec()) -> Model | None:
    """Fit on the documents that ``labels(doc_id, label)`` marks 0 or 1; None where there are none."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    total = marks.count()
    if not total:
        return None
    share = int(min(1.0, spec.sample_rows / total) * (1 << 30))
    chosen = marks.where(F.pmod(F.xxhash64(F.lit(spec.seed), "doc_id"), F.lit(1 << 30)) < share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(spec.sample_parts)).cast("int")
    sample = saved(rows.select("text", "label", part.alias("part")).repartition(spec.sample_parts, "part"), "labelled")

    def per_part(work, schema: str):
        """``work(texts, labels)`` once for each part, in the order of the parts."""

        def run(rows: pd.DataFrame) -> pd.DataFrame:
            number = int(rows["part"].iloc[0])
            rows = rows.sort_values(["text", "label"])
            return work(rows["text"].tolist(), rows["label"].to_numpy(float)).assign(part=number)

        found = sample.groupBy("part").applyInPandas(run, f"{schema}, part int").collect()
        return sorted(found, key=lambda r: r["part"])

    def frequency(texts, _):
        return pd.DataFrame({"seen": [(matrix(texts, spec.width) > 0).sum(axis=0).astype(np.float64).tobytes()], "n": [len(texts)]})

    seen = per_part(frequency, "seen binary, n long")
    if not seen:
        return None
    n = sum(r["n"] for r in seen)
    idf = (np.log((1 + n) / (1 + sum(np.frombuffer(r["seen"]) for r in seen))) + 0.1).astype(np.float32)
    rank = min(spec.rank, n)
    basis = np.linalg.qr(np.random.default_rng(spec.seed).normal(size=(spec.width, rank + spec.extra)))[0].astype(np.float32)
    for _ in range(spec.passes):
        basis = np.linalg.qr(per_sum(spark, per_part, idf, basis, spec))[0].astype(np.float32)
    # the columns span the leading singular vectors and an extra margin; rotate, keep the leading ones
    inner = basis.T @ per_sum(spark, per_part, idf, basis, spec)
    basis = (basis @ np.linalg.eigh((inner + inner.T) / 2)[1][:, ::-1][:, :rank]).astype(np.float32)
    shared = spark.sparkContext.broadcast((idf, basis))

    def vectors(texts, labels):
        idf, basis = shared.value
        made = Model(idf, basis, np.zeros(0), np.zeros(0)).project(texts)
        return pd.DataFrame({"vectors": [made.astype(np.float32).tobytes()], "labels": [labels.tobytes()]})

    made = per_part(vectors, "vectors binary, labels binary")
    return Model(idf, basis, np.concatenate([np.frombuffer(r["vectors"], np.float32).reshape(-1, rank) for r in made]), np.concatenate([np.frombuffer(r["labels"]) for r in made]))


def per_sum(spark, per_part, idf: np.ndarray, basis: np.ndarray, spec: KnnSpec) -> np.ndarray:
    """The sample's matrix, transposed, times itself times ``basis``, summed over the parts."""
    shared = spark.sparkContext.broadcast((idf, basis))

    def product(texts, _):
        idf, basis = shared.value
        rows = unit(matrix(texts, spec.width) * idf)
        return pd.DataFrame({"sum": [(rows.T @ (rows @ basis)).astype(np.float32).tobytes()]})

    return sum(np.frombuffer(r["sum"], np.float32).reshape(spec.width, -1).astype(np.float64) for r in per_part(product, "sum binary"))


def vote(model: Model, vectors: np.ndarray, neighbours: int) -> np.ndarray:
    """Weighted mean label of the nearest labelled vectors, those that tie with the last included."""
    prior = float(model.labels.mean())
    out = np.full(len(vectors), prior)
    k = min(neighbours, len(model.labels))
    for lo in range(0, len(vectors), 256):
        near = np.round(vectors[lo : lo + 256] @ model.vectors.T, 5)
        last = np.partition(near, len(model.labels) - k, axis=1)[:, -k]
        weight = np.where((near >= last[:, None]) & (near > 0), near.astype(np.float64) ** 4, 0.0)
        total = weight.sum(axis=1)
        some = total > 0
        out[lo : lo + 256][some] = (weight[some] @ model.labels) / total[some]
    return np.clip(out, 0.0, 1.0)


def score(docs: DataFrame, model: Model | None, spec: KnnSpec = KnnSpec()) -> DataFrame:
    """``doc_id, score``: how likely label 1 is, from the whole text alone."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return slim.select("doc_id", F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in each_row(batches):
            scores = [scored(shared.value, batch["text"].iloc[lo : lo + 512].tolist(), spec) for lo in range(0, len(batch), 512)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "score": np.concatenate(scores) if scores else np.zeros(0)})

    return slim.mapInPandas(run, "doc_id long, score double")


def scored(model: Model, texts: list[str | None], spec: KnnSpec) -> np.ndarray:
    return vote(model, model.project(texts), spec.neighbours)


def accepted(docs: DataFrame, model: Model | None, least: float, spec: KnnSpec = KnnSpec()) -> DataFrame:
    """The documents with a score of ``least`` or more, as they are; one pass, no shuffle."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches):
        import pyarrow as pa

        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                yield part.filter(pa.array(scored(shared.value, part.column(at).to_pylist(), spec) >= least))

    return docs.mapInArrow(keep, docs.schema)
