"""Language identification by a linear-chain conditional random field over the words of a text.

Words (runs of letters) have features: character n-grams between word borders (so prefixes and suffixes are among them,
marked by the border), longer affixes, the word, its shape, and the strength of the word in each language's lexicon. All
but the last are hashed to ``width`` weights per language. Transition weights between the languages of neighbouring
words are learned with them, on code-switched sequences that are spliced from labelled texts. Labels and probabilities of
words come from forward-backward over the whole text, so a short foreign passage is labelled as such while one
odd word is not.

Training runs on a bounded sample: about ``sample_rows`` labelled texts, as many from each language, chosen by a hash of
the id. It is dealt to ``blocks`` fixed blocks (so the model does not depend on the cluster); every round trains in each
block from the common weights, and the blocks' weights are averaged. The driver holds ``blocks`` models, of ``width``
times the number of languages each. Prediction is one pass over the documents, without a shuffle.

Nulls and edges: a text that is null or has no letter is ``und`` with score 0; without labelled rows every text is
``und``; null labels are not learned from; rows with equal ids and repeated rows are each predicted by themselves; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from medallion.llm.common import ODD, mix, saved

_WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class CrfSpec:
    sample_rows: int = 2000
    lexicon_words: int = 2000
    width: int = 1 << 16
    blocks: int = 4
    rounds: int = 3
    sequence: int = 48
    batch: int = 32
    rate: float = 0.3
    seed: int = 11
    #: Words whose scores a worker remembers at most; further ones are scored again when they come.
    remembered: int = 400_000


def words_of(text: str | None) -> list[str]:
    """Words in lower case; a run without a letter (superscript digits) is none."""
    return [w for w in _WORDS.findall(text.lower()) if has_letter(w)] if text else []


def has_letter(word: str) -> bool:
    return word[0].isalpha() or any(c.isalpha() for c in word)


class Features:
    """Numbers of the features of words; the lexicon's are ``width + 4 * language + strength``."""

    def __init__(self, width: int, languages: int, lexicon: dict[str, tuple[int, ...]]):
        self.width, self.languages, self.lexicon = width, languages, lexicon
        self.total = width + 4 * languages

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Feature numbers of all words end to end, and where each word begins."""
        marked = [f"\x02{w}\x03" for w in words]
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(m) for m in marked], np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        ends = np.cumsum(lengths)
        left = ends[owner] - np.arange(len(codes))  # characters to the word's end
        numbers, owners = [], []
        h = np.zeros(len(codes), np.uint64)
        for size in range(1, 5):
            shifted = np.concatenate((codes[size - 1 :], np.zeros(size - 1, np.uint64)))
            h = h + (shifted + np.uint64(1)) * ODD[size]
            ok = left >= size
            numbers.append(mix(h[ok] + np.uint64(size)) % np.uint64(self.width))
            owners.append(owner[ok])
        whole = np.add.reduceat((codes + np.uint64(1)) * ODD[16 + (lengths[owner] - left) % 32], ends - lengths)
        numbers.append(mix(whole + lengths.astype(np.uint64)) % np.uint64(self.width))
        owners.append(np.arange(len(words)))
        shape = np.minimum(lengths, 15).astype(np.uint64)
        numbers.append(mix(shape + np.uint64(9000)) % np.uint64(self.width))
        owners.append(np.arange(len(words)))
        known = [(self.width + n, i) for i, w in enumerate(words) for n in self.lexicon.get(w, ())]
        numbers.append(np.array([n for n, _ in known], np.uint64))
        owners.append(np.array([i for _, i in known], np.int64))
        numbers, owners = np.concatenate(numbers).astype(np.int64), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        counts = np.bincount(owners, minlength=len(words))
        return numbers[order], np.cumsum(counts) - counts


def forward_backward(scores: np.ndarray, trans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probabilities of the labels of every word of several texts.

    ``scores``: one row per word, text by text, longest text first; ``lengths`` of the texts, descending.
    """
    first = np.cumsum(lengths) - lengths
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")  # texts longer than t
    for t in range(longest):
        at = first[: active[t]] + t
        v = e[at] if t == 0 else (alpha[at - 1] @ a) * e[at]
        alpha[at] = v / v.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        v = (beta[at + 1] * e[at + 1]) @ a.T
        beta[at] = v / v.sum(axis=1, keepdims=True)
    p = alpha * beta
    return p / p.sum(axis=1, keepdims=True)


def pair_probabilities(scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences of one length (sequence, word, label): probabilities of labels, and expected label pairs."""
    n, length, k = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    a = np.exp(trans - trans.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for t in range(length):
        v = e[:, t] if t == 0 else (alpha[:, t - 1] @ a) * e[:, t]
        alpha[:, t] = v / v.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 2, -1, -1):
        ahead = beta[:, t + 1] * e[:, t + 1]
        joint = alpha[:, t, :, None] * a[None] * ahead[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        v = ahead @ a.T
        beta[:, t] = v / v.sum(axis=1, keepdims=True)
    p = alpha * beta
    return p / p.sum(axis=2, keepdims=True), pairs


@dataclass
class Model:
    languages: list[str]
    features: Features
    weights: np.ndarray
    trans: np.ndarray


def spliced(texts: list[tuple[int, list[str]]], spec: CrfSpec, rng) -> tuple[list[str], np.ndarray]:
    """All words of the texts as one long row of passages of 3 to 30 words from changing texts, each with its label."""
    chunks = []
    for label, words in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(3, 31))
            chunks.append((label, words[at : at + size]))
            at += size
    order = rng.permutation(len(chunks))
    words = [w for i in order for w in chunks[i][1]]
    labels = np.concatenate([np.full(len(chunks[i][1]), chunks[i][0]) for i in order]) if chunks else np.zeros(0, np.int64)
    return words, labels


def train_block(texts, weights, trans, features: Features, spec: CrfSpec, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One pass of stochastic gradient ascent on the likelihood, with steps that shrink per weight."""
    rng = np.random.default_rng(seed)
    words, labels = spliced(texts, spec, rng)
    count = len(words) // spec.sequence
    if not count:
        return weights, trans
    k = weights.shape[1]
    weights, trans = weights.copy(), trans.copy()
    seen, seen_t = np.full(weights.shape, 1e-2), np.full(trans.shape, 1e-2)
    for lo in range(0, count, spec.batch):
        n = min(spec.batch, count - lo)
        part = words[lo * spec.sequence : (lo + n) * spec.sequence]
        truth = labels[lo * spec.sequence : (lo + n) * spec.sequence]
        numbers, starts = features.of(part)
        scores = np.add.reduceat(weights[numbers], starts, axis=0).reshape(n, spec.sequence, k)
        p, pairs = pair_probabilities(scores, trans)
        grad = (np.eye(k)[truth] - p.reshape(-1, k)) / n
        owner = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(numbers))))
        for label in range(k):
            g = np.bincount(numbers, weights=grad[owner, label], minlength=features.total)
            seen[:, label] += g * g
            weights[:, label] += spec.rate * g / np.sqrt(seen[:, label])
        t = truth.reshape(n, spec.sequence)
        real = np.zeros((k, k))
        np.add.at(real, (t[:, :-1].ravel(), t[:, 1:].ravel()), 1)
        g = (real - pairs) / n
        seen_t += g * g
        trans += spec.rate * g / np.sqrt(seen_t)
    return weights, trans


def train(labelled: DataFrame, spec: CrfSpec = CrfSpec()) -> Model | None:
    """Fit on ``labelled(doc_id, text, lang)``; None where nothing is labelled."""
    spark = labelled.sparkSession
    rows = labelled.select(F.col("doc_id"), "text", "lang").where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return None
    each = -(-spec.sample_rows // len(languages))
    place = F.pmod(F.xxhash64(F.lit(spec.seed), "doc_id"), F.lit(1 << 30))
    shares = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(int(min(1.0, each / sizes[lang]) * (1 << 30))))])
    number = F.create_map(*[x for i, lang in enumerate(languages) for x in (F.lit(lang), F.lit(i))])
    sample = rows.where(place < shares[F.col("lang")])
    sample = sample.select(number[F.col("lang")].alias("label"), "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(spec.blocks)).cast("int").alias("block"))
    sample = saved(sample.repartition(spec.blocks, "block"), "crf-sample")

    def count(batches):
        for batch in batches:
            found: dict[tuple[int, str], int] = defaultdict(int)
            for label, text in zip(batch["label"], batch["text"]):
                for w in words_of(text):
                    found[label, w] += 1
            yield pd.DataFrame([(a, w, n) for (a, w), n in found.items()], columns=["label", "word", "n"])

    counts = sample.mapInPandas(count, "label int, word string, n long").groupBy("word").agg(
        *[F.sum(F.when(F.col("label") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(len(languages))]
    )
    total = sum((F.col(f"n{i}") for i in range(len(languages))), F.lit(0))
    common = counts.withColumn("n", total).where("n >= 3").orderBy(F.desc("n"), "word").limit(spec.lexicon_words * len(languages)).collect()
    lexicon = {}
    for r in common:
        strengths = [(i, r[f"n{i}"] / r["n"]) for i in range(len(languages))]
        lexicon[r["word"]] = tuple(4 * i + min(3, int(4 * s)) for i, s in strengths if s >= 0.1)

    features = Features(spec.width, len(languages), lexicon)
    k = len(languages)
    weights, trans = np.zeros((features.total, k)), np.zeros((k, k))
    for step in range(spec.rounds):
        shared = spark.sparkContext.broadcast((weights, trans, features))

        made = sample.groupBy("block").applyInPandas(_fitter(shared, spec, step), "weights binary, trans binary").collect()
        weights = np.mean([np.frombuffer(r["weights"], np.float32).reshape(-1, k) for r in made], axis=0)
        trans = np.mean([np.frombuffer(r["trans"], np.float64).reshape(k, k) for r in made], axis=0)
        shared.unpersist()
    return Model(languages, features, weights.astype(np.float32), trans)


def _fitter(shared, spec: CrfSpec, step: int):
    """Train one block from the common weights."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        weights, trans, features = shared.value
        rows = rows.sort_values(["label", "text"])
        texts = [(int(a), words_of(b)) for a, b in zip(rows["label"], rows["text"])]
        weights, trans = train_block(texts, weights, trans, features, spec, spec.seed + 100 * step + int(rows["block"].iloc[0]))
        return pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "trans": [trans.tobytes()]})

    return fit


#: Characters of text whose words are labelled at a time: bounds a worker's memory.
PIECE = 6 << 20


class Labeller:
    """Probabilities of the languages of all words of some texts; remembers scores of words."""

    def __init__(self, model: Model, spec: CrfSpec):
        self.model, self.spec = model, spec
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages)), np.float32)
        self.scored = 0

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words, new ones for words that are not known yet."""
        known = self.number
        return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))

    def _score(self) -> None:
        """Scores of all words that came since."""
        new = list(islice(self.number, self.scored, None))
        while len(self.number) > len(self.scores):
            self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)))
        for lo in range(0, len(new), 10_000):
            numbers, starts = self.model.features.of(new[lo : lo + 10_000])
            made = np.add.reduceat(self.model.weights[numbers], starts, axis=0)
            self.scores[self.scored : self.scored + len(made)] = made
            self.scored += len(made)

    def label(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """One array (word, language) for each text, given as numbers of words."""
        self._score()
        lengths = np.array([len(w) for w in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        out = [np.zeros((0, self.scores.shape[1]), np.float32)] * len(texts)
        if len(order):
            p = forward_backward(self.scores[np.concatenate([texts[i] for i in order])], self.model.trans.astype(np.float32), lengths[order])
            for i, part in zip(order, np.split(p, np.cumsum(lengths[order])[:-1])):
                out[i] = part
        if len(self.number) > self.spec.remembered:
            self._forget()
        return out

    def pieces(self, texts, split):
        """``split`` turns a text into words and anything to keep with them; yields (kept, probabilities) in order."""
        kept, numbers, size = [], [], 0
        for i, text in enumerate(texts):
            words, keep = split(text)
            kept.append(keep)
            numbers.append(self.numbers(words))
            size += len(text) if text else 0
            if size > PIECE or i == len(texts) - 1:
                yield from zip(kept, self.label(numbers))
                kept, numbers, size = [], [], 0


def predict(docs: DataFrame, model: Model | None, spec: CrfSpec = CrfSpec()) -> DataFrame:
    """``doc_id, lang_pred, score``: the language with the largest mean probability over the words of a text."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        return slim.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        labeller = Labeller(shared.value, spec)
        for batch in batches:
            names, scores = [], []
            for _, p in labeller.pieces(batch["text"].tolist(), lambda t: (words_of(t), None)):
                mean = p.mean(axis=0) if len(p) else None
                best = int(mean.argmax()) if len(p) else -1
                names.append(shared.value.languages[best] if len(p) else "und")
                scores.append(min(1.0, float(mean[best])) if len(p) else 0.0)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").to_numpy(), "lang_pred": names, "score": scores}).astype({"doc_id": "Int64"})

    return slim.mapInPandas(label, "doc_id long, lang_pred string, score double")


def label_words(docs: DataFrame, model: Model, spec: CrfSpec = CrfSpec()) -> DataFrame:
    """``doc_id, start, end, lang, probability, words``: one row per run of words of one language, in code points of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def found(text):
        words = [m for m in _WORDS.finditer(text or "") if has_letter(m.group())]
        return [m.group().lower() for m in words], words

    def runs(batches):
        labeller = Labeller(shared.value, spec)
        for batch in batches:
            rows = []
            for doc, (spans, p) in zip(batch["doc_id"], labeller.pieces(batch["text"].tolist(), found)):
                best = p.argmax(axis=1)
                cuts = np.flatnonzero(np.diff(best)) + 1
                for part in np.split(np.arange(len(best)), cuts):
                    if len(part):
                        lang = best[part[0]]
                        rows.append((doc, spans[part[0]].start(), spans[part[-1]].end(), shared.value.languages[lang], float(p[part, lang].mean()), len(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "end", "lang", "probability", "words"]).astype({"doc_id": "Int64"})

    return slim.mapInPandas(runs, "doc_id long, start long, end long, lang string, probability double, words long")


