"""Alignment of two tokenizers over the same text by whitespace-token anchors.

Both tokenizers encode a space and the text: a byte-level BPE (A) and a sentence-piece model (B). Byte offsets at which tokens of
both end cut them into groups; an A and a B token are linked where their bytes overlap, and a pair of ids counts as often as
tokens with these ids are linked in the whole corpus.

1. *Full tokenisation.* Every whole text is encoded by both; the joined bytes of either must be the space and the text, otherwise
   the text has no tokens. The ids are written down, two bytes each. Where no token of either can reach from a character into
   a space or line feed after it, a text's ids are those of its words, each with the space before it; a task remembers words.
2. *Anchors.* Where an A and a B token end at one byte and the next token of both is marked by a space, the text falls apart:
   the token ids between two anchors are a window, about a word.
3. *Memoised windows.* What a window's ids align to (groups, links) depends on the ids alone, so a task works it out once per
   pair of id tuples. Counting takes windows with their number, sums links per task, and then over all tasks.
4. *Totals.* Pairs with at least one in ``common_pairs`` of all links are at most ``common_pairs`` many: every task gets them, and
   the highest count of each B id (one per id of the vocabulary). The links of other pairs, none of them frequent, meet
   their counts in a join.

The vocabulary files are read once by the driver and sent to the tasks.

Nulls and edges: a null or empty text, and one whose bytes a tokenizer does not give back, has no tokens, no groups (an empty
text) and zeros; ids are carried along and never compared, so null or repeated ids do not matter; repeated rows are documents
of their own and count as such; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F

from medallion.llm.common import saved

#: Fixed values of byte-level BPE: how a text is cut before merging, and the bytes that stand for themselves as characters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: White space but spaces and line feeds. A word begins with the space or line feed that follows another character, and all white
#: space there; what A's pattern matches is white space, or has none but a first space.
_OTHER = "\\t\\v-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACE, _CHARACTER = f"[ \\n{_OTHER}]", f"[^ \\n{_OTHER}]"
WORD = re.compile(f"{_SPACE}*{_CHARACTER}+(?:[{_OTHER}]{_SPACE}*{_CHARACTER}*)*|{_SPACE}+")
INTO_SPACE = re.compile(f"{_CHARACTER}[ \\n]")

#: Characters of the longest word that a task remembers; a text with a longer new one is encoded whole.
LONGEST_WORD = 48

#: Texts whose new words are encoded together.
TEXTS = 64

#: Bytes of token ids taken at once in a task.
CUT_BYTES = 1 << 18


@dataclass(frozen=True)
class AlignSpec:
    folder: str = "/opt/tokenizers"
    byte_bpe: str = "byte_bpe_50k.json"
    pieces: str = "piece_bpe_32k.model"
    #: Pairs that every task knows, at most.
    common_pairs: int = 1 << 20
    #: Windows whose alignment a task remembers, about.
    windows: int = 1 << 16
    #: Words whose ids a task remembers.
    words: int = 1 << 16


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers, made in the task from the contents of their files."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        self.sources = byte_bpe, pieces

    def __getstate__(self):
        return {"sources": self.sources}

    @cached_property
    def ranks(self) -> dict[bytes, int]:
        """Token bytes and ids of A; ids rise in the order of the merges."""
        model = json.loads(self.sources[0])
        special = {t["id"] for t in model["added_tokens"] if t["special"]}
        code = byte_characters()
        found = {bytes(code[c] for c in token): i for token, i in model["model"]["vocab"].items() if i not in special}
        merged = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        order = [model["model"]["vocab"][left + right] for left, right in merged]
        if order != sorted(order):
            raise ValueError("the ids of the byte-level vocabulary are not in the order of its merges")
        return found

    @cached_property
    def encoder(self) -> tiktoken.Encoding:
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def model(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.sources[1])

    @cached_property
    def a_bytes(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            out[i] = token
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        model = self.model
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    @cached_property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))

    @cached_property
    def marked(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token begins with a space."""
        return tuple(np.array([t[:1] == b" " for t in table]) for table in (self.a_bytes, self.b_bytes))

    @cached_property
    def kind(self) -> np.dtype:
        """Type of ids as they are written; its greatest value stands between the two sides of a window."""
        return np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) < 1 << 16 else "<u4")

    @cached_property
    def between(self) -> int:
        return int(np.iinfo(self.kind).max)

    def encode(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of both tokenizers, none where the bytes of either are not those of a space and the text."""
        if not text:
            return b"", b""
        whole = b" " + text.encode("utf-8", "surrogatepass")
        b = self.model.encode(text)
        if b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return b"", b""
        a = self._packed(self.encoder.encode_ordinary(" " + text))
        if self.sizes[0][a].sum() != len(whole):  # a byte-level vocabulary keeps every byte it is given
            return b"", b""
        return a.tobytes(), self._packed(b).tobytes()

    def _packed(self, ids: list[int]) -> np.ndarray:
        return np.frombuffer(array("HI"[self.kind.itemsize > 2], ids), f"=u{self.kind.itemsize}").astype(self.kind, copy=False)

    @cached_property
    def by_words(self) -> bool:
        """Whether words of a text have the ids that they have alone: B merges pairs, leaves texts as they are, and no piece
        goes from a character into a space or line feed. A's pattern never does."""
        try:
            from sentencepiece import sentencepiece_model_pb2 as form
        except ImportError:  # the form of the model file is not known here
            return False
        model = form.ModelProto.FromString(self.sources[1])
        rules, plain = model.normalizer_spec, model.trainer_spec
        as_is = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.add_dummy_prefix and rules.escape_whitespaces
        merges = plain.model_type == plain.BPE and not plain.treat_whitespace_as_suffix
        return as_is and merges and not any(INTO_SPACE.search(p.piece.replace("▁", " ")) for p in model.pieces)

    def encode_words(self, words: list[str]) -> list[tuple[bytes, bytes]] | None:
        """Ids of words that begin with a space or line feed and end with a character, from one text made of them; none where
        that has no tokens."""
        a, b = self.encode("".join([" .", *words])[1:])
        if not a:
            return None
        ends = np.cumsum([2, *(len(w.encode("utf-8", "surrogatepass")) for w in words)])
        wide = self.kind.itemsize
        cuts = [((np.searchsorted(np.cumsum(size[np.frombuffer(ids, self.kind)]), ends) + 1) * wide).tolist() for size, ids in zip(self.sizes, (a, b))]
        return [(a[i:j], b[p:q]) for i, j, p, q in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])]

    def windows(self, a: list[bytes], b: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The windows of several texts in order, each the ids of A, a mark and those of B, and how many each text has."""
        ids_a, ids_b = (np.frombuffer(b"".join(x), self.kind) for x in (a, b))
        if not len(ids_a):
            return [], np.zeros(len(a), np.int64)
        ends_a, ends_b = np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b])
        at = np.searchsorted(ends_b, ends_a)
        i = np.flatnonzero(ends_b[at] == ends_a)
        j = at[i]
        # shared ends before marked tokens of both, and the ends of texts
        last = np.cumsum([len(x) for x in a]) // self.kind.itemsize - 1
        anchor = np.isin(i, last)
        inside = np.flatnonzero(~anchor)
        anchor[inside] = self.marked[0][ids_a[i[inside] + 1]] & self.marked[1][ids_b[j[inside] + 1]]
        to_a, to_b = i[anchor] + 1, j[anchor] + 1
        counts = np.diff(np.searchsorted(to_a, last + 1, "right"), prepend=0)
        # side by side: A's ids, the mark, B's ids, window after window
        number = np.arange(len(to_a))
        from_a, from_b = np.concatenate(([0], to_a[:-1])), np.concatenate(([0], to_b[:-1]))
        laid = np.full(len(ids_a) + len(ids_b) + len(number), self.between, self.kind)
        laid[np.arange(len(ids_a)) + np.repeat(from_b + number, to_a - from_a)] = ids_a
        laid[np.arange(len(ids_b)) + np.repeat(to_a + number + 1, to_b - from_b)] = ids_b
        ends = ((to_a + to_b + number + 1) * self.kind.itemsize).tolist()
        data = laid.tobytes()
        return [data[p:q] for p, q in zip([0, *ends[:-1]], ends)], counts

    def align(self, windows: list[bytes]) -> tuple[np.ndarray, ...]:
        """Links as numbers ``a * size of B + b``, the window of each, and the ends of groups: window, tokens of A and of B up to there.

        The bytes between two neighbouring token ends, of whichever side, lie in one token of each: they are a link.
        """
        laid = np.frombuffer(b"".join(windows), self.kind)
        marks = np.flatnonzero(laid == self.between)
        starts = np.cumsum([0, *map(len, windows[:-1])]) // self.kind.itemsize
        first = np.zeros(len(laid), bool)
        edge = np.zeros(len(laid) + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, marks, -1)
        first = np.cumsum(edge[:-1]) > 0
        second = ~first
        second[marks] = False
        ids_a, ids_b = laid[first].astype(np.int64), laid[second].astype(np.int64)
        ends_a, ends_b = np.cumsum(self.sizes[0][ids_a]), np.cumsum(self.sizes[1][ids_b])
        borders = ends_a[np.cumsum(marks - starts) - 1]
        cuts = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
        cuts = cuts[np.concatenate((cuts[1:] != cuts[:-1], [True]))]
        i, j = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        owner = np.searchsorted(borders, cuts)
        groups = (ends_a[i] == cuts) & (ends_b[j] == cuts)
        return ids_a[i] * len(self.b_bytes) + ids_b[j], owner, owner[groups], i[groups] + 1, j[groups] + 1, ids_a, ids_b


class WordMemo:
    """Ids of texts from those of their words: new words of many texts are encoded together, and about ``limit`` are remembered."""

    def __init__(self, vocabularies: Vocabularies, limit: int):
        self.vocabularies, self.limit = vocabularies, limit
        self.ids: dict[str, tuple[bytes, bytes]] = {}

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """The same as ``Vocabularies.encode`` for each text."""
        whole, known = self.vocabularies.encode, self.ids
        if not self.vocabularies.by_words:
            return list(map(whole, texts))
        if len(known) > self.limit:
            known.clear()
        split, fresh = [], {}
        for text in texts:
            words, new = [], []
            if text and "\0" not in text:
                words = (" " + text).replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]
                new = [w for w in words if w not in known]
                if any(len(w) < 2 or w[-1].isspace() for w in new):  # white space after white space
                    words = WORD.findall(" " + text)
                    new = [w for w in words if w not in known]
                if any(w[-1].isspace() or len(w) > LONGEST_WORD for w in new):
                    words, new = [], []
            split.append(words)
            fresh.update(dict.fromkeys(new))
        found = self.vocabularies.encode_words(list(fresh)) if fresh else []
        if found is None:
            return list(map(whole, texts))
        known.update(zip(fresh, found))
        out = []
        for text, words in zip(texts, split):
            ids = list(map(known.__getitem__, words))
            out.append((b"".join([a for a, _ in ids]), b"".join([b for _, b in ids])) if words else whole(text))
        return out


class WindowMemo:
    """Alignments of windows by their ids, worked out together for those not seen before.

    ``first`` and ``links`` hold the links of a window, ``groups`` their number and ``texts`` them written out, each group with a
    semicolon after it. With the common
    pairs known, ``sums`` and ``tops`` add up those links, and ``rare`` tells whether there are others.
    """

    def __init__(self, vocabularies: Vocabularies, common=None):
        self.vocabularies, self.common = vocabularies, common
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.first, self.links = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.groups, self.sums, self.tops, self.rare = (np.zeros(0, np.int64) for _ in range(4))
        self.known = np.zeros(0, bool)
        self.texts: list[str] = []

    def look_up(self, windows: list[bytes]) -> np.ndarray:
        """Numbers of the windows."""
        numbers, fresh = self.numbers, []
        found = list(map(numbers.get, windows))
        for i in [i for i, n in enumerate(found) if n is None]:
            window, new = windows[i], len(numbers)
            found[i] = numbers.setdefault(window, new)
            if found[i] == new:
                fresh.append(window)
        if fresh:
            self._add(fresh)
        return np.array(found, np.int64)

    def _add(self, fresh: list[bytes]) -> None:
        links, owner, group_owner, to_a, to_b, ids_a, ids_b = self.vocabularies.align(fresh)
        self.first = np.append(self.first, self.first[-1] + np.cumsum(np.bincount(owner, minlength=len(fresh))))
        self.links = np.append(self.links, links)
        groups = np.bincount(group_owner, minlength=len(fresh))
        self.groups = np.append(self.groups, groups)
        if self.common is None:
            return
        codes, counts, best = self.common
        at = np.minimum(np.searchsorted(codes, links), max(len(codes) - 1, 0))
        known = codes[at] == links if len(codes) else np.zeros(len(links), bool)
        n = np.where(known, counts[at], 0) if len(codes) else np.zeros(len(links), np.int64)
        top = known & (n == best[links % len(self.vocabularies.b_bytes)])
        total = lambda x: np.bincount(owner, weights=x, minlength=len(fresh)).astype(np.int64)
        self.tops, self.rare = np.append(self.tops, total(top)), np.append(self.rare, total(~known))
        sums = np.zeros(len(fresh), np.int64)
        np.add.at(sums, owner, n)
        self.sums, self.known = np.append(self.sums, sums), np.append(self.known, known)
        text, ends = _written(ids_a, ids_b, to_a, to_b)
        ends = ends[np.cumsum(groups) - 1].tolist()
        self.texts += [text[p:q] for p, q in zip([0, *ends], ends)]

    def links_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``links`` of these windows' links, and which of the windows each belongs to."""
        sizes = self.first[numbers + 1] - self.first[numbers]
        owner = np.repeat(np.arange(len(numbers)), sizes)
        return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.first[numbers][owner], owner


def _written(ids_a: np.ndarray, ids_b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[str, np.ndarray]:
    """The groups that end at these tokens as ``a1,a2|b1;a3|b2;``, and where each ends in that text."""
    from_a, from_b = np.concatenate(([0], to_a[:-1])), np.concatenate(([0], to_b[:-1]))
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + np.repeat(from_b, to_a - from_a)] = ids_a
    order[np.arange(len(ids_b)) + np.repeat(to_a, to_b - from_b)] = ids_b
    signs = np.full(len(order), ord(","), np.uint8)
    signs[to_a + from_b - 1] = ord("|")
    signs[to_a + to_b - 1] = ord(";")
    digits, power = np.ones(len(order), np.int64), 10
    while power <= order.max():
        digits += order >= power
        power *= 10
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    out[ends - 1] = signs
    for place in range(int(digits.max())):
        some = np.flatnonzero(digits > place)
        out[ends[some] - 2 - place] = ord("0") + order[some] // 10**place % 10
    return out.tobytes().decode(), ends[to_a + to_b - 1]


def id_cuts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        part = np.cumsum([len(a) for a in batch["a"]], dtype=np.int64) // CUT_BYTES
        for k in np.unique(part):
            yield batch[part == k]


@dataclass(frozen=True)
class Alignment:
    """``tokens(row, doc_id, a, b)`` as written, ``pairs(a, b, n, best)``: ids linked, how often, and whether no other A id is
    linked with the B id more often."""

    spec: AlignSpec
    vocabularies: Broadcast
    tokens: DataFrame
    pairs: DataFrame
    common: Broadcast

    def documents(self) -> DataFrame:
        """Per row ``doc_id, n_a, n_b, n_groups, n_links, groups``, and its links so far: ``n_best`` and ``count_sum`` of
        frequent pairs, ``rare`` pairs (``pair, n``) whose counts ``totals`` adds. Groups read ``a1,a2|b1;a3|b2``."""
        shared, common, limit = self.vocabularies, self.common, self.spec.windows

        def scan(batches):
            vocabularies = shared.value
            memo, wide = WindowMemo(vocabularies, common.value), vocabularies.kind.itemsize
            for part in id_cuts(batches):
                if len(memo.numbers) > limit:
                    memo.clear()
                a, b = part["a"].tolist(), part["b"].tolist()
                windows, sizes = vocabularies.windows(a, b)
                numbers = memo.look_up(windows)
                owner = np.repeat(np.arange(len(a)), sizes)

                def total(values, owner=owner, n=len(a)):
                    out = np.zeros(n, np.int64)
                    np.add.at(out, owner, values)
                    return out

                some = np.flatnonzero(memo.rare[numbers] > 0)
                places, of = memo.links_of(numbers[some])
                open_ = ~memo.known[places]
                pairs, texts = memo.links[places[open_]], owner[some][of[open_]]
                cut, ends = np.searchsorted(texts, np.arange(len(a) + 1)), np.cumsum(sizes).tolist()
                rare = [np.unique(pairs[p:q], return_counts=True) for p, q in zip(cut[:-1], cut[1:])]
                spoken = list(map(memo.texts.__getitem__, numbers.tolist()))
                yield pd.DataFrame({
                    "row": part["row"].tolist(), "n_a": [len(x) // wide for x in a], "n_b": [len(x) // wide for x in b],
                    "n_groups": total(memo.groups[numbers]), "n_links": total(memo.first[numbers + 1] - memo.first[numbers]),
                    "n_best": total(memo.tops[numbers]), "count_sum": total(memo.sums[numbers]),
                    "pair": [p for p, _ in rare], "n": [n for _, n in rare], "groups": ["".join(spoken[p:q])[:-1] for p, q in zip([0, *ends], ends)],
                })

        counts = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, pair array<long>, n array<long>, groups string"
        return self.tokens.select("row", "a", "b").mapInPandas(scan, f"row long, {counts}")

    def totals(self, documents: DataFrame) -> DataFrame:
        """``documents``, or a part of its columns, with ``n_best`` and ``count_sum`` over all links and ``doc_id``."""
        width = len(self.vocabularies.value.b_bytes)
        documents = saved(documents, "aligned")
        rare = documents.select("row", F.explode(F.arrays_zip("pair", "n")).alias("r")).select("row", "r.pair", F.col("r.n").alias("m"))
        known = self.pairs.select((F.col("a") * width + F.col("b")).alias("pair"), "n", "best")
        more = rare.join(known, "pair").groupBy("row").agg(F.sum(F.col("m") * F.col("n")).alias("sum"), F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("top"))
        n_best, count_sum = (F.col(x) + F.coalesce(F.col(y), F.lit(0)) for x, y in (("n_best", "top"), ("count_sum", "sum")))
        out = documents.join(more, "row", "left").withColumns({"n_best": n_best, "count_sum": count_sum})
        return self.tokens.select("row", "doc_id").join(out.drop("pair", "n", "top", "sum"), "row").drop("row")


def align(docs: DataFrame, spec: AlignSpec = AlignSpec()) -> Alignment:
    """Encode every text and count the linked pairs of ids."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabularies(*(_file(spark, f"{spec.folder}/{name}") for name in (spec.byte_bpe, spec.pieces))))
    width = len(shared.value.b_bytes)

    @F.pandas_udf("a binary, b binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = WordMemo(shared.value, spec.words)
        for texts in batches:
            ids = [x for i in range(0, len(texts), TEXTS) for x in memo.encode(texts[i : i + TEXTS].tolist())]
            yield pd.DataFrame(ids, columns=["a", "b"])

    row = F.monotonically_increasing_id().alias("row")
    tokens = saved(docs.select("doc_id", row, encode("text").alias("ids")).select("doc_id", "row", "ids.*"), "tokens")

    def count(batches):
        vocabularies = shared.value
        memo, often = WindowMemo(vocabularies), np.zeros(0, np.int64)

        def links():
            places, owner = memo.links_of(np.arange(len(often)))
            pairs, at = np.unique(memo.links[places], return_inverse=True)
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, at, often[owner])
            return pd.DataFrame({"pair": pairs, "n": n})

        for part in id_cuts(batches):
            numbers = memo.look_up(vocabularies.windows(part["a"].tolist(), part["b"].tolist())[0])
            seen = np.bincount(numbers, minlength=len(memo.numbers))
            seen[: len(often)] += often
            often = seen
            if len(often) > spec.windows:
                yield links()
                memo.clear()
                often = np.zeros(0, np.int64)
        yield links()

    found = tokens.select("a", "b").mapInPandas(count, "pair long, n long")
    counted = saved(found.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    total = counted.agg(F.sum("n")).first()[0] or 0
    frequent = counted.where(F.col("n") * spec.common_pairs >= total).toPandas().sort_values("pair")
    highest = counted.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("top"))
    tops = highest.toPandas()  # one row per id of the vocabulary at most
    best = np.zeros(width, np.int64)
    best[tops["b"]] = tops["top"]
    common = spark.sparkContext.broadcast((frequent["pair"].to_numpy(np.int64), frequent["n"].to_numpy(np.int64), best))
    pairs = counted.select(F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "n").join(F.broadcast(highest), "b")
    return Alignment(spec, shared, tokens, pairs.select("a", "b", "n", (F.col("n") == F.col("top")).alias("best")), common)


def _file(spark, path: str) -> bytes:
    """A vocabulary file of the driver's, or of a store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as stream:
        return stream.read()
