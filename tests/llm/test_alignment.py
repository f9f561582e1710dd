"""Alignment of two tokenizers against all pairs of overlapping tokens."""

import collections
import os
import random

import numpy as np
import pandas as pd
import pytest
from medallion.llm import queries, token_alignment as ta
from medallion.llm.common import local_scratch
from llm_rows import DOCS, edge_rows, prose

SPEC = ta.AlignSpec()
pytestmark = pytest.mark.skipif(not os.path.isdir(SPEC.folder), reason="no vocabularies")


@pytest.fixture(scope="module")
def reference():
    """Both tokenizers straight from their files, and the bytes of their ids."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(f"{SPEC.folder}/{SPEC.byte_bpe}")
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=f"{SPEC.folder}/{SPEC.pieces}")
    code = ta.byte_characters()

    def encode(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        bytes_a = [bytes(code[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(second.id_to_piece, b))]
        whole = (" " + text).encode()
        return (a, bytes_a, b, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], [])

    return encode


def brute(texts, encode):
    """Groups and links of every text, from the byte ranges of all tokens."""
    out, counts = [], collections.Counter()
    for text in texts:
        a, bytes_a, b, bytes_b = encode(text) if text else ([], [], [], [])
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a], dtype=int), np.cumsum([len(x) for x in bytes_b], dtype=int)
        links = [
            (a[i], b[j]) for i in range(len(a)) for j in range(len(b))
            if max(ends_a[i] - len(bytes_a[i]), ends_b[j] - len(bytes_b[j])) < min(ends_a[i], ends_b[j])
        ]
        counts.update(links)
        groups, p, q = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            i, j = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            p, q = i, j
        out.append((len(a), len(b), len(groups), links, ";".join(groups)))
    top = collections.Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(na, nb, ng, len(ls), sum(counts[x] == top[x[1]] for x in ls), sum(counts[x] for x in ls), g) for na, nb, ng, ls, g in out]


def rows_of(docs, spec):
    found = ta.align(docs, spec)
    out = found.totals(found.documents())
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    return sorted((tuple(r[n] for n in names) for r in out.collect()), key=repr)


def odd_texts():
    return [
        "The cat sat on the mat.", " two  spaces\n\nand lines\t", "don't we'll I'M", "naïve café déjà-vu", "数字 123456 漢字かな", "<|endoftext|> <s> </s> <unk>",
        "▁ low line", "x" * 300, "   wide", "a\x00b\x7f", "🙂🙃 🏳️‍🌈", "ﬁ ligature ½ Å", " ", "\n", "\r\n \r\n", "  ", "A" * 50 + " " * 40 + "b", "١٢٣ ٤", "é é", "٪ʼn ǅ",
        "the the the cat cat", "price: $3.50/kg (approx.)", "http://a.b/c?d=e&f=%20", "﻿mark", "tab\tand\x0bvt\x0cff",
    ]


@pytest.mark.parametrize("spec", [SPEC, ta.AlignSpec(common_pairs=20, windows=3)], ids=["default", "few"])
def test_alignment_of_odd_texts(spark, reference, spec):
    local_scratch(spark)
    texts = odd_texts() + [prose(i, 30) for i in range(8)] + ["The cat sat on the mat."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert rows_of(docs, spec) == sorted(((i, *b) for i, b in enumerate(brute(texts, reference))), key=repr)


def test_alignment_of_edge_rows(spark, reference):
    local_scratch(spark)
    rows = [r for r in edge_rows() if not (r[1] and len(r[1]) > 5000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 row", "2 a", "3 b", "4 pair", "5 n", "6 ids")
    want = [(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], reference))]
    assert rows_of(docs, SPEC) == sorted(want, key=repr)
    assert rows_of(docs.limit(0), SPEC) == []


def test_long_text(spark, reference):
    """A long text, split at its anchors, has the tokens and groups that the definition gives."""
    text = prose(3, 20000) + " " + "z" * 5000 + " " * 3000 + "end"
    vocabularies = ta.Vocabularies(*(ta._file(spark, f"{SPEC.folder}/{n}") for n in (SPEC.byte_bpe, SPEC.pieces)))
    a, _, b, _ = reference(text)
    ids = vocabularies.encode(text)
    assert [np.frombuffer(x, vocabularies.kind).tolist() for x in ids] == [a, b]
    windows, counts = vocabularies.windows([ids[0], b"", ids[0]], [ids[1], b"", ids[1]])
    assert counts.tolist() == [len(windows) // 2, 0, len(windows) // 2] and (not a or len(windows) > 30000)
    memo = ta.WindowMemo(vocabularies)
    numbers = memo.look_up(windows)
    assert len(memo.numbers) < len(windows) / 4 and numbers[: len(windows) // 2].tolist() == numbers[len(windows) // 2 :].tolist()


def test_query_digests(spark):
    out = queries.QUERIES["op12_alignment"](spark, "/root/testdata/sf0.001").where("n_a = 0 or groups_sha256 = ''")
    assert out.where("groups_sha256 <> '' or n_links <> 0 or count_sum <> 0").count() == 0


def test_ids_are_cut_into_small_parts():
    """A task's temporary arrays are several times the ids it takes at once."""
    row = b"\1\2" * 5000
    parts = list(ta.id_cuts([pd.DataFrame({"a": [row] * 300, "b": [row] * 300})]))
    assert sum(map(len, parts)) == 300
    assert max(sum(map(len, p["a"])) for p in parts) <= (1 << 18) + len(row)


def test_ids_by_words(spark):
    """Ids put together from remembered words are those of whole texts; a word that comes again is not encoded again."""
    vocabularies = ta.Vocabularies(*(ta._file(spark, f"{SPEC.folder}/{n}") for n in (SPEC.byte_bpe, SPEC.pieces)))
    assert vocabularies.by_words
    rng, signs = random.Random(4), "ab1'!. \n\t\r\xa0\x1c ▁é漢🙂\x00st"
    texts = odd_texts() + ["x\n", "x ", "x \n y", "\nx", "\t\tx", "a!\n\n  b\t c", "a\r\nb", "a\x1cb \x1c c!\x1cd", "a;\r\nb;\r c", None, "", prose(3, 300)]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 25))) for _ in range(3000)]
    whole = list(map(vocabularies.encode, texts))
    for limit, many in ((1 << 16, 64), (5, 3)):
        memo = ta.WordMemo(vocabularies, limit)
        assert [x for i in range(0, len(texts), many) for x in memo.encode(texts[i : i + many])] == whole
    encoded = []
    vocabularies.encode = lambda text, encode=vocabularies.encode: (encoded.append(text), encode(text))[1]
    memo = ta.WordMemo(vocabularies, 1 << 16)
    memo.encode([prose(i, 500) for i in range(20)])
    assert 0 < sum(map(len, encoded)) < len(prose(0, 500)) * 2
