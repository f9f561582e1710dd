"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from medallion.llm import prefix_trie
from medallion.llm.common import local_scratch

KIND = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, family=20, heads=4):
    turns = defaultdict(list)
    for c, n, r, t in rows:
        turns[c].append((n is not None, n or 0, r or "", t or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % heads if c is not None else 0
        first = c - int(c / family) * family if c is not None else 0
        whole[c] = tuple(own.get(c - first if c is not None else None, [])[:h] + s[h:])
    rank = lambda c: (c is not None, c or 0)
    members, children = defaultdict(list), defaultdict(set)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                children[s[: d - 1]].add(s[:d])
    leaves, gain = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            gain[node[:d]] += (len(of) - 1) * len(node[-1][1].encode().split()) if node else 0
    out = []
    for node, of in members.items():
        least = min(of, key=rank)
        up = min(members[node[:-1]], key=rank) if node else None
        ends = ",".join("null" if c is None else str(c) for c in sorted(of, key=rank) if whole[c] == node)
        out.append((least, len(node), up, len(of), len(children[node]), leaves[node], gain[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def nodes_of(df):
    turns, lengths = prefix_trie.branched(prefix_trie.numbered(df))
    return sorted((tuple(r[n] for n in NAMES) for r in prefix_trie.trie(turns, lengths).collect()), key=repr)


def check(spark, rows, pieces=4):
    local_scratch(spark)
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 conv", "2 place", "3 name", "4 depth", "5 digest").repartition(pieces)
    assert nodes_of(df) == brute(rows)


@pytest.mark.parametrize("seed, convs, longest", [(1, 70, 9), (2, 30, 40), (3, 15, 3)])
def test_random_conversations(spark, seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 120), convs):
        for i in range(rng.randrange(1, longest)):
            rows.append((c, i, rng.choice(["user", "assistant"]), rng.choice(["yes", "no way", "a b\tc"])))
    check(spark, rows)


def test_edge_conversations(spark):
    """Null ids, turns, roles and texts, ties, repeated rows, turnless conversations, equal ones, and role and text that only
    joined look alike."""
    rows = [(None, 1, "user", "x"), (None, None, None, None), (20, None, "user", "first"), (20, 0, "user", "first"), (20, 0, "a", "first")]
    rows += [(21, 5, "user", "hi"), (22, 5, "user", "hi"), (22, 5, "user", "hi"), (45, 0, "ab", "c"), (46, 0, "a", "bc"), (47, 0, None, "abc"), (48, 1, "abc", None)]
    rows += [(c, 0, "u", "one turn") for c in range(100, 140)] + [(-3, 0, "user", "minus " * 50), (-23, 0, "user", "minus " * 50)]
    check(spark, rows + rows[5:7])


def test_one_long_conversation_and_many_equal_ones(spark):
    """A third of all rows in one conversation; a third of all conversations the same."""
    rows = [(7, i, "user", f"w {i % 3}") for i in range(150)]
    rows += [(100 + c, i, "user", f"same {i}") for c in range(60) for i in range(2)]
    check(spark, rows + [(9000 + 41 * c, 0, "user", "same 0") for c in range(20)], pieces=7)


def test_no_conversations(spark):
    local_scratch(spark)
    assert nodes_of(spark.createDataFrame([], KIND)) == []
