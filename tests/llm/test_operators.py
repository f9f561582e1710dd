"""The operators against brute force, on rows with nulls, ties, repeats, long and empty texts, and on no rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import decontamination, fixity, histogram_sort, language_crf, ngram_join, perspectives, quality_knn, queries, suffix_dedup, temperature_mixing, winnowing
from medallion.llm.common import local_scratch
from llm_rows import DOCS, edge_rows, prose


@pytest.fixture(scope="module")
def edges(spark):
    local_scratch(spark)
    return spark.createDataFrame(edge_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# -- chat formatting


def test_perspectives_take_apart(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 70, None, "late"), (1, None, "ann", "first"), (None, 0, "ann", "x"), (2, 0, "system", "alone"), (1, 1, "ann", "hi <|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("speaker", F.lit("clash"))
    out = perspectives.rotate(df).collect()
    seen = {(r.conv_id, r.speaker, r.block): r for r in out}
    assert set(seen) == {(1, s, b) for s in ("ann", "bob", "unknown") for b in (None, 0, 1)} | {(None, "ann", 0)}
    for (conv, speaker, block), r in seen.items():
        said = [r.text[m.start : m.end] for m in r["mask"]]
        mine = [(t or "").replace("<|", "<​|") + "<|im_end|>" for c, n, w, t in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0)) if c == conv and (w or "unknown") == speaker and (n // 64 if n is not None else None) == block]
        assert said == mine
        assert r.text.count("<|im_start|>") == r.n_turns == r.text.count("<|im_end|>")
    assert perspectives.rotate(df.limit(0)).count() == 0


# -- language


def test_languages_of_mixed_text(spark, edges, none):
    sounds = {"en": "the and with thing", "de": "und nicht schlich keit", "fr": "leaux queau ment oui"}
    rows = []
    for i in range(120):
        lang = ("en", "de", "fr")[i % 3]
        rng = random.Random(i)
        rows.append((i, " ".join(rng.choice(sounds[lang].split()) + rng.choice(["", "s", "er"]) for _ in range(60)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_crf.train(docs.where("doc_id % 5 != 0"), language_crf.CrfSpec(sample_rows=100))
    found = {r.doc_id: r for r in language_crf.predict(docs, model).collect()}
    assert np.mean([found[i].lang_pred == lang for i, _, lang in rows if i % 5 == 0]) == 1.0
    mixed = rows[0][1] + " " + rows[1][1]
    runs = language_crf.label_words(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model).orderBy("start").collect()
    assert runs[0].lang == "en" and runs[-1].lang == "de" and runs[0].start == 0 and runs[-1].end == len(mixed)
    edge = language_crf.predict(edges, model).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r.score <= 1 for r in edge)
    assert {r.lang_pred for r in edge if r.doc_id in (5, 6, 7, 13)} == {"und"}
    assert language_crf.predict(none, model).count() == 0 and language_crf.train(none) is None
    assert {r.lang_pred for r in language_crf.predict(edges, None).collect()} == {"und"}


def test_forward_backward_against_all_paths():
    import itertools

    rng = np.random.default_rng(0)
    scores, trans = rng.normal(size=(5, 3)), rng.normal(size=(3, 3))
    want = np.zeros((5, 3))
    for path in itertools.product(range(3), repeat=5):
        w = np.exp(sum(scores[i, s] for i, s in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        for i, s in enumerate(path):
            want[i, s] += w
    got = language_crf.forward_backward(np.concatenate([scores, scores[:2]]), trans, np.array([5, 2]))
    assert np.allclose(got[:5], want / want.sum(axis=1, keepdims=True))


# -- quality


def test_quality_votes(spark, edges, none):
    rows = [(i, prose(i, 80) if i % 2 else prose(i, 80).upper().replace(" ", "!! ")) for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("double").alias("label")).where("doc_id % 5 != 0")
    model = quality_knn.train(docs, marks)
    found = {r.doc_id: r.score for r in quality_knn.score(docs, model).collect()}
    assert all((found[i] >= 0.5) == bool(i % 2) for i in range(0, 160, 5))
    # the exact vote, one by one
    texts = [t for _, t in rows[:10]]
    v = model.project(texts)
    for x, got in zip(v, quality_knn.vote(model, v, 25)):
        near = np.round(model.vectors @ x, 5)
        last = np.sort(near)[-25]
        w = np.where((near >= last) & (near > 0), near.astype(float) ** 4, 0)
        assert got == pytest.approx((w * model.labels).sum() / w.sum())
    edge = quality_knn.score(edges, model).collect()
    assert len(edge) == len(edge_rows()) and all(0 <= r.score <= 1 for r in edge)
    assert quality_knn.accepted(edges, model, 0.0).count() == len(edge_rows())
    assert quality_knn.train(none, marks) is None and quality_knn.score(none, model).count() == 0


# -- decontamination


def test_passages_with_edits_are_found(spark, edges, none):
    items = [(i, prose(100 + i, n)) for i, n in enumerate([1, 2, 4, 9, 14, 25, 40, 60] * 4)] + [(90, None), (91, ""), (0, prose(100, 1))]
    items[0] = (0, "singular")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rng, docs, want = random.Random(5), [], set()
    for i, text in items[: -3]:
        w = text.split()
        for k in {0, int(0.1 * len(w)), int(0.2 * len(w))}:
            x = list(w)
            for _ in range(k):
                x[rng.randrange(len(x))] = "qqq"
            docs.append((len(docs), prose(900 + len(docs), 37).replace("a", "o") + " " + " ".join(x).upper() + ", " + prose(i, 20).replace("a", "o")))
            want.add((len(docs) - 1, i))
    found = decontamination.find_passages(spark.createDataFrame(docs, "doc_id long, text string"), benchmark).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(want & got) >= 0.95 * len(want)
    for r in found:
        assert dict(docs)[r.doc_id][r.start : r.end] == r.passage and r.distance <= 0.25 * r.n_words
    clean = decontamination.decontaminated(edges, benchmark.where("length(text) > 100"))
    assert clean.count() == len(edge_rows()) and clean.columns == edges.columns
    assert decontamination.decontaminated(edges, edges.where("doc_id = 3").select(F.col("doc_id").alias("item_id"), "text")).where("doc_id = 3").count() == 0
    assert decontamination.find_passages(none, benchmark).count() == 0 and decontamination.find_passages(edges, benchmark.limit(0)).count() == 0


def nearest_passage(item, words):
    """Least word edits of an item to any passage, by the plain table."""
    row = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(words):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_every_passage_at_the_full_bound_is_found(spark):
    spec, rng = decontamination.DecontaminationSpec(), random.Random(11)
    items = [(n, [f"{w}{rng.randrange(40)}" for w in prose(2000 + n, n).split()]) for n in [1, 2, 3, 4, 5, 7, 8, 10, 11, 13, 17, 20, 30, 50, 95, 150, 400]]
    docs = []
    for n, item in items:
        for kind in ["replace", "insert", "delete", "any"] * 3:
            x = list(item)
            places = sorted(rng.sample(range(n), spec.bound(n)), reverse=True)
            for at in places:
                what = rng.choice(["replace", "insert", "delete"]) if kind == "any" else kind
                x[at : at + (what != "insert")] = [] if what == "delete" else [f"new{rng.randrange(999)}"]
            docs.append([*prose(len(docs), rng.randrange(9)).split(), *x, *prose(len(docs) + 1, rng.randrange(9)).split()])
    benchmark = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    want = {}
    for i, words in enumerate(docs):
        for n, item in items:
            if len(words) >= n - spec.bound(n) and (n == items[i // 12][0] or len(set(words) & set(item)) >= n - spec.bound(n)):
                distance = nearest_passage(item, words)
                if distance <= spec.bound(n):
                    want[i, n] = distance
    assert {i for i, _ in want} == set(range(len(docs)))
    got = {}
    for r in decontamination.find_passages(texts, benchmark).collect():
        got[r.doc_id, r.item_id] = min(r.distance, got.get((r.doc_id, r.item_id), r.distance))
    assert got == want
    assert decontamination.decontaminated(texts, benchmark).count() == 0


def test_three_tenths_of_the_words_may_differ(spark):
    item = prose(31, 40).split()
    texts = [(k, " ".join(f"new{i}" if i % 3 == 1 and i < 3 * k else w for i, w in enumerate(item))) for k in (10, 11, 12, 13)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {(r.doc_id, r.distance) for r in decontamination.find_passages(docs, benchmark).collect()} == {(10, 10), (11, 11), (12, 12)}


def test_a_search_in_parts_finds_the_same(monkeypatch):
    rng = random.Random(3)
    items = [(i, [rng.choice("abc") for _ in range(rng.randrange(1, 9))]) for i in range(9)]
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(30))) for _ in range(40)]
    index = decontamination.Index([(i, decontamination.word_hashes(" ".join(w))[0]) for i, w in items], decontamination.DecontaminationSpec())
    whole = list(decontamination.occurrences(index, *decontamination.laid_out(texts)))
    want = {(d, i) for d, t in enumerate(texts) for i, w in items if nearest_passage(w, t.split()) <= index.spec.bound(len(w))}
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 50)
    monkeypatch.setattr(decontamination, "PLACES", 20)
    assert list(decontamination.occurrences(index, *decontamination.laid_out(texts))) == whole
    assert {(d, i) for d, i, *_ in whole} == want


# -- fixity


def test_audit_finds_each_damage(spark, none):
    local_scratch(spark)
    rows = [(i % 3, (i // 3) * 100_000, f"record {i}") for i in range(300)]
    left = spark.createDataFrame(rows, "archive string, offset long, payload string")
    right = [(a, o, "changed" if p.endswith(" 7") else p) for a, o, p in rows if not p.endswith(" 8")] + [("9", 5, "new"), ("1", 0, "twin")]
    right = spark.createDataFrame(right, "archive string, offset long, payload string")
    one, two = (fixity.manifest(x, F.col("payload")) for x in (left, right))
    wrong, steps = fixity.audit(one, two)
    assert {(r.archive, r.offset, r.status) for r in wrong.collect()} == {("1", 200_000, "corrupt"), ("2", 200_000, "missing"), ("9", 5, "extra"), ("1", 0, "corrupt")}
    assert steps[-1][1] < 40
    assert fixity.audit(one, one)[0].count() == 0
    assert fixity.audit(one.limit(0), one)[0].count() == 300 and fixity.audit(one.limit(0), one.limit(0))[0].count() == 0


# -- n-gram join


def brute_components(rows):
    sets = []
    for i, (doc, text) in enumerate(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)})
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)].append(doc)
    return sorted(((doc, len(sets[i]), min(least[root(i)], default=None)) for i, (doc, _) in enumerate(rows)), key=str)


def test_join_against_all_pairs(spark, edges, none):
    rng = random.Random(3)
    base = prose(50, 120).split()
    rows = [(r[0], r[1]) for r in edge_rows()]
    for i in range(100, 220):
        w = list(base)
        for _ in range(rng.randrange(8)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10_000)}"
        rows.append((i, " ".join(w[rng.randrange(6) :])))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit(1))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).documents().collect()), key=str)
    assert got == brute_components(rows)
    kept = ngram_join.keep_one(edges)
    assert kept.columns == edges.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted({d for d, _, c in brute_components([(r[0], r[1]) for r in edge_rows()]) if d is not None and (c == d)})
    assert ngram_join.keep_one(none).count() == 0


def test_texts_that_share_an_id_stay(spark):
    base = prose(41, 60)
    rows = [(1, base), (1, prose(42, 60)), (2, prose(43, 60)), (2, base + " end"), (3, prose(44, 60)), (3, prose(44, 60)), (4, prose(45, 60)), (4, ""), (4, None)]
    local_scratch(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in ngram_join.keep_one(docs).collect()]
    near = {(1, base), (2, base + " end")}
    assert len(near & set(kept)) == 1
    assert sorted(map(str, set(kept) - near)) == sorted(map(str, set(rows) - near)) and len(kept) == len(set(kept))


# -- sharding


def test_shards_hold_equal_bytes(spark, edges, none):
    rows = [(i, prose(i % 40 if i % 3 == 0 else 0, 20 + i % 40 if i % 3 == 0 else 30)) for i in range(3000)]  # two thirds are one text
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("own"))
    out = histogram_sort.shard(df).collect()
    by = collections.defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    mean = sum(r["size"] for r in out) / 8
    assert len(by) == 8 and all(abs(sum(r["size"] for r in v) - mean) < 0.03 * mean for v in by.values())
    assert all(sorted(r.slot_assigned for r in v) == list(range(len(v))) for v in by.values())
    edge = histogram_sort.shard(edges).collect()
    assert sorted(r["size"] for r in edge) == sorted(len((r[1] or "").encode()) + 1 for r in edge_rows())
    assert histogram_sort.shard(none).count() == 0


# -- winnowing


def brute_winnow(text, k=5, w=16):
    tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", text) if t]
    grams = [tuple(tokens[i : i + k]) for i in range(max(1, len(tokens) - k + 1))] if tokens else []
    return tokens, grams


def test_winnowing_guarantee_and_ties(spark, edges, none):
    got = {r.doc_id: r for r in winnowing.compare_edits(edges.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    rows = {r[0]: r[1] or "" for r in edge_rows() if r[0] is not None}
    ids = sorted(rows)
    for at, i in enumerate(ids):
        text, ahead = rows[i], rows[ids[(at + 1) % len(ids)]]
        half = len(text) // 2
        assert got[i].edited == text[: len(text) - half] + ahead[:half]
        _, grams = brute_winnow(text)
        marks = {p.position: p.hash for p in got[i].print}
        assert bool(marks) == bool(grams)
        hashes = {}
        for p, h in marks.items():
            assert hashes.setdefault(grams[p], h) == h
        for s in range(max(0, len(grams) - 16) + (1 if grams else 0)):
            assert any(s <= p < s + 16 for p in marks)
        if len(set(grams)) == 1:  # all equal: the rightmost of each window
            assert min(marks) == min(15, len(grams) - 1)
    assert winnowing.compare_edits(none).count() == 0
    assert winnowing.compare_edits(edges).count() == len(edge_rows())


def test_half_of_a_short_text_is_seen(spark, tmp_path):
    rows = [(n, prose(300 + n, n)) for n in range(14, 60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op8_winnowing"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and all(r.near_edited > 0 for r in found)


# -- mixing


@pytest.mark.parametrize("spec", [temperature_mixing.MixSpec(repeats=2.0), temperature_mixing.MixSpec(entropy=0.95, block_tokens=50), temperature_mixing.MixSpec(repeats=3.0, budget=4000, block_tokens=64)])
def test_mixing_meets_targets(spark, spec):
    rows = [(i, prose(i, 10), None if i % 50 == 0 else ("a" if i % 10 < 7 else "b" if i % 10 < 9 else "c")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("block", F.lit(0))
    out = temperature_mixing.mix(df, spec).collect()
    drawn = collections.Counter()
    have = collections.Counter()
    for r in out:
        drawn[r.source] += r.copies * 10
        have[r.source] += 10
    assert len(out) == 600 and sum(have.values()) == 6000
    if spec.entropy:
        p = np.array(list(drawn.values())) / sum(drawn.values())
        assert -(p * np.log(p)).sum() / np.log(len(p)) == pytest.approx(0.95, abs=0.02) and sum(drawn.values()) == pytest.approx(6000, abs=50)
    else:
        epochs = {s: drawn[s] / have[s] for s in have}
        assert max(epochs.values()) / min(epochs.values()) == pytest.approx(spec.repeats, rel=0.06)
        assert sum(drawn.values()) == pytest.approx(4000, abs=50) if spec.budget else min(epochs.values()) == 1
    for s in have:  # copies differ by one at most
        assert len({r.copies for r in out if r.source == s}) <= 2


def test_mixing_edges(spark, edges, none):
    assert temperature_mixing.mix(edges).count() == len(edge_rows()) and temperature_mixing.mix(none).count() == 0
    assert temperature_mixing.drawn(temperature_mixing.mix(edges.drop("copies"), temperature_mixing.MixSpec(repeats=1.25)), ["doc_id"]).count() >= len(edge_rows())


# -- repeated strings


def brute_repeats(rows, length):
    seen, out = set(), {}
    for doc, text in sorted({(r[0], r[1] or "") for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]))):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = True
            seen.add(s)
        out[doc, text] = np.frombuffer(raw, np.uint8)[~gone].tobytes()
    return out


@pytest.mark.parametrize("anchor_bytes", [4 << 20, 400])
def test_repeated_strings_against_brute_force(spark, edges, anchor_bytes):
    spec = suffix_dedup.DedupSpec(anchor_bytes=anchor_bytes)
    more = [(100 + i, prose(200 + i, 30) + prose(77, 40) + prose(300 + i, 9), *[None] * 7) for i in range(12)]
    rows = [r for r in edge_rows() if r[0] is not None] + more
    got = suffix_dedup.deduplicate(edges.where("doc_id is not null").union(spark.createDataFrame(more, edges.schema)), spec).collect()
    want = brute_repeats(rows, 100)
    assert len(got) == len(rows)
    by = {doc: kept for (doc, _), kept in want.items()}
    assert {r.doc_id: bytes(r.kept) for r in got} == by


def test_repeated_strings_edges(spark, edges, none):
    assert suffix_dedup.deduplicate(edges).count() == len(edge_rows()) and suffix_dedup.deduplicate(none).count() == 0


def test_merge_of_transforms_against_sorting():
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(30, 60))) for _ in range(24)]
    parts = [strings[:7], strings[7:11], strings[11:]]
    rows, block = suffix_dedup.repeated_intervals([suffix_dedup.transform(p) for p in parts], 12)
    owner, offset = suffix_dedup.places([suffix_dedup.transform(p) for p in parts], [np.array([len(s) for s in p]) for p in parts])
    got = collections.defaultdict(set)
    for r, b in zip(rows, block):
        got[b].add((int(owner[r]), int(offset[r])))
    want = collections.defaultdict(set)
    for i, s in enumerate(strings):
        for k in range(len(s) - 11):
            want[s[k : k + 12]].add((i, k))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


# -- pipeline


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, prose(i, 60) if i < 30 else prose(i - 10, 60) + " end", "en", f"s{i % 3}", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    item = " ".join(prose(5, 60).split()[10:40])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        kept.append({r.doc_id for r in now.collect()})
    assert kept[0] == set(range(40)) and kept[1] == set(range(30)) and kept[2] == set(range(30)) - {5} and kept[3] == kept[2]
    final = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in final.collect()} == kept[3] and {"size", "shard", "slot"} <= set(final.columns)


def test_pipeline_mixing_moves_weights(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, prose(i, 10), "en", "many" if i < 200 else "few", 1) for i in range(220)]
    out = corpus_pipeline.mixing(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(range(220))
    drawn = collections.Counter(r.source for r in out)
    assert drawn["many"] == 200 and 70 <= drawn["few"] <= 80


def test_shingle_lists_hold_one_row_of_each_class(spark):
    rows = [(7, 9, 5, 0, 1), (3, 9, 5, 0, 1), (3, 9, 5, 0, 1), (4, 8, 6, 0, 1), (1, 9, 5, 1, 2), (2, 9, 5, 1, 2), (6, 9, 5, 0, 3)]
    tokens = spark.createDataFrame(rows, "rep long, n int, mark long, pos int, token long")
    assert sorted(map(tuple, ngram_join._met(tokens).select("token", "rep", "n", "pos").collect())) == [(1, 3, 9, 0), (1, 4, 8, 0)]


def test_long_texts_that_share_a_passage_are_not_verified(spark, monkeypatch):
    """The suffix filter tells long sets apart too: of texts with one rare passage in common no sets are sent."""
    local_scratch(spark)
    one, two, passage = ([f"{c}{i}" for i in range(n)] for c, n in (("a", 1500), ("b", 1500), ("p", 8)))
    texts = [one + passage, two + passage, one, one, one, two, two, two, one[:-40] + [f"c{i}" for i in range(40)]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sent, verified = [], ngram_join.verified

    def seen(pairs, docs, spec):
        sent.extend((p.a, p.b) for p in pairs.collect())
        return verified(pairs, docs, spec)

    monkeypatch.setattr(ngram_join, "verified", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).documents().collect())
    assert got == brute_components(rows)
    assert sent and (0, 1) not in sent


def test_parities_of_sets_of_different_sizes(spark):
    """Folded parities bound the difference of two sets, whatever the number of their parts."""
    import numpy as np

    rng = np.random.default_rng(3)
    for n, m in ((3, 4), (500, 530), (1000, 1100), (2000, 2300), (4000, 4200), (9000, 9000)):
        both = rng.integers(0, 2**63, m, dtype=np.uint64)
        x, y = np.unique(both[:n]), np.unique(both[n // 10 :])
        p, q = ngram_join.parities(x), ngram_join.parities(y)
        least = min(len(p), len(q))
        apart = int(np.bitwise_count((ngram_join.folded(p, least) ^ ngram_join.folded(q, least)).view(np.uint64)).sum())
        differ = len(np.setxor1d(x, y))
        assert apart <= differ and (differ - apart) % 2 == 0
        row = spark.createDataFrame([(p.tolist(),)], "parity array<long>").select(ngram_join.short("parity").alias("s")).first().s
        assert row == ngram_join.folded(p, ngram_join.PARITY).tolist()


def test_pairs_of_long_lists_in_the_second_join(spark):
    """Texts about as alike as the threshold, in lists of many rows: components as from all pairs; an id has two texts of one size."""
    local_scratch(spark)
    rng, base = random.Random(11), [f"w{i}" for i in range(70)]
    texts = []
    for _ in range(40):
        words = list(base)
        for at in rng.sample(range(70), rng.randint(1, 3)):
            words[at] = f"x{rng.randint(0, 60)}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df).documents().collect()), key=str)
    assert got == brute_components(rows)
    tokens = [(1, 5, 60, p, i, list(range(9))) for i, p in enumerate(range(3))] + [(2, 6, 60, p, i, list(range(9))) for i, p in enumerate(range(3))]
    # ids 1 and 2 meet in three long lists, with two texts of id 1: one pair, however many lists hold it
    tokens += [(1, 7, 60, 0, 1, list(range(9)))]
    shared = spark.createDataFrame([(r, m, n, p, t, 9) for r, m, n, p, t, _ in tokens], "rep long, mark long, n int, pos int, token long, size long")
    profiles = spark.createDataFrame([(r, m, 60, [0] * 8) for r, m in ((1, 5), (1, 7), (2, 6))], "rep long, mark long, n int, parity array<long>")
    none = spark.createDataFrame([], "id long, component long")
    assert [tuple(r) for r in ngram_join._late_pairs(shared, profiles, none, ngram_join.JoinSpec()).collect()] == [(1, 2)]
