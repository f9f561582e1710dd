"""The registered queries of this subpackage, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.llm import (
    decontamination, fixity, histogram_sort, language_crf, ngram_join, perspectives, prefix_trie, quality_knn, suffix_dedup, superkmer_dedup,
    temperature_mixing, token_alignment, winnowing,
)
from medallion.llm.common import held_out, local_scratch, saved, table

QUERIES = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            local_scratch(spark)
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@query(r"""
WITH rows AS (
  SELECT conv_id, turn, floor(turn / 64.0)::BIGINT AS block,
         translate(replace(coalesce(role, 'unknown'), '<|', '<' || chr(8203) || '|'), chr(13) || chr(10), '  ') AS name,
         replace(coalesce(text, ''), '<|', '<' || chr(8203) || '|') AS text
  FROM conversations),
speakers AS (SELECT DISTINCT conv_id AS c, name AS speaker FROM rows WHERE name <> 'system'),
parts AS (
  SELECT conv_id, speaker, block, turn, name, text, name = speaker AS own,
         '<|im_start|>' || CASE WHEN name = 'system' THEN 'system' WHEN name = speaker THEN 'assistant' ELSE 'user name=' || name END || chr(10) AS head
  FROM rows JOIN speakers ON conv_id IS NOT DISTINCT FROM c),
placed AS (
  SELECT *, row_number() OVER o AS place,
         coalesce(sum(length(head) + length(text) + 11) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins
  FROM parts WINDOW o AS (PARTITION BY conv_id, speaker, block ORDER BY turn NULLS FIRST, name, text))
SELECT conv_id, speaker, block, count(*)::INTEGER AS n_turns,
       string_agg(head || text || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg((begins + length(head))::BIGINT || '-' || (begins + length(head) + length(text) + 10)::BIGINT, ',' ORDER BY place) FILTER (WHERE own), '') AS mask
FROM placed GROUP BY conv_id, speaker, block
""")
def op1_perspectives(spark, sf_dir):
    """Every conversation from every participant's side; masks as ``start-end`` pairs."""
    out = perspectives.rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return out.withColumn("mask", F.array_join(spans, ","))


@query()
def op2_language(spark, sf_dir):
    """Language of every whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_crf.train(docs.where(~held_out(F.col("doc_id"))))
    found = language_crf.predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def quality_model(spark, docs, sf_dir):
    marks = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return quality_knn.train(docs, marks.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label")))


#: Documents below this score count as bad.
LEAST_QUALITY = 0.3


@query()
def op3_quality(spark, sf_dir):
    """Quality of every whole text, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = quality_knn.score(docs, quality_model(spark, docs, sf_dir))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"))


@query()
def op4_decontamination(spark, sf_dir):
    """Benchmark items that occur in documents: the nearest occurrence of each."""
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    nearest = F.min(F.struct("distance", "start", "end", "n_words")).alias("n")
    return found.groupBy("doc_id", "item_id").agg(nearest).select("doc_id", "item_id", "n.distance", "n.n_words", "n.start", "n.end")


#: Damage to the second replica of pages: by page id, bytes overwritten, records lost, records that were never archived.
DAMAGE = {"corrupt": (97, 5), "missing": (211, 3), "extra": (307, 11)}


@query(r"""
WITH sizes AS (
  SELECT *, coalesce(floor(page_id / 256.0)::BIGINT, -1099511627776) AS number,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages),
placed AS (
  SELECT page_id, number || '-0' AS archive, strlen(payload) AS length,
         coalesce(sum(strlen(payload)) OVER (PARTITION BY number ORDER BY page_id, payload ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM sizes)
SELECT archive, "offset", page_id, length::BIGINT AS length,
       CASE WHEN page_id % 211 = 3 THEN 'missing' WHEN page_id % 307 = 11 THEN 'extra' ELSE 'corrupt' END AS status
FROM placed WHERE page_id % 97 = 5 OR page_id % 211 = 3 OR page_id % 307 = 11
""")
def op5_fixity(spark, sf_dir):
    """Pages archived twice, the second replica damaged: which records differ, found from the roots down."""
    pages = table(spark, sf_dir, "pages").select("page_id", fixity.record(F.col("url"), F.col("html")).alias("payload"))
    laid = fixity.lay_out(pages, "page_id", "payload")
    hit = {k: F.coalesce(F.col("page_id") % n == r, F.lit(False)) for k, (n, r) in DAMAGE.items()}
    damaged = F.when(hit["corrupt"], F.overlay("payload", F.lit("#"), F.char_length("payload"))).otherwise(F.col("payload"))
    one, two = fixity.manifest(laid, F.col("payload")).columns, F.sha2(damaged, 256)
    lost, extra = hit["missing"].alias("lost"), (hit["extra"] & ~hit["missing"]).alias("extra")
    both = saved(laid.select("page_id", "archive", "offset", "length", F.sha2("payload", 256).alias("digest"), two.alias("digest2"), lost, extra), "replicas")
    left = both.where("not extra").select(*one)
    right = both.where("not lost").select("archive", "offset", "length", F.col("digest2").alias("digest"))
    wrong, _ = fixity.audit(left, right)
    known = both.select("archive", "offset", "page_id", "length")
    return wrong.join(known, ["archive", "offset"]).select("archive", "offset", "page_id", "length", "status")


@query(r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(generate_series(1, len(w) - 4), lambda i : array_to_string(w[i:i+4], ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.a = d.doc_id
""")
def op6_ngram_join(spark, sf_dir):
    """Documents that share three quarters of their five-word shingles, as components."""
    return ngram_join.ngram_join(table(spark, sf_dir, "documents")).documents()


@query()
def op7_sharding(spark, sf_dir):
    """All documents in eight shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long")
    out = histogram_sort.shard(docs, columns={"doc_id": F.col("doc_id").cast("long"), "text_crc32": crc})
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


#: Six common words in a row share a hash: an edit that keeps half of a text is seen from about 14 words on.
FINE = winnowing.WinnowSpec(gram=3, window=4)


@query()
def op8_winnowing(spark, sf_dir):
    """Fingerprints of every document, of its edited text, and how alike they are."""
    found = winnowing.compare_edits(table(spark, sf_dir, "documents"), FINE)
    return found.select(
        "doc_id", F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        winnowing.written(F.col("print")).alias("fingerprint"), winnowing.written(F.col("edited_print")).alias("edited_fingerprint"),
        winnowing.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"), winnowing.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


@query()
def op9_mixing(spark, sf_dir):
    """Documents with the number of times each is drawn, sources mixed so that none is repeated more than four times."""
    mixed = temperature_mixing.mix(table(spark, sf_dir, "documents"), temperature_mixing.MixSpec(repeats=4.0))
    return mixed.select(F.col("doc_id").cast("long").alias("doc_id"), "source", F.col("__tokens").alias("tokens"), "copies", "block")


@query()
def op10_suffix_dedup(spark, sf_dir):
    """Documents without the bytes of any 100-byte string that starts earlier."""
    out = suffix_dedup.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["hi"] - r["lo"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM texts),
windows AS (
  SELECT doc_id, i, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS s
  FROM words QUALIFY i <= n - 34),
often AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i FROM windows JOIN often USING (s)),
cut AS (
  SELECT doc_id, count(h.i) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE h.i IS NULL), '') AS kept
  FROM words LEFT JOIN hit h USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
""")
def op11_superkmers(spark, sf_dir):
    """Documents without the words of any window of 35 words that also starts elsewhere."""
    out = superkmer_dedup.deduplicate(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, r: s + r["hi"] - r["lo"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op12_alignment(spark, sf_dir):
    """Every document's tokens of two vocabularies aligned, and how common its linked pairs of ids are in the corpus."""
    found = token_alignment.align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    out = found.totals(found.documents().withColumn("groups_sha256", digest).drop("groups"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations),
own AS (
  SELECT c, list({'r': r, 't': t} ORDER BY i) AS s,
         xor(list_reduce(list_transform([4294967295] || list_transform(string_split(c::VARCHAR, ''), lambda x : ascii(x)::BIGINT), lambda x : x::BIGINT),
           lambda crc, b : list_reduce([xor(crc, b)] || range(8), lambda v, n : xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 4 AS h
  FROM turns GROUP BY c),
rebuilt AS (SELECT own.c, list_concat(coalesce(f.s[1:own.h], []), own.s[own.h+1:]) AS s FROM own LEFT JOIN own f ON f.c = own.c - own.c % 20),
prefixes AS (SELECT c, s, len(s) AS n, unnest(generate_series(0, len(s))) AS d FROM rebuilt),
keyed AS (SELECT c, n, d, to_json(s[1:d])::VARCHAR AS k, to_json(s[1:greatest(d-1, 0)])::VARCHAR AS up, s[d].t AS t FROM prefixes),
nodes AS (
  SELECT d, k, up, min(c) AS c, count(*) AS n_convs, any_value(len(regexp_extract_all(coalesce(t, ''), '[^\x20\x09-\x0D]+'))) AS words,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
  FROM keyed GROUP BY d, k, up),
children AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY d, up),
below AS (
  SELECT a.d, a.k, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM nodes v LEFT JOIN children USING (d, k) JOIN keyed a ON a.c = v.c AND a.d <= v.d GROUP BY a.d, a.k)
SELECT v.c AS conv_id, v.d AS depth, p.c AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes v LEFT JOIN children USING (d, k) JOIN below USING (d, k) LEFT JOIN nodes p ON p.d = v.d - 1 AND p.k = v.up
""")
def op13_prefix_trie(spark, sf_dir):
    """The prefix trie of all conversations, each with its first turns taken from the first of its family of twenty."""
    turns, lengths = prefix_trie.branched(prefix_trie.numbered(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, lengths).drop("name", "parent")


def load():
    return QUERIES, SQL
