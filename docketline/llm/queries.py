"""The registered queries of the text operators, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.llm.common import scratch, table
from docketline.llm.decontaminate import decontaminate
from docketline.llm.exact_dedup import exact_duplicates
from docketline.llm.jaccard_join import jaccard_components
from docketline.llm.line_dedup import drop_common_lines
from docketline.llm.lm_score import score_texts
from docketline.llm.merkle import document_leaves, manifest
from docketline.llm.packing import pack_sequences
from docketline.llm.piece_codec import encode_decode
from docketline.llm.prefix_trie import conversation_trie
from docketline.llm.substring_dedup import remove_passages
from docketline.llm.suffix_dedup import remove_repeats
from docketline.llm.toxicity import score_toxicity
from docketline.llm.warc import normalise, read_archives, warc_records, write_monolithic


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages to whole-file gzip archives, normalised and read back by index (contract of operator 1)."""
    folder = scratch(spark, "warc")
    write_monolithic(warc_records(table(spark, sf_dir, "pages"), least_bytes=100), f"{folder}/crawl")
    normalise(spark, f"{folder}/crawl", f"{folder}/archives")
    return read_archives(spark, f"{folder}/archives").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that repeat one of a smaller document: five-word shingles, similarity 0.8."""
    out = remove_passages(table(spark, sf_dir, "documents"), k=5, percent=80)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "source_ids")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in all documents (contract of operator 3)."""
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: components of all documents (contract of operator 4)."""
    return jaccard_components(table(spark, sf_dir, "documents"), k=5, percent=80).drop("kid", "kth")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram model and unigram base over all documents (contract of operator 5)."""
    return score_texts(table(spark, sf_dir, "documents"), folds=10, held_fold=0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Ids and decoded texts of all documents, as digests (contract of operator 6)."""
    out = encode_decode(table(spark, sf_dir, "documents"), model or public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go everywhere (contract of operator 7)."""
    out = drop_common_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents (contract of operator 8)."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50-byte strings that start in a smaller document too (contract of operator 9)."""
    out = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts; the largest id stays (contract of operator 10)."""
    return exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves, roots and proofs of all documents (contract of operator 11)."""
    return manifest(document_leaves(table(spark, sf_dir, "documents"))).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of all rebuilt conversations' first turns (contract of operator 12)."""
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("a", "b")


def op13_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents' token ids in sequences of 1024 (contract of operator 13)."""
    out = pack_sequences(table(spark, sf_dir, "documents"), tokenizer or public_tokenizers.path("byte_bpe_50k.json"), window=1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_substring_dedup, op3_decontaminate, op4_ngram_jaccard, op5_lm_score, op6_sentencepiece, op7_line_dedup, op8_toxicity, op9_suffix_dedup,
    op10_exact_dedup, op11_merkle, op12_prefix_trie, op13_packing)}

#: CRC-32 of a number's decimal digits, over a table ``crc(t)`` of the 256 remainders
_CRC_TABLE = """
crc AS MATERIALIZED (SELECT list_transform(range(256), lambda n: list_reduce([n] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
       lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC = """xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
_AZ = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN f < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN f < page_id THEN f END AS refers_to FROM g""",
    "op3_decontaminate": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM win),
pos AS (SELECT doc_id, p, m, array_to_string(w[p:p + m - 1], ' ') AS t
        FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d), sizes WHERE p + m - 1 <= len(w)),
hit AS (SELECT doc_id, p, pos.m, item_id FROM pos JOIN win ON pos.t = win.t AND pos.m = win.m),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op4_ngram_jaccard": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_AZ.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[p:p + 4], ' ')) AS h
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
link AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
reach AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.doc_id)
SELECT reach.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY reach.doc_id""",
    "op7_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS p FROM documents),
k AS (SELECT *, {_AZ.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM l),
bad AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE bad.key IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE bad.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN bad ON k.key = bad.key GROUP BY doc_id""",
    "op10_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op11_merkle": f"""
WITH RECURSIVE {_CRC_TABLE},
d AS MATERIALIZED (SELECT doc_id, lang, n_chars, t[1] IS NOT NULL AND doc_id IS NOT NULL AND {_CRC.format("coalesce(doc_id, 0)")} % 7 = 0 AS hit,
      {_FIELD.format("doc_id")} || {_FIELD.format("source")} || {_FIELD.format("lang")} AS head, {_FIELD.format("text")} AS tail FROM documents, crc),
leaf AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, sha256(head || {_FIELD.format("n_chars")} || tail) AS h,
               sha256(head || CASE WHEN hit THEN {_FIELD.format("n_chars + 1")} ELSE {_FIELD.format("n_chars")} END || tail) AS h2 FROM d)),
node AS (SELECT lang, 0 AS level, i, h, n FROM leaf UNION ALL
  SELECT lang, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM node WHERE n > 1 GROUP BY lang, level, i // 2),
sub AS MATERIALIZED (SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (SELECT 0 AS level, i, h, n FROM sub UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY level, i // 2),
placed AS (SELECT leaf.*, row_number() OVER () AS id, sub.h AS subroot, sub.i AS li FROM leaf JOIN sub ON leaf.lang IS NOT DISTINCT FROM sub.lang),
step AS (
  SELECT id, 0 AS tier, a.level, a.i % 2 AS side, b.h FROM (SELECT id, placed.lang, u.level, placed.i >> u.level AS i FROM placed
    JOIN (SELECT DISTINCT lang, level FROM node WHERE n > 1) u ON placed.lang IS NOT DISTINCT FROM u.lang) a
  LEFT JOIN node b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND b.i = xor(a.i, 1)
  UNION ALL
  SELECT id, 1, a.level, a.i % 2, b.h FROM (SELECT id, u.level, li >> u.level AS i FROM placed, (SELECT DISTINCT level FROM top WHERE n > 1) u) a
  LEFT JOIN top b ON a.level = b.level AND b.i = xor(a.i, 1)),
proof AS (SELECT id, string_agg(h, '' ORDER BY tier, level) AS p,
                 list(CASE WHEN h IS NULL THEN 'N' WHEN side = 1 THEN 'L' || h ELSE 'R' || h END ORDER BY tier, level) AS path FROM step GROUP BY id),
folded AS (SELECT placed.*, coalesce(p, '') AS p, list_reduce([h2] || coalesce(path, []), lambda acc, s: sha256(
    CASE s[1] WHEN 'L' THEN s[2:] || acc WHEN 'R' THEN acc || s[2:] ELSE acc END)) AS f FROM placed LEFT JOIN proof USING (id))
SELECT doc_id, folded.h AS leaf, subroot, r.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM folded, (SELECT h FROM top WHERE n = 1) r""",
    "op12_prefix_trie": f"""
WITH {_CRC_TABLE},
said AS (SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY conversations.turn NULLS FIRST, role, text) AS p FROM conversations),
own AS (SELECT conv_id, list(turn ORDER BY p) AS l, any_value({_CRC.format("conv_id")} % 6) AS h FROM said, crc GROUP BY conv_id),
conv AS MATERIALIZED (SELECT a.conv_id, coalesce(b.l[1:a.h], []) || a.l[a.h + 1:] AS l FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
pre AS MATERIALIZED (SELECT conv_id, len(l) AS size, d, sha256(CAST(to_json(l[1:d]) AS VARCHAR)) AS k, sha256(CAST(to_json(l[1:d - 1]) AS VARCHAR)) AS up,
       CASE WHEN d > 0 THEN length(l[d][2]) ELSE 0 END AS w FROM (SELECT *, unnest(range(len(l) + 1)) AS d FROM conv)),
node AS MATERIALIZED (SELECT k, any_value(CASE WHEN d > 0 THEN up END) AS up, any_value(d) AS d, min(conv_id) AS c, count(*) AS n, any_value(w) AS w,
       coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE size = d), '') AS ends FROM pre GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY 1),
below AS (SELECT a.k, CAST(count(*) FILTER (WHERE kids.n IS NULL) AS BIGINT) AS leaves, CAST(sum((v.n - 1) * v.w) AS BIGINT) AS saved
          FROM node v JOIN pre a ON a.conv_id = v.c AND a.d <= v.d LEFT JOIN kids ON kids.k = v.k GROUP BY a.k)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, u.c AS parent_conv_id, v.n AS n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves,
       saved AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM node v LEFT JOIN node u ON u.k = v.up LEFT JOIN kids ON kids.k = v.k JOIN below ON below.k = v.k""",
}
