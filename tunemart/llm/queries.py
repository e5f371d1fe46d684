"""The registered queries of this subpackage and, where SQL can express one, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from tunemart import scratch
from tunemart.llm import (
    alignment,
    bpe,
    covertree,
    decontaminate,
    katz,
    langid,
    line_dedup,
    sharding,
    simhash,
    substring_dedup,
    threshold_kmeans,
    token_counts,
    warc,
)
from tunemart.llm.common import fold, table, text_key

VOCABULARY = "byte_bpe_50k.tiktoken"
SHARD_BYTES = 1024**2


def vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of documents that stand in a document before, too."""
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.drop("text_mark", "text_crc")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    document = vocabulary(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), document, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, document)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as deduplicated archives, read back."""
    found = warc.deduplicate(table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op4_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document: 1 MiB of text at most, but for a longer single text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"))
    return sharding.shard(docs, "doc_id", F.col("n_bytes"), SHARD_BYTES)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    model = langid.train(docs, fold(F.col("doc_id"), 4) != 2)
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and its component of those within two bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op7_token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after three batches of changes, two of them delivered twice.

    All documents come in, counted by the first tokenizer version; then all are counted by the
    second one as well and what the first one counted in them is revised to leave out tokens
    without a letter or digit; then copies go, of either version.
    """
    docs = table(spark, sf_dir, "documents")
    first, second = token_counts.words(F.col("text")), token_counts.words_and_marks(F.col("text"))
    plain = F.regexp_replace("text", r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]", "")
    counted = scratch.materialize(
        docs.select(
            "doc_id",
            "source",
            "lang",
            text_key(F.col("text")).alias("text_key"),
            first.alias("first"),
            token_counts.words(plain).alias("revised"),
            second.alias("second"),
        ),
        "counted",
    )
    originals = counted.groupBy("text_key").agg(F.min("doc_id").alias("kept_id"))
    copies = counted.join(originals, "text_key").filter("doc_id <> kept_id")

    def changes(rows: DataFrame, tokenizer: str, change: str, n: str, old: str | None = None) -> DataFrame:
        return rows.select(
            "source",
            "lang",
            F.lit(tokenizer).alias("tokenizer"),
            F.lit(change).alias("change"),
            F.col(n).alias("n_tokens"),
            (F.col(old) if old else F.lit(None).cast("long")).alias("old_n_tokens"),
        )

    rollup = token_counts.Rollup(spark, scratch.new_folder(spark, "totals"))
    arrive = changes(counted, "words-1", "insert", "first")
    revise = changes(counted, "words-1", "revise", "revised", "first").union(
        changes(counted, "words-2", "insert", "second")
    )
    leave = changes(copies, "words-1", "delete", "revised").union(changes(copies, "words-2", "delete", "second"))
    for batch, rows in (("1", arrive), ("2", revise), ("2", revise), ("3", leave), ("1", arrive)):
        rollup.commit(batch, rows)
    return rollup.totals()


def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents, learned from nine of ten folds."""
    found = katz.scores(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 10) != 0)
    held_out = F.coalesce(fold(F.col("doc_id"), 10) == 0, F.lit(False)).alias("held_out")
    return found.select(
        "doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_cover_tree_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with cosine 0.95 or more."""
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens that two tokenizers make of every document."""
    a_document = vocabulary(public_tokenizers.path("byte_bpe_50k.json")).decode()
    b_document = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), a_document, b_document)


def op12_threshold_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every usable embedding after three rounds from 16 centroids."""
    found = threshold_kmeans.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64, scale=64.0, seed="1")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without lines that two others hold, but for the last that holds them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = line_dedup.LineIndex(spark, scratch.new_folder(spark, "lines"), min_docs=3, min_chars=20)
    index.commit("all", added=docs)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return index.deduplicate(docs).select("doc_id", "n_lines", "n_dropped", kept)


QUERIES = {
    "op1_repeated_passages": op1_repeated_passages,
    "op2_bpe_round_trip": op2_bpe_round_trip,
    "op3_warc_revisits": op3_warc_revisits,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_language": op5_language,
    "op6_simhash_golay": op6_simhash_golay,
    "op7_token_totals": op7_token_totals,
    "op8_katz_scores": op8_katz_scores,
    "op9_template_leaks": op9_template_leaks,
    "op10_cover_tree_pairs": op10_cover_tree_pairs,
    "op11_token_alignment": op11_token_alignment,
    "op12_threshold_clusters": op12_threshold_clusters,
    "op13_line_index": op13_line_index,
    "pipeline": corpus_pipeline.run,
}
# Base 32 of a SHA-1: five hexadecimal digits are twenty bits, or four characters.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP3_SQL = f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), d AS (
  SELECT page_id, url, h, cast(strlen(payload) AS bigint) AS payload_bytes,
    min(page_id) OVER (PARTITION BY h) AS first_id FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', cast(1 +
    ((cast(concat('0x', substr(h, cast(i // 4 * 5 + 1 AS int), 5)) AS bigint) >> cast(15 - i % 4 * 5 AS bigint)) & 31) AS int), 1)), '')
    AS payload_digest FROM d
)
SELECT page_id, payload_bytes, payload_digest, url,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM b
"""

OP4_SQL = f"""
WITH k AS (
  SELECT doc_id, cast(strlen(text) AS bigint) AS n_bytes,
    lpad(bin(cast(concat('0x', substr(md5(cast(doc_id AS varchar)), 1, 15)) AS bigint)), 60, '0') AS bits
  FROM documents
), cells AS (
  SELECT d, substr(bits, 1, d) AS shard, sum(n_bytes) AS shard_bytes, count(*) AS n
  FROM k, (SELECT cast(unnest(range(0, 41)) AS int) AS d) GROUP BY ALL
), fit AS (
  SELECT doc_id, n_bytes, shard, d, shard_bytes,
    row_number() OVER (PARTITION BY doc_id ORDER BY d) AS r
  FROM k JOIN cells ON substr(bits, 1, d) = shard WHERE shard_bytes <= {SHARD_BYTES} OR n = 1
)
SELECT doc_id, n_bytes, shard, d AS depth, cast(shard_bytes AS bigint) AS shard_bytes,
  shard_bytes > {SHARD_BYTES} AS oversized FROM fit WHERE r = 1
"""

_MARKS = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
OP7_SQL = rf"""
WITH k AS (
  SELECT source, lang, doc_id = min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
    len(regexp_extract_all(regexp_replace(text, '{_MARKS}', '', 'g'), '[^\x20\x09-\x0D]+')) AS one,
    len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|{_MARKS}')) AS two
  FROM documents
)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS n_docs, cast(sum(one) AS bigint) AS n_tokens
FROM k WHERE kept GROUP BY ALL
UNION ALL
SELECT source, lang, 'words-2', count(*), cast(sum(two) AS bigint) FROM k WHERE kept GROUP BY ALL
"""

OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, cast(embedding AS double[]) AS e,
    embedding IS NOT NULL AND len(embedding) > 0
      AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
      AND list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false))) AS usable
  FROM embeddings
), u AS (SELECT vec_id, e FROM v WHERE usable),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), parts AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM parts LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
"""



def _op12_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Each round as a few expressions: nearest centroids, then floored means of components."""

    def nearest(name: str, centroids: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT vec_id, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), g := g)) AS m
  FROM v, {centroids} GROUP BY ALL)"""

    steps = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e AS double)) AS bigint)) AS x
  FROM embeddings WHERE len(embedding) = {dims}
    AND list_bool_and(list_transform(embedding, lambda e: coalesce(isfinite(e), false))))""",
        f"""c0 AS MATERIALIZED (
  SELECT cast(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS int) AS g, x AS c
  FROM v ORDER BY sha256('1:' || vec_id) LIMIT {k})""",
    ]
    for r in range(1, rounds + 1):
        steps.append(nearest(f"a{r}", f"c{r - 1}"))
        steps.append(
            f"""s{r} AS (
  SELECT g, i, cast((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS bigint) AS mean
  FROM (SELECT m.g AS g, unnest(x) AS e, unnest(range({dims})) AS i FROM a{r}) GROUP BY g, i)"""
        )
        steps.append(
            f"""c{r} AS MATERIALIZED (
  SELECT g, coalesce(means, c) AS c
  FROM c{r - 1} LEFT JOIN (SELECT g, list(mean ORDER BY i) AS means FROM s{r} GROUP BY g) USING (g))"""
        )
    steps.append(nearest("last", f"c{rounds}"))
    return f"""WITH {", ".join(steps)}
SELECT vec_id, m.g AS cluster, cast(m.d AS bigint) AS distance,
  cast(sum(m.d) OVER (PARTITION BY m.g) AS bigint) AS cluster_inertia, cast(sum(m.d) OVER () AS bigint) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN c{rounds} ON m.g = g"""


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP13_SQL = f"""
WITH lines AS (
  SELECT doc_id, line, i,
    translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS last_id FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines, cast(count(*) FILTER (doc_id <> last_id) AS bigint) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last_id IS NULL OR doc_id = last_id), '')) AS kept_sha256
FROM lines LEFT JOIN repeated USING (key) GROUP BY doc_id
"""

ORACLE_SQL = {
    "op12_threshold_clusters": _op12_sql(),
    "op13_line_index": OP13_SQL,
    "op10_cover_tree_pairs": OP10_SQL,
    "op3_warc_revisits": OP3_SQL,
    "op4_extendible_sharding": OP4_SQL,
    "op7_token_totals": OP7_SQL,
}
