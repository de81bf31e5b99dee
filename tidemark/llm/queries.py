"""One query per corpus operator, with the SQL that must agree where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, conversation_trie, fingerprints, grader, licenses, near_duplicates, ngram_join, outliers, packing, personal_data,
    site_tree, suffix_tree, whitening,
)
from tidemark.llm.common import landed, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and the bytes they decode to, as digests."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, path, pattern).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def packed_pieces(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in windows of 4096 tokens."""
    return packed_pieces(table(spark, folder, "documents"))


@query
def op10_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Word and line statistics of every document, and whether it stands apart from its group."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return outliers.judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 6).alias("distance"),
    )


@query
def op2_grader(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and tail probability of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = grader.fit(docs, table(spark, folder, "labels"))
    return grader.graded(docs, model).select("doc_id", "expected_grade", "tail_probability", "kept")


@query
def op7_odd_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near-duplicates among all documents."""
    return near_duplicates.clusters(table(spark, folder, "documents"))


@query
def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = personal_data.with_spans(docs, personal_data.fit(docs))
    counts = [
        F.size(F.array_remove(F.transform("base", lambda x: x["kind"] != kind), True)).cast("bigint").alias(f"n_{kind}")
        for kind in personal_data.FORMATS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(personal_data.listed("base"), 256).alias("base_sha256"),
        personal_data.listed("spans").alias("spans"),
    )


@query
def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates in every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = licenses.scanned(docs, licenses.rarity(docs))
    labels = list(licenses.PHRASES)
    places = F.concat(*[F.col(f"base.{label}") for label in labels])
    return found.withColumn("places", places).select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"), F.array_max("places").cast("bigint").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    prints = landed(fingerprints.compared(table(spark, folder, "documents")), "fingerprints")
    text = lambda c: F.lpad(F.hex(c), 16, "0")
    return fingerprints.neighbours(prints).select(
        "doc_id", "n_chars", "edited_sha256", text("fingerprint").alias("fingerprint"),
        text("edited_fingerprint").alias("edited_fingerprint"), "near_edited", "near_next", "n_near",
    )


@query
def op9_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Log probability of every document, by unigrams and by the suffix tree."""
    return suffix_tree.scored(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op4_site_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = site_tree.extracted(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query
def op12_spectrum_slices(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on the four leading components of the distinct embeddings, whitened."""
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.whitened(rows, "vec_id", "embedding", whitening.fit(rows, "embedding"))


@query
def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    rows = table(spark, folder, "conversations")
    turns = conversation_trie.ordered_turns(rows, "conv_id", "turn", "role", "text")
    trie = conversation_trie.collapse(*conversation_trie.rebuilt_turns(turns))
    key = conversation_trie.KEY
    return trie.nodes.join(conversation_trie.ends_digests(trie.ends), key, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


# crc32 bit by bit: each byte enters with the first of its eight steps
ORACLE["op11_conversation_trie"] = """
    WITH turns AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
        FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT DISTINCT conv_id FROM turns),
    leads AS (
        SELECT conv_id, conv_id - conv_id % 5 AS base,
               xor(list_reduce(
                   list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(
                       range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                       lambda i: [CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
                   lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), CAST(4294967295 AS BIGINT)) % 9 AS lead
        FROM ids),
    rebuilt AS (
        SELECT l.conv_id, 0 AS own, t.pos, t.role, t.text
        FROM leads l JOIN turns t ON t.conv_id = l.base AND t.pos < l.lead
        UNION ALL
        SELECT l.conv_id, 1, t.pos, t.role, t.text FROM leads l JOIN turns t USING (conv_id) WHERE t.pos >= l.lead),
    sequences AS (
        SELECT i.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY own, pos) FILTER (r.role IS NOT NULL), []) AS s
        FROM ids i LEFT JOIN rebuilt r USING (conv_id) GROUP BY i.conv_id),
    prefixes AS (
        SELECT conv_id, s[1:d] AS key, d AS depth, d = len(s) AS ended
        FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM sequences)),
    nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '') AS ends
        FROM prefixes GROUP BY key, depth),
    inner_nodes AS (
        SELECT key[1:depth - 1] AS key, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
    weighed AS (
        SELECT n.*, coalesce(i.n_children, 0) AS n_children,
               CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * strlen(n.key[n.depth].text) ELSE 0 END AS saved
        FROM nodes n LEFT JOIN inner_nodes i ON i.key = n.key AND i.depth = n.depth),
    subtrees AS (
        SELECT key[1:a] AS key, a AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
        FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM weighed) GROUP BY 1, 2)
    SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, CAST(w.n_children AS BIGINT) AS n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
    FROM weighed w JOIN subtrees s ON s.key = w.key AND s.depth = w.depth
    LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.key = w.key[1:w.depth - 1]"""


@query
def op13_vertical_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose n-gram sets are at least 0.8 similar."""
    return ngram_join.similar(table(spark, folder, "documents"))
