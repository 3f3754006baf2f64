"""The corpus queries and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profilelake.llm import (
    archives,
    decontaminate,
    licenses,
    near_duplicates,
    phrases,
    pieces,
    quality_rules,
    repeats,
    rule_ensemble,
    secrets,
    shards,
    shuffle_shards,
    whitening,
)
from profilelake.llm.common import scratch, table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS_PATTERN = public_tokenizers.PATTERN
#: The vocabulary leaves the last id free, which then ends a document.
TOKEN_IDS = shards.rank_ids(RANKS, RANKS_PATTERN, 50256)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and prediction of every document."""
    return rule_ensemble.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text that they decode to, as digests."""
    return pieces.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the edit distance."""
    return decontaminate.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sequences in training order, read back from their shards."""
    folder = scratch(spark, "token-shards")
    cut = shards.cut_sequences(table(spark, sf_dir, "documents"), TOKEN_IDS)
    written = shards.write_shards(cut, folder, TOKEN_IDS)
    return shards.read_shards(spark, written, folder, TOKEN_IDS)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return near_duplicates.duplicate_classes(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secrets.scan(table(spark, sf_dir, "documents"), RANKS, RANKS_PATTERN)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through legacy archives and WARC files, as read back."""
    return archives.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that stay once repeated strings are gone."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, log-likelihood ratio and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return shuffle_shards.assign(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding; a deviation beyond 64 bits is null."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: function
        for name, function in sorted(globals().items())
        if name.startswith("op") and callable(function)
    }


ORACLE = {
    "op7_warc": """
        WITH payloads AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN
                   min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM firsts
    """,
    "op12_phrases": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w
            FROM pieces
        ), grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
            FROM split, range(1, 6) AS lengths(k)
            WHERE len(w) >= k
        ), f AS (
            SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
        ), found AS (
            SELECT * FROM f WHERE k > 1 AND f >= 100
        ), longer AS (
            SELECT lang, g, max(f) AS longer, sum(is_right) AS n_right, sum(1 - is_right) AS n_left
            FROM (SELECT lang, g[1:k - 1] AS g, f, 1 AS is_right FROM found WHERE k > 2
                  UNION ALL SELECT lang, g[2:k], f, 0 FROM found WHERE k > 2)
            GROUP BY lang, g
        ), cuts AS (
            SELECT c.lang, c.g, c.f AS a, n, cut, x.f AS l, y.f AS r,
                   1000 * c.f::HUGEINT * n::HUGEINT // (x.f::HUGEINT * y.f) AS score
            FROM found c
            JOIN totals USING (lang)
            JOIN range(1, 5) AS cuts(cut) ON cut < c.k
            JOIN f x ON x.lang = c.lang AND x.g = c.g[1:cut]
            JOIN f y ON y.lang = c.lang AND y.g = c.g[cut + 1:c.k]
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
        ), ranked AS (
            SELECT best.lang, array_to_string(best.g, ' ') AS phrase, a, l, r, n, score,
                   coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right
            FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.g = best.g
            WHERE longer IS NULL OR longer.longer < a
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score,
               n_left::BIGINT AS n_left, n_right::BIGINT AS n_right
        FROM ranked
        QUALIFY rank <= 2000
    """,
}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are tested against brute force."""
    return dict(ORACLE)
