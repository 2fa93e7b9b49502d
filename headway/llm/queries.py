"""The operators over the given tables, each with production parameters and its full result."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame], sql: str | None = None):
    QUERIES[run.__name__] = run
    if sql is not None:
        SQL[run.__name__] = sql
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    from headway.llm import packing

    docs = table(spark, sf_dir, "documents")
    pieces = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    # Only the digest of the ids is asked for, so only that goes through the shuffles.
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.packed_pieces(digests)


@query
def op4_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids through the lexicon and back."""
    from headway.llm import encoding

    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_50k.json")
    done = encoding.round_trip(docs, path, encoding.build_lexicon(docs, path))
    return done.select(
        "doc_id",
        F.expr("length(ids) DIV 4").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text without the bytes of repeated strings of 400 bytes."""
    from headway.llm import suffixes

    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        # What is left as text; a character of which a part went shows as U+FFFD.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of copies and near copies, and its number of links."""
    from headway.llm import forest

    return forest.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one, among all."""
    from headway.llm import neighbours

    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of secrets in every text."""
    from headway.llm import secrets

    scanned = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.KINDS))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)]
    return scanned.select(
        "doc_id", *counts, F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every text."""
    from headway.llm import quality

    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    from headway.llm import urls

    return urls.judge(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from the labels of four documents in five."""
    from headway.llm import langid

    docs = table(spark, sf_dir, "documents")
    away = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.learn(docs.where(~away)))
    return found.select("doc_id", away.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License passages of every text."""
    from headway.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op11_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data in every text."""
    from headway.llm import personal

    scanned = personal.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(personal.KINDS))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(personal.KINDS)]
    return scanned.select(
        "doc_id", *counts, F.sha2(personal.written(base), 256).alias("base_sha256"),
        personal.written(F.col("spans")).alias("spans"),
    )


RANKED = r"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
               FROM documents),
    t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL),
    n AS (SELECT row, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
    a AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS len FROM n),
    w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
          FROM (SELECT term, count(*) AS df FROM t GROUP BY term), a),
    q AS (SELECT item_id, term, count(*) AS times
          FROM (SELECT item_id, unnest(regexp_extract_all(
                           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
          GROUP BY ALL),
    s AS (SELECT item_id, doc_id, row,
                 sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // len))))::BIGINT
                     AS score
          FROM q JOIN w USING (term) JOIN t USING (term) JOIN n USING (row), a GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
          FROM s WHERE score > 0)
    SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 20
"""


@partial(query, sql=RANKED)
def op12_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    from headway.llm import maxscore

    return maxscore.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


MINED = """
    WITH r AS (SELECT row_number() OVER () AS row, vec_id,
                      CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND embedding IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same,
                 list_inner_product(a.v, b.v)::BIGINT AS score
          FROM r AS a JOIN r AS b ON a.row <> b.row AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
    p AS (SELECT anchor, row, vec_id, score FROM s WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5),
    n AS (SELECT s.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id,
                 p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
          FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
           AND 100 * s.score BETWEEN 50 * p.score AND 95 * p.score)
    SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 3
"""


@partial(query, sql=MINED)
def op13_shared_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, with some labels moved on by one."""
    from headway.llm import negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return negatives.mine(vectors, F.col("vec_id") % 50 == 0)
