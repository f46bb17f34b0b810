"""The registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtide.llm import (
    attention_lm, byte_bpe, exact_dedup, importance, pii, prefix_trie, quality, quantised, simhash, tiling, token_counts,
    toxicity, warc)
from playtide.llm.frames import stored, whole_text
from playtide.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_warc", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    f AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
                 CASE WHEN strlen(h) >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM f""")
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    number = lambda name: F.regexp_extract(name, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")
    found = warc.records(warc.read(spark, path)).select(
        number("record_id").alias("page_id"), F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"), F.substring_index("payload_digest", ":", -1).alias("named"))
    index = stored(found, "warc-index")
    kept = index.where("record_type = 'response'").drop("named")
    # A revisit has no payload of its own: its length is that of the response that was read, null if that was lost.
    full = (kept.select(F.col("page_id").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("named"))
            .distinct())
    again = index.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(
        full, ["refers_to", "named"], "left")
    return kept.unionByName(again.withColumnRenamed("named", "payload_digest"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", whole_text().alias("text"))
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "n_tokens",
                          (F.col("n_tokens") > 4096).alias("over_limit"))


def bucket(modulus: int) -> Column:
    """The remainder that decides which rows labels are learnt from."""
    return F.pmod(F.crc32(F.col("id").cast("string")), F.lit(modulus))


def toxicity_network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Network | float:
    labels = table(spark, sf_dir, "labels")
    return toxicity.train(*toxicity.training_rows(docs, labels, "toxic", bucket(3) != 1))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_network(spark, docs, sf_dir))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    described = stored(quality.with_statistics(docs).drop("text"), "statistics")
    rows = quality.training_rows(described, table(spark, sf_dir, "labels"), "quality", bucket(5) != 0)
    scored = quality.score(described, quality.fit(rows))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op5_attention_lm")
def op5_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = attention_lm.score(table(spark, sf_dir, "documents"), bucket(7) != 2,
                                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.protect(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS[:4]), F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
                        pii.joined(pii.all_spans()).alias("spans"))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = simhash.label_near_copies(table(spark, sf_dir, "documents"))
    return labelled.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                           "component_id")


@query("op8_decontamination")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", (F.col("covered_words") / F.col("item_words")).alias("coverage"),
                        "covered_words", F.size("tiles").alias("n_tiles"))


@query("op9_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copy_report(table(spark, sf_dir, "documents"), keep="largest")


@query("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks, pattern)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


# CRC-32 in SQL: its table of 256 entries from the polynomial, and a word's bytes from its hexadecimal form.
CRC32 = """
    crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
        CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries),
    crcs AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(word), (2 * i - 1)::INT, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1]))) AS crc FROM {words}, crc_table)"""


@query("op11_importance", f"""
    WITH texts AS (
        SELECT false AS aim, doc_id AS id, text FROM documents UNION ALL SELECT true, item_id, text FROM benchmark),
    held AS (SELECT aim, id, row_number() OVER () AS place, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
    uses AS MATERIALIZED (SELECT aim, place, unnest(words) AS word FROM held),
    different AS (SELECT DISTINCT word FROM uses),
    {CRC32.format(words="different")},
    hits AS (SELECT aim, place, crc % 10000 AS bucket FROM uses JOIN crcs USING (word)),
    counts AS (SELECT bucket, count(*) FILTER (WHERE aim) AS t, count(*) FILTER (WHERE NOT aim) AS s FROM hits GROUP BY bucket),
    gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
    weights AS (SELECT place, sum(gain)::BIGINT AS weight FROM hits JOIN gains USING (bucket) WHERE NOT aim GROUP BY place),
    scored AS (SELECT id AS doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(id::VARCHAR, '')), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM held LEFT JOIN weights USING (place) WHERE NOT aim),
    places AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
        count(*) FILTER (WHERE n_features >= 20) OVER () AS n FROM scored)
    SELECT doc_id, n_features, weight, score,
           CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
    FROM places""")
def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10, 2024)
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


@query("op12_quantised", """
    WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e, len(embedding) AS w FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    linked AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.w = b.w AND a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.e, b.e) >= 0.95),
    reach AS (SELECT vec_id AS start, vec_id AS node FROM embeddings
              UNION SELECT start, b FROM reach JOIN linked ON a = node),
    least AS (SELECT start, min(node) AS component_id FROM reach GROUP BY start),
    counts AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least ON start = vec_id LEFT JOIN counts ON a = vec_id""")
def op12_quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantised.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op13_prefix_trie", f"""
    WITH turns AS MATERIALIZED (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '')
            || coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL),
    named AS (SELECT DISTINCT c::VARCHAR AS word FROM turns),
    {CRC32.format(words="named")},
    convs AS (SELECT c, count(*) AS own, any_value(crc) % 6 AS h, c - c % 100 AS base
              FROM turns JOIN crcs ON word = c::VARCHAR GROUP BY c),
    plan AS MATERIALIZED (SELECT a.*, least(a.h, coalesce(b.own, 0)) AS taken, least(a.h, coalesce(b.own, 0))
              + greatest(a.own - a.h, 0) AS len FROM convs a LEFT JOIN convs b ON b.c = a.base),
    rebuilt AS (SELECT plan.c, len, p AS d, r, x FROM plan JOIN turns ON turns.c = base AND p <= h
                UNION ALL SELECT c, len, p - h + taken, r, x FROM plan JOIN turns USING (c) WHERE p > h),
    members AS (SELECT c, len, d, length(x) AS chars, list({{'r': r, 'x': x}}) OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
                UNION ALL SELECT c, len, 0, 0, [] FROM plan),
    placed AS MATERIALIZED (SELECT *, min(c) OVER (PARTITION BY d, path) AS node FROM members),
    edges AS (SELECT *, lag(node) OVER (PARTITION BY c ORDER BY d) AS parent FROM placed),
    nodes AS MATERIALIZED (SELECT node, d, any_value(parent) AS parent, count(*) AS n_convs, any_value(chars) AS chars,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE d = len), '')) AS ends_sha256
        FROM edges GROUP BY node, d),
    children AS MATERIALIZED (SELECT parent AS node, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
    below AS (SELECT u.node, u.d, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum((n_convs - 1) * n.chars) AS saved
        FROM nodes n JOIN placed u ON u.c = n.node AND u.d <= n.d LEFT JOIN children k ON k.node = n.node AND k.d = n.d
        GROUP BY u.node, u.d)
    SELECT n.node AS conv_id, n.d::BIGINT AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
           n_leaves, saved::BIGINT AS saved_tokens, ends_sha256
    FROM nodes n JOIN below b ON b.node = n.node AND b.d = n.d LEFT JOIN children k ON k.node = n.node AND k.d = n.d""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.turns_of(table(spark, sf_dir, "conversations"))))
