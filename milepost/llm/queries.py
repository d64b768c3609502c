"""Queries of the operators over the given tables, and their comparison SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.llm import (
    byte_bpe,
    icws_dedup,
    lpf_dedup,
    merkle,
    quality_cnn,
    quality_rules,
    secret_scan,
    seed_extend,
    sharding,
    simhash_decontam,
    spelling,
    toxicity,
    warc,
)
from milepost.llm.common import table, tune

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = lambda spark, folder: build(tune(spark), folder)
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query(
    "op1_quality_rules",
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
      FROM documents),
    windows AS (
      SELECT doc_id, i, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
    repeats AS (
      SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + j) AS n FROM repeats, range(5) r(j) GROUP BY doc_id),
    lines AS (
      SELECT doc_id, l, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
             len(regexp_extract_all(l, '[|>•»·]')) AS s,
             len(regexp_extract_all(l, '[!?*#$%&=~_]{2,}')) AS x,
             len(l) - len(regexp_extract_all(l, '[\x20\x09-\x0D]')) AS c
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
    judged AS (
      SELECT *, n > 0 AND ((s > 0 AND 4 * s >= n) OR (x > 0 AND 5 * x >= n)
        OR (n >= 8 AND NOT regexp_matches(l, '[.,;:!?…]'))
        OR (n <= 30 AND (regexp_matches(trim(l, ' '), '(?i)^(home|menu|next|previous|back|top|login|log in|sign in|sign up|register|search|contact|about|sitemap|share|tweet|print|read more|skip to content)[.:]?$')
        OR regexp_matches(l, '(?i)all rights reserved|licensed under|released under the|cookie|privacy policy|terms of (use|service)|enable javascript|lorem ipsum|click here|subscribe to|powered by|copyright [0-9]{4}')))) AS bad
      FROM lines),
    per_doc AS (
      SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT l) FILTER (n > 0) AS n_dup_lines,
             count(*) FILTER (bad) AS n_removed_lines, coalesce(sum(c) FILTER (NOT bad), 0) AS left_chars
      FROM judged GROUP BY doc_id),
    counted AS (
      SELECT doc_id, len(w)::BIGINT AS n_words,
             (len(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             n_dup_lines::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             n_removed_lines::BIGINT AS n_removed_lines, left_chars::BIGINT AS left_chars
      FROM d JOIN per_doc USING (doc_id) LEFT JOIN covered USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
           NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * left_chars >= 50 * word_chars AS kept,
           n_removed_lines, left_chars
    FROM counted
    """,
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.clean(table(spark, folder, "documents")).drop("clean_text")


@query("op3_best_fit_shards")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    packed = sharding.pack(table(spark, folder, "documents"), shards=40)
    return packed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query(
    "op7_warc_revisits",
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
             sha1(coalesce(html, '')) AS payload_digest
      FROM pages),
    first AS (SELECT payload_digest, max(page_id) AS id FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
           CASE WHEN id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN id <> page_id THEN id END AS refers_to, true AS intact
    FROM p LEFT JOIN first USING (payload_digest)
    """,
)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.archive_folder(spark)
    warc.write_archives(table(spark, folder, "pages"), archives)
    read = warc.read_archives(spark, archives)
    intact = (F.sha1("payload") == F.col("payload_digest")) & (F.octet_length("payload") == F.col("payload_bytes"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.select(*columns, F.coalesce(intact, F.col("record_type") == "revisit").alias("intact"))


@query("op6_byte_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(coded, ranks).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.octet_length("starts") / 4).cast("long").alias("n_offsets"),
    )


@query("op2_quality_cnn")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = quality_cnn.train(docs, table(spark, folder, "labels"))
    return quality_cnn.score(docs, net).select(
        "doc_id",
        quality_cnn.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_simhash_decontamination")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = simhash_decontam.find(docs, benchmark)
    return found.select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "first_word", "end_word"
    )


@query("op9_lpf_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    cut = lpf_dedup.remove_repeats(table(spark, folder, "documents"), keep="none")
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op8_icws_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return icws_dedup.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "class_size")


@query("op4_secret_forest")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "place", F.sha2("value", 256).alias("value_sha256"), "length", "label", "probability", "is_secret"
    )


@query("op5_toxicity_chain")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    categories = [f"p_{c}" for c in toxicity.CATEGORIES[:-1]]
    return scored.select(
        "doc_id", *categories, F.col("p_toxic").alias("score"), (F.col("p_toxic") >= 0.5).cast("int").alias("predicted")
    )


# Unsigned crc32, bit by bit, with the reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      range(1, 2 * octet_length({bytes}), 2), lambda i: list_transform(range(8), lambda j:
        (('0x' || substr(hex({bytes}), i, 2))::INT >> j::INT) & 1)))),
      lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""
_LEAF = """sha256(concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
             coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
             coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), coalesce(strlen({text}) || ':' || {text}, '-')))"""


@query(
    "op13_merkle_manifest",
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, source, {_LEAF.format(text="text")} AS leaf,
             CASE WHEN {_CRC.format(bytes="encode(doc_id::VARCHAR)")} % 2 = 0
               THEN {_LEAF.format(text="replace(text, chr(10), '')")} END AS other
      FROM documents),
    low AS (
      SELECT 0 AS level, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n, leaf AS h FROM d
      UNION ALL
      SELECT level + 1, source, pos // 3, (n + 2) // 3, h
      FROM (SELECT level, source, n, pos // 3 * 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
            FROM low WHERE n > 1 GROUP BY level, source, n, low.pos // 3)),
    subroots AS (SELECT source, h AS subroot FROM low WHERE n = 1),
    high AS (
      SELECT 0 AS level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, subroot AS h
      FROM subroots
      UNION ALL
      SELECT level + 1, pos // 3, (n + 2) // 3, h
      FROM (SELECT level, n, pos // 3 * 3 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
            FROM high WHERE n > 1 GROUP BY level, n, high.pos // 3)),
    tops AS (SELECT row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS top, source, subroot FROM subroots),
    places AS (
      SELECT doc_id, d.source, leaf, other, top, subroot,
             row_number() OVER (PARTITION BY d.source ORDER BY doc_id) - 1 AS pos
      FROM d JOIN tops ON d.source IS NOT DISTINCT FROM tops.source),
    runs AS (SELECT level, source, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM low WHERE n > 1 GROUP BY ALL),
    top_runs AS (SELECT level, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM high WHERE n > 1 GROUP BY ALL),
    sides AS (
      SELECT doc_id, level, hs, (pos // (3 ** level)::BIGINT) % 3 AS own
      FROM places p JOIN runs r ON r.source IS NOT DISTINCT FROM p.source AND run = pos // (3 ** (level + 1))::BIGINT
      UNION ALL
      SELECT doc_id, 100 + level, hs, (top // (3 ** level)::BIGINT) % 3
      FROM places JOIN top_runs ON run = top // (3 ** (level + 1))::BIGINT),
    paths AS (
      SELECT doc_id, list(array_to_string(hs[:own], '') || '|' || array_to_string(hs[own + 2:], '') ORDER BY level) AS path
      FROM sides GROUP BY doc_id),
    ends AS (
      SELECT doc_id, leaf, subroot, coalesce(path, []) AS path,
             list_reduce(list_prepend(coalesce(other, leaf), coalesce(path, [])),
               lambda up, s: sha256(split_part(s, '|', 1) || up || split_part(s, '|', 2))) AS folded_root
      FROM places LEFT JOIN paths USING (doc_id))
    SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
           folded_root, folded_root = root AS verified
    FROM ends, (SELECT h AS root FROM high WHERE n = 1)
    """,
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    flat = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    later = merkle.leaf_of(*(F.col(c) for c in fields[:-1]), flat)
    rows = merkle.manifest(table(spark, folder, "documents"), fields, carry={"later": later})
    rows = rows.withColumn("end", merkle.folded(F.col("later"), F.col("path")))
    digests = {"leaf": "leaf", "subroot": "subroot", "root": "root", "folded_root": "end"}
    return rows.select(
        "doc_id",
        *(merkle.text_of(F.col(c)).alias(name) for name, c in digests.items()),
        F.sha2(merkle.siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"),
        (F.col("end") == F.col("root")).alias("verified"),
    )


@query(
    "op12_spelling_variants",
    f"""
    WITH RECURSIVE raw AS (
      SELECT coalesce(doc_id::VARCHAR, '') AS key, count(*) AS n,
             translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
      GROUP BY ALL),
    hashed AS (SELECT run, n, {_CRC.format(bytes="encode(key || ':' || run)")} AS h FROM raw),
    words AS MATERIALIZED (
      SELECT word, sum(n)::BIGINT AS n
      FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                      ELSE run END AS word FROM hashed)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cuts AS (
      SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (
      SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (i, rest) WHERE a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.rest
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.rest),
    best AS (
      SELECT word, count(*) AS n_near, min(near) FILTER (near_n = top) AS form, max(near_n) AS form_n
      FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
    forms AS (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form,
             CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
      FROM words w LEFT JOIN best USING (word)),
    walk AS (
      SELECT word, word AS root, form AS next FROM forms
      UNION ALL
      SELECT walk.word, walk.next, forms.form FROM walk JOIN forms ON forms.word = walk.next)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN walk USING (word) WHERE next IS NULL
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    run, size = F.col("run"), F.char_length("run")
    h = F.crc32(F.concat("key", F.lit(":"), run))
    at = (h % size).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    words = spelling.vocabulary(table(spark, folder, "documents"), spoil=F.when(h % 97 == 0, cut).otherwise(run))
    return spelling.variants(words)


@query(
    "op11_seed_extend",
    r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
    firsts AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
    lost AS (
      SELECT doc_id, i FROM windows JOIN firsts USING (h) WHERE first < doc_id),
    gone AS (SELECT DISTINCT doc_id, i + j AS place FROM lost, range(50) r(j)),
    left_over AS (
      SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) ANTI JOIN gone USING (doc_id, place)
      GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN left_over USING (doc_id)
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    cut = seed_extend.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
