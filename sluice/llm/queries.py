"""The queries of the operators in this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import bpe_words, lang_backoff, license_diagonals, lsa_decontam, pii_disclosure, quartile_digest, recompression, simhash_gray, spelling_tries, toxicity_gru, turn_grammar, warc_shards, zstd_quality
from sluice.scratch import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op2_simhash_near_dedup(spark, sf_dir):
    found = simhash_gray.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@_query()
def op4_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_words.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe_words.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


@_query()
def op6_quartile_digest(spark, sf_dir):
    found = quartile_digest.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


@_query("""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page,
         row_number() OVER (PARTITION BY payload_digest ORDER BY page_id) AS place FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND place > 1 THEN first_page END AS refers_to
FROM f
""")
def op7_warc_shards(spark, sf_dir):
    root = scratch_path(spark, "warc")
    warc_shards.write_archives(_table(spark, sf_dir, "pages"), root)
    return warc_shards.read_archives(spark, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query()
def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string")) % 5
    model = lang_backoff.fit(docs.filter(remainder != 0))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False))
    return lang_backoff.predict(docs, model).select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score"
    )


@_query(r"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), w AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS pos FROM t WHERE len(words) >= 50)
), late AS (
  SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first_doc FROM w) WHERE doc_id > first_doc
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM late
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.pos) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM t) p
  LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos WHERE g.pos IS NULL GROUP BY p.doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
""")
def op10_recompression(spark, sf_dir):
    found = recompression.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query()
def op9_license_diagonals(spark, sf_dir):
    found = license_diagonals.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.exact)
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s.label))), ",")
    start = F.transform(base, lambda s: s.start.cast("long"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(start).alias("first_word"), F.array_max(start).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("spans")).alias("labels"), "score",
    )


@_query()
def op8_pii_disclosure(spark, sf_dir):
    found = pii_disclosure.find(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *[count(k) for k in pii_disclosure.KINDS],
        F.sha2(pii_disclosure.span_list(F.col("base")), 256).alias("base_sha256"),
        pii_disclosure.span_list(F.concat("base", "terms")).alias("spans"),
    )


@_query()
def op5_lsa_decontamination(spark, sf_dir):
    found = lsa_decontam.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "coverage", "answer", "first_word", "past_word", "cosine")


@_query()
def op3_toxicity_gru(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    remainder = lambda c: F.crc32(F.col(c).cast("string")) % 3
    network = toxicity_gru.fit(docs, labels.filter(remainder("doc_id") != 1))
    return toxicity_gru.score(docs, network).select(
        F.col("id").alias("doc_id"), F.coalesce(remainder("id") == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity_gru.THRESHOLD).cast("int").alias("predicted"),
    )


#: CRC-32 in SQL: a table of one row with the list ``crc_table``, and the crc of the text whose UTF-8 bytes are in hex in ``hexed``.
_CRC_TABLE = (
    "SELECT list(list_reduce(list_concat([b], range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY b) AS crc_table "
    "FROM range(256) t(b)"
)
_CRC = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, length(hexed), 2),
      lambda i: ((instr('0123456789ABCDEF', hexed[i]) - 1) * 16 + instr('0123456789ABCDEF', hexed[i + 1]) - 1)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[xor(c & 255, b) + 1])))"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _damaged_words(docs: DataFrame) -> DataFrame:
    """The words of op11 with their counts: runs of letters, of which one in 199 loses a code point."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z\u00C0-\u00FF]+"), F.lit(0))).alias("run"))
    runs = runs.filter(F.length("run") >= 6).select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = runs.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run")))
    cut = "concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))"
    words = h.select(F.expr(f"CASE WHEN h % 199 = 0 THEN {cut} ELSE run END").alias("word")).filter(F.length("word") >= 6)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 5")


@_query(f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, '{_UPPER}', '{_LOWER}') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) WHERE length(run) >= 6
), bits AS (
  {_CRC_TABLE}
), keyed AS (
  SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hexed FROM (SELECT doc_id, run, count(*) AS m FROM runs GROUP BY ALL)
), hashed AS (
  SELECT run, m, {_CRC} AS h FROM keyed, bits
), words AS (
  SELECT word, sum(m)::BIGINT AS n FROM (
    SELECT m, CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5
), skipped AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT x.word, y.word AS other FROM skipped x JOIN skipped y ON x.a = y.a AND x.b = y.b WHERE x.word <> y.word
  UNION SELECT x.word, y.word FROM skipped x JOIN words y ON x.a || x.b = y.word
  UNION SELECT y.word, x.word FROM skipped x JOIN words y ON x.a || x.b = y.word
), best AS (
  SELECT word, n_near, form, form_n FROM (
    SELECT near.word, count(*) OVER (PARTITION BY near.word) AS n_near, o.word AS form, o.n AS form_n,
      row_number() OVER (PARTITION BY near.word ORDER BY o.n DESC, encode(o.word)) AS place
    FROM near JOIN words o ON o.word = near.other) WHERE place = 1
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed last ON last.word = c.at AND last.form IS NULL
""")
def op11_spelling_tries(spark, sf_dir):
    words = _damaged_words(_table(spark, sf_dir, "documents"))
    return spelling_tries.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@_query()
def op12_zstd_quality(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    remainder = lambda c: F.crc32(F.col(c).cast("string")) % 5
    model = zstd_quality.fit(docs, labels.filter(remainder("doc_id") != 0))
    return zstd_quality.score(docs, model).select(
        F.col("id").alias("doc_id"), F.coalesce(remainder("id") == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= zstd_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def _damaged_turns(rows: DataFrame) -> DataFrame:
    """The rows of op13: by a checksum of conversation and turn some are dropped, emptied, cut, repeated or given to the user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        "conv_id", "turn", F.when(h == 4, "user").otherwise(text("role")).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.explode(F.when(h == 0, F.array().cast("array<int>")).when(h == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


@_query(f"""
WITH RECURSIVE bits AS ({_CRC_TABLE}), keyed AS (
  SELECT *, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS hexed FROM conversations
), hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS h FROM keyed, bits
), damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE h WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY n) AS before
  FROM placed
), inserts(x, y, c, e) AS (
  VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
), steps(x, y, c, e, initial) AS (
  VALUES (0, 0, 4, 'D', NULL), (1, 1, 4, 'D', NULL), (2, 2, 4, 'D', NULL), (3, 3, 4, 'D', NULL),
    (0, 2, 3, 'R', NULL), (1, 2, 3, 'R', NULL), (3, 2, 3, 'R', NULL), (2, 3, 3, 'R', NULL),
    (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'), (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a')
), ways AS (
  SELECT j.conv_id, j.n, i.x, s.y, i.e || s.e AS e, i.c + s.c + CASE WHEN fault = 'truncated' AND s.e <> 'D' THEN 3 ELSE 0 END AS c
  FROM judged j, inserts i, steps s
  WHERE i.y = s.x AND (s.e = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (s.initial IS NULL OR s.initial = left(role, 1))
), reached AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS n, 0 AS x, '00000000' AS best FROM judged
  UNION ALL
  SELECT r.conv_id, r.n + 1, w.y, min(lpad(CAST(CAST(left(r.best, 8) AS INT) + w.c AS VARCHAR), 8, '0') || substr(r.best, 9) || w.e)
  FROM reached r JOIN ways w ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND w.n = r.n + 1 AND w.x = r.x GROUP BY ALL
), sizes AS (
  SELECT conv_id, max(n) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), ended AS (
  SELECT r.conv_id, min(lpad(CAST(CAST(left(r.best, 8) AS INT) + i.c AS VARCHAR), 8, '0') || substr(r.best, 9) || i.e) AS best
  FROM reached r JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND s.n = r.n JOIN inserts i ON i.x = r.x AND i.y IN (0, 3) GROUP BY r.conv_id
), edits AS (
  SELECT conv_id, i, substr(best, 8 + i, 1) AS e, i - length(replace(substr(best, 9, i), 'I', '')) AS n_inserted
  FROM (SELECT *, unnest(range(1, length(best) - 7)) AS i FROM ended)
), put AS (
  SELECT e.conv_id, e.i, e.e, j.role, j.text, row_number() OVER w AS place, first_value(CASE WHEN e.e = 'K' AND left(j.role, 1) = 's' THEN 1 ELSE 0 END) OVER w AS system
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND e.e <> 'I' AND j.n = e.i - e.n_inserted
  WHERE e.e <> 'D' WINDOW w AS (PARTITION BY e.conv_id ORDER BY e.i)
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY i) AS whole
  FROM put GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(CAST(left(best, 8) AS BIGINT), 0) AS cost,
  coalesce(substr(best, 9), '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
""")
def op13_turn_grammar(spark, sf_dir):
    given = _table(spark, sf_dir, "conversations")
    rows = _damaged_turns(given)
    plans = materialize(turn_grammar.plan(rows, given), "plans")
    found = turn_grammar.summaries(rows, plans).withColumnRenamed("conv", "conv_id")
    return plans.join(found, F.col("conv").eqNullSafe(F.col("conv_id"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )
