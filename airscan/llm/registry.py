"""Registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airscan.llm import (
    bpe_counts, chat, compression, decontaminate, fixity, hmm, importance, midstate, mixing, passages, projection, set_join,
    stream_dedup,
)
from airscan.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: CRC-32 in SQL: the table of byte values, and the sum of a text's bytes by it.
CRC_TABLE = """bits(b, i, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE i < 8
), crc AS (SELECT list(c ORDER BY b) AS codes FROM bits WHERE i = 8)"""


def crc_sql(text: str) -> str:
    byte = f"('0x' || substr(hex(encode({text})), 2 * i::BIGINT + 1, 2))::BIGINT"
    return f"""xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(strlen({text})), lambda i: {byte})),
        lambda a, x: xor(a // 256, codes[xor(a, x) % 256 + 1])
    ), 4294967295)"""


def query(sql: str | None = None) -> Callable:
    def register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


@query(r"""
WITH p AS (
    SELECT DISTINCT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
        CASE WHEN page_id IS NULL THEN '' ELSE substr(md5(page_id::VARCHAR), 1, 2) END AS hit FROM pages
), v AS (
    SELECT page_id, url, html AS content, 1 AS replica FROM p WHERE hit NOT IN ('0c', '0d')
    UNION ALL
    SELECT page_id, url, CASE WHEN html <> '' AND hit BETWEEN '00' AND '03' THEN '#' || substr(html, 2)
        WHEN hit BETWEEN '04' AND '07' THEN '#' || html ELSE html END, 2
    FROM p WHERE hit NOT BETWEEN '08' AND '0b'
), r AS (
    SELECT page_id, replica, coalesce((page_id // 4096)::VARCHAR, 'none') AS file,
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
        || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
        || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(content)
        || chr(13) || chr(10) || chr(13) || chr(10) || content || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM v
), o AS (
    SELECT page_id, file, replica, sha256(record) AS digest, strlen(record) AS length,
        sum(strlen(record)) OVER (PARTITION BY replica, file ORDER BY page_id NULLS FIRST, sha256(record)) - strlen(record) AS place
    FROM r
), d AS (
    SELECT *, count(*) OVER (PARTITION BY replica, file, page_id) AS n
    FROM (SELECT *, count(*) OVER (PARTITION BY file, digest) AS held FROM o) WHERE held = 1
)
SELECT coalesce(a.file, b.file) AS file, coalesce(a.page_id, b.page_id) AS page_id,
    CASE WHEN b.file IS NULL THEN 'missing' WHEN a.file IS NULL THEN 'extra' ELSE 'changed' END AS kind,
    a.place::BIGINT AS byte_offset, b.place::BIGINT AS second_offset, a.length::BIGINT AS length,
    b.length::BIGINT AS second_length, a.digest AS first_digest, b.digest AS second_digest
FROM (SELECT * FROM d WHERE replica = 1) a FULL JOIN (SELECT * FROM d WHERE replica = 2) b
    ON a.file = b.file AND a.page_id = b.page_id AND a.n = 1 AND b.n = 1
""")
def op1_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as two WARC replicas: some records of the second have a byte changed or added, some are lost or new."""
    pages = table(spark, sf_dir, "pages")
    html = F.coalesce("html", F.lit(""))
    hit = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 2)
    hit = F.when(F.col("page_id").isNull(), F.lit("")).otherwise(hit)
    damaged = (
        F.when((html != "") & hit.between("00", "03"), F.overlay(html, F.lit("#"), 1, 1))
        .when(hit.between("04", "07"), F.concat(F.lit("#"), html)).otherwise(html)
    )
    first = fixity.manifest(fixity.records(pages.filter(~hit.between("0c", "0d")), html))
    second = fixity.manifest(fixity.records(pages.filter(~hit.between("08", "0b")), damaged))
    return fixity.audit(first, second)


@query()
def op2_sparse_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


@query()
def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = set_join.marked(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


@query(r"""
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
    FROM documents
), r AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w AS place
    FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
""")
def op4_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_dedup.marked(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


@query()
def op5_bpe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.withColumn("expected_tokens", F.col("rate") * F.col("tokens"))


@query(f"""
WITH t AS (
    SELECT *, strlen(role) + strlen(text) AS size
    FROM (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations)
), p AS (
    SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'
), c AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(size) OVER (PARTITION BY conv_id) AS total,
        sum(CASE WHEN role = 'system' THEN size ELSE 0 END) OVER (PARTITION BY conv_id) AS system
    FROM t
), cut AS (
    SELECT conv_id, turn, role, text, system, CASE WHEN total > {chat.LIMIT} THEN before::BIGINT // {chat.LIMIT} ELSE 0 END AS part FROM c
), placed AS (
    SELECT conv_id, turn, role, text, part FROM cut
    UNION ALL
    SELECT a.conv_id, turn, role, text, b.part FROM cut a JOIN (SELECT DISTINCT conv_id, part FROM cut) b
    ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.part < b.part WHERE role = 'system' AND system <= {chat.LIMIT // 4}
), s AS (
    SELECT t.conv_id, perspective, part, turn, role, text, role = perspective AS own,
        CASE WHEN role = perspective THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>'
            ELSE '<|user name=' || replace(replace(role, '<|', '< |'), '|>', '| >') || '|>' END || chr(10) AS head,
        replace(replace(text, '<|', '< |'), '|>', '| >') || '<|end|>' AS body
    FROM placed t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id
), o AS (
    SELECT *, sum(length(head || body) + 1) OVER (
        PARTITION BY conv_id, perspective, part ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING
    ) - length(body) - 1 AS start FROM s
)
SELECT conv_id, perspective, part::BIGINT AS part, count(*) AS n_turns,
    string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS rendered,
    coalesce(string_agg(CASE WHEN own THEN start::BIGINT || ':' || (start + length(body))::BIGINT END, ' ' ORDER BY turn, role, text), '') AS mask_spans
FROM o GROUP BY conv_id, perspective, part
""")
def op8_perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.rendered(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return rows.select(
        "conv_id", "perspective", "part", "n_turns", "rendered", F.array_join(spans, " ").alias("mask_spans")
    )


@query()
def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op10_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.scores(table(spark, sf_dir, "documents"))


def field_sql(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


LEAF_FIELDS = " || ".join(field_sql(f"{name}::VARCHAR") for name in ("doc_id", "source", "lang", "n_chars"))


def folds_sql(name: str, start: str, steps: str) -> str:
    """Recursive folding of rows (row, source, level, place, h, met) along steps (source, level, place, before, after)."""
    return f"""{name}_up(row, source, level, place, h, met) AS (
    {start}
    UNION ALL
    SELECT u.row, u.source, u.level + 1, u.place // 3, sha256(before || h || after), met || before || after
    FROM {name}_up u JOIN {steps} s ON u.source = s.source AND u.level = s.level AND u.place = s.place
), {name} AS (SELECT row, any_value(source) AS source, arg_max(h, level) AS h, arg_max(met, level) AS met FROM {name}_up GROUP BY row)"""


def tree_sql(name: str, leaves: str) -> str:
    """Nodes of three over leaves (source, place, h, n), and the steps from each node to its parent."""
    return f"""{name}(source, level, place, h, n) AS (
    SELECT source, 0, place, h, n FROM {leaves}
    UNION ALL
    SELECT source, level + 1, place // 3, sha256(string_agg(h, '' ORDER BY place)), (n + 2) // 3
    FROM {name} WHERE n > 1 GROUP BY source, level, place // 3, n
), {name}_steps AS (
    SELECT source, level, place, coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h) OVER w, '') AS before,
        coalesce(lead(h) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS after
    FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY source, level, place // 3 ORDER BY place)
)"""


@query(f"""
WITH RECURSIVE {CRC_TABLE}, l AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce('+' || source, '') AS source,
        sha256({LEAF_FIELDS} || {field_sql("text")}) AS h,
        CASE WHEN {crc_sql("doc_id::VARCHAR")} % 2 = 0 THEN sha256({LEAF_FIELDS} || {field_sql("replace(text, chr(10), '')")}) END AS other
    FROM documents, crc
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS place,
        count(*) OVER (PARTITION BY source) AS n FROM l
), {tree_sql("nodes", "leaves")}, subroots AS (
    SELECT 'all' AS source, source AS name, h, row_number() OVER (ORDER BY source) - 1 AS place, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), {tree_sql("tops", "subroots")},
{folds_sql("folded", "SELECT row, source, 0, place, coalesce(other, h), '' FROM leaves", "nodes_steps")}, begun AS (
    SELECT f.row, f.h, f.met, s.place, s.h AS subroot FROM folded f JOIN subroots s ON f.source = s.name
), {folds_sql("whole", "SELECT row, 'all', 0, place, h, met FROM begun", "tops_steps")}
SELECT doc_id, l.h AS leaf, subroot, root, sha256(w.met) AS proof_sha256, w.h AS folded_root, w.h = root AS verified
FROM l JOIN begun b ON l.row = b.row JOIN whole w ON l.row = w.row JOIN (SELECT h AS root FROM tops WHERE n = 1) ON true
""")
def op11_midstate_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' proofs; the half whose identifiers have an even checksum are folded without their line ends."""
    even = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = midstate.folded(midstate.manifest(table(spark, sf_dir, "documents"), tampered))
    verified = F.col("folded_root") == F.col("root")
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", verified.alias("verified"))


ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = rf"regexp_extract_all(translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH RECURSIVE {CRC_TABLE}, d AS (
    SELECT row_number() OVER () AS row, doc_id, {RUNS} AS runs FROM documents
), words AS (SELECT row, unnest(runs) AS word FROM d), wanted AS (SELECT unnest({RUNS}) AS word FROM benchmark),
hashed AS (
    SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM words UNION SELECT word FROM wanted), crc
), s AS (SELECT bucket, count(*) AS s FROM words JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM wanted JOIN hashed USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s)::DOUBLE + 10000)
        / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0)::DOUBLE + 10000))))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)
), weights AS (SELECT row, sum(gain)::BIGINT AS weight FROM words JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row),
scored AS (
    SELECT row, doc_id, len(runs) AS n, coalesce(weight, 0) AS weight,
        ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM d LEFT JOIN weights USING (row)
), keyed AS (
    SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM scored
), ranked AS (
    SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight, n) AS place, count(*) OVER () AS of
    FROM keyed WHERE n >= 20
)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN place <= 10 * of // 100 THEN place END AS rank
FROM keyed LEFT JOIN ranked USING (row)
""")
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query("""
WITH RECURSIVE e AS (
    SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
), able AS (
    SELECT * FROM e WHERE label IS NOT NULL AND list_count(v) = len(v) AND list_bool_and(list_transform(v, lambda x: isfinite(x)))
        AND list_bool_or(list_transform(v, lambda x: x <> 0))
), links AS (
    SELECT a.row, b.row AS other FROM able a JOIN able b ON a.label = b.label AND a.row <> b.row AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(row, other) AS (
    SELECT row, row FROM e UNION SELECT r.row, l.other FROM reach r JOIN links l ON r.other = l.row
), least AS (SELECT r.row, min(vec_id) AS component_id FROM reach r JOIN e ON r.other = e.row GROUP BY r.row)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.row = e.row) AS n_links, component_id,
    vec_id IS NOT DISTINCT FROM component_id AS kept
FROM e JOIN least USING (row)
""")
def op13_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.near_copies(table(spark, sf_dir, "embeddings"))
