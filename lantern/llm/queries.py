"""The ten operators as queries over whole tables, and DuckDB SQL for those that SQL expresses."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm import bpe, fm_quality, mixing, pivots, ppm_langid, quality_rules, secret_scan, setjoin, sparse_suffix, warc
from lantern.llm.common import held_out, spread
from lantern.session import shared_dir

KEPT_SCORE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For operators that work on each text: on all cores, also where the table is one row group."""
    return spread(table(spark, sf_dir, "documents"))


def tokenizer(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Path of a public vocabulary and its pattern."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_dir(spark)}/lantern-secrets-{uuid.uuid4().hex}"  # a ledger of this run's own
    return secret_scan.digest(secret_scan.scan_through(table(spark, sf_dir, "documents"), folder))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.join(documents(spark, sf_dir)).drop("set_id")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(documents(spark, sf_dir)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sparse_suffix.repeats(documents(spark, sf_dir))


def op7_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    texts, labels = fm_quality.sample(docs, table(spark, sf_dir, "labels"), ~held_out())
    model = fm_quality.fit(texts, labels) if len(set(labels)) == 2 else None
    scored = fm_quality.score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEPT_SCORE).cast("int").alias("predicted"))


def op8_ppm_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    predicted = ppm_langid.predict(docs, ppm_langid.learn(docs, ~held_out()))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), *tokenizer())


def op10_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_warc": op2_warc,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_fm_quality": op7_fm_quality,
    "op8_ppm_langid": op8_ppm_langid,
    "op9_bpe": op9_bpe,
    "op10_pivot_index": op10_pivot_index,
}


def _spans_sql() -> str:
    """A row (doc_id, ord, kind, s, e) for each kept match, from the pieces between matches."""
    parts = []
    for k, r in enumerate(secret_scan.RULES):
        p = r.pattern.replace("'", "''")
        parts.append(f"""
        SELECT doc_id, {k} AS ord, '{r.kind}' AS kind, g,
               list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS s,
               list_sum(list_transform(p[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS e
        FROM (SELECT doc_id, p, m, unnest(range(1, len(m) + 1)) AS i, unnest(g) AS g FROM (
            SELECT doc_id, string_split_regex(t, '{p}') AS p, regexp_extract_all(t, '{p}', 0) AS m, regexp_extract_all(t, '{p}', {r.group}) AS g FROM d))
        WHERE length(g) >= {r.least}""")
    return " UNION ALL ".join(parts)


OP1_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS ({_spans_sql()}),
joined AS (SELECT doc_id, string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, ord) AS spans,
    count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c, count(*) FILTER (kind = 'hex') AS h FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN joined USING (doc_id)"""

#: Base32 of the SHA-1: five bits at a time of the digest as a string of bits.
OP2_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        array_to_string(list_transform(range(0, 8), lambda k: right(concat('0000000000000000000', bin(CAST(concat('0x', sha1(coalesce(html, ''))[5 * k + 1 : 5 * k + 5]) AS INTEGER))), 20)), '') AS bits
    FROM pages),
q AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k:
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[CAST(1 + list_sum(list_transform(range(0, 5), lambda j: CAST(bits[5 * k + j + 1] AS INTEGER) * CAST(power(2, 4 - j) AS INTEGER))) AS BIGINT)]), '') AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM q)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM r"""

_W = r"[^\x20\x09-\x0D]+"
_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END" for bit, rule in quality_rules.RULES.values())
_STRICT, _BASE = quality_rules.mask(quality_rules.POLICIES["v1"]), quality_rules.mask(quality_rules.POLICIES["base"])
OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS times
    FROM (SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8))),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM win, (SELECT unnest(range(0, 8)) AS j) WHERE times > 1 GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(len(l) AS BIGINT) AS n_lines, CAST(length(t) - length(replace(t, '!', '')) AS BIGINT) AS n_bangs
    FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, CAST({_BITS} AS BIGINT) AS bits FROM m)
SELECT *, (bits & {_BASE}) <> 0 AS base_failed, (bits & {_BASE | _STRICT}) = 0 AS kept FROM b"""

#: Every pair of documents that share a shingle is counted, and links are followed from each document.
OP3_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, 1 + CASE WHEN len(w) >= 5 THEN len(w) - 4 WHEN len(w) > 0 THEN 1 ELSE 0 END)) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * pair.n >= 75 * (a.n + b.n - pair.n)),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.root = l.x),
part AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id),
own AS (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM part LEFT JOIN n USING (doc_id) LEFT JOIN own USING (doc_id)"""

#: Every window of 50 words as text; starts at most 50 words apart are one span.
OP6_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents WHERE text IS NOT NULL),
win AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 50], ' ') AS k FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
twice AS (SELECT k FROM win GROUP BY k HAVING min(doc_id) <> max(doc_id)),
hit AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM win WHERE k IN (SELECT k FROM twice)),
island AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM hit),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM island GROUP BY doc_id, g)
SELECT doc_id, count(*) AS n_spans, CAST(sum(b - a) AS BIGINT) AS n_repeated_words, string_agg(concat(a, ':', b), ',' ORDER BY a) AS spans FROM span GROUP BY doc_id"""

ORACLE_SQL = {"op1_secret_scan": OP1_SQL, "op2_warc": OP2_SQL, "op3_jaccard_join": OP3_SQL, "op4_quality_rules": OP4_SQL, "op6_suffix_dedup": OP6_SQL}
