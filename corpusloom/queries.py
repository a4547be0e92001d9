"""Queries over the test tables and their SQL counterparts."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import NearDuplicates, Rules
from corpusloom.functions.hashing import sampled, split_of, stable_id, threshold_hex

from corpusloom.functions.labels import jurisdiction_label, language_label, source_label, split_label, type_label
from corpusloom.functions.text import text_bytes
from corpusloom.operators import components, decontam, dedup, normalize, perplexity, rules, sampling, sft, shards, stats
from corpusloom.plans import accept
from corpusloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SEED = 42


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL counterpart where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return put


# Parts of the SQL.
_SPACE = r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORDS = f"len(regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+'))"
_TOKENS = "CAST(floor(CAST({0} AS DOUBLE) * CAST(1.3 AS DOUBLE)) AS BIGINT)"


def sql_string(x: str) -> str:
    """An SQL literal."""
    return "'" + x.replace("'", "''") + "'"


def _compatible() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters whose NFKC form is one other character, those characters, and the longer forms of common blocks."""
    single, several = [], []
    for i in (*range(0xA0, 0xD800), *range(0xF900, 0xFFF0), *range(0x1D400, 0x1D800)):
        to = unicodedata.normalize("NFKC", chr(i))
        if len(to) == 1 and to != chr(i):
            single.append((chr(i), to))
        elif len(to) > 1 and (i < 0x180 or 0x2000 <= i < 0x2190 or 0xFB00 <= i < 0xFB07):
            several.append((chr(i), to))
    return "".join(a for a, _ in single), "".join(b for _, b in single), several


def sql_nfkc(x: str) -> str:
    """SQL of the compatibility form, for the characters that ``_compatible`` lists."""
    a, b, several = _compatible()
    for c, to in several:
        x = f"replace({x}, {sql_string(c)}, {sql_string(to)})"
    return f"nfc_normalize(translate({x}, {sql_string(a)}, {sql_string(b)}))"


def sql_folded(x: str) -> str:
    """SQL of case folding: lower case, and what folds further in the blocks up to Greek and among the ligatures."""
    more = {c: c.casefold() for i in (*range(0x80, 0x400), *range(0xFB00, 0xFB18)) if (c := chr(i)).lower() == c != c.casefold()}
    x = f"lower({x})"
    for c, to in more.items():
        x = f"replace({x}, {sql_string(c)}, {sql_string(to)})"
    return x


def sql_canonical(x: str) -> str:
    """SQL of the canonical text."""
    return f"regexp_replace(regexp_replace({sql_folded(sql_nfkc(x))}, '[{_SPACE}]+', ' ', 'g'), '^ | $', '', 'g')"


_BLANK = r"[\t\x{0b}\x{0c}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_normal(x: str) -> str:
    """SQL of the default normalization for texts without entities and tags."""
    x = f"regexp_replace(coalesce({x}, ''), '\\r\\n?', chr(10), 'g')"
    x = rf"regexp_replace({sql_nfkc(x)}, '[\x{{00}}-\x{{08}}\x{{0b}}-\x{{1f}}\x{{7f}}-\x{{9f}}\p{{Cf}}\p{{Co}}]', '', 'g')"
    x = f"regexp_replace({x}, '{_BLANK}+', ' ', 'g')"
    x = rf"regexp_replace(regexp_replace({x}, ' +\n', chr(10), 'g'), ' +$', '', 'g')"
    x = rf"regexp_replace({x}, '\n(?:[ \t]*\n){{{{3,}}}}', repeat(chr(10), 3), 'g')".replace("{{", "{").replace("}}", "}")
    return rf"regexp_replace({x}, '^(?:{_BLANK}|\n)+|(?:{_BLANK}|\n)+$', '', 'g')"


def sql_collapsed(source: str, key: str, text: str) -> str:
    """SQL table of ``k`` and ``x``, the texts of a source with runs of ten or more of one character shortened to three."""
    return f"""(SELECT k, coalesce(string_agg(ch, '' ORDER BY i) FILTER (n < 10 OR r <= 3), '') AS x FROM (
        SELECT k, ch, i, row_number() OVER (PARTITION BY k, ch, g ORDER BY i) AS r, count(*) OVER (PARTITION BY k, ch, g) AS n FROM (
            SELECT k, ch, i, i - row_number() OVER (PARTITION BY k, ch ORDER BY i) AS g FROM (
                SELECT k, unnest(c) AS ch, generate_subscripts(c, 1) AS i
                FROM (SELECT {key} AS k, CASE WHEN {text} = '' THEN [''] ELSE regexp_extract_all({text}, '(?s).') END AS c FROM {source}))))
        GROUP BY k)"""


def sql_reached(edges: str, nodes: str) -> str:
    """SQL table of ``node`` and ``component``, its least node, from tables with columns u, v and node."""
    return f"""(WITH RECURSIVE e AS (SELECT DISTINCT u, v FROM {edges}), b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
        r(node, reach) AS (SELECT node, node FROM {nodes} UNION SELECT r.node, b.v FROM r JOIN b ON r.reach = b.u)
        SELECT node, min(reach) AS component FROM r GROUP BY node)"""


def sql_shingles(source: str, key: str, text: str) -> str:
    """SQL table of ``k`` and ``g``, the distinct five-word shingles of a source's texts."""
    return f"""(SELECT k, unnest(list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')))) AS g
        FROM (SELECT {key} AS k, regexp_extract_all({sql_folded(text)}, '[\\p{{L}}\\p{{N}}_]+') AS w FROM {source}) WHERE len(w) >= 5)"""


def sql_type(c: str, other: str = "NULL") -> str:
    """SQL of ``type_label``."""
    low = f"lower(trim(coalesce(nullif(trim({c}), ''), nullif(trim({other}), ''))))"
    return f"coalesce(CASE WHEN {low} IN ('case law', 'case-law', 'case_law') THEN 'caselaw' WHEN {low} = 'legal_mc4' THEN 'legal-mc4' ELSE {low} END, 'UNKNOWN')"


def sql_place(c: str) -> str:
    """SQL of ``jurisdiction_label``."""
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in {"us": "US", "eu": "EU", "uk": "UK", "switzerland": "Switzerland", "n/a": "N/A", "na": "N/A"}.items())
    return f"coalesce(CASE lower(trim({c})) {names} ELSE nullif(trim({c}), '') END, 'UNKNOWN')"


def sql_source(c: str) -> str:
    """SQL of ``source_label``."""
    return f"coalesce(replace(lower(nullif(trim({c}), '')), '_', '-'), 'UNKNOWN')"


def sql_language(c: str) -> str:
    """SQL of ``language_label``."""
    return f"coalesce(split_part(replace(lower(nullif(trim({c}), '')), '_', '-'), '-', 1), 'und')"


_SUMS = f"count(*) AS documents, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes, CAST(sum(w) AS BIGINT) AS words, {_TOKENS.format('sum(w)')} AS estimated_tokens"
_DOCS = f"(SELECT *, {_WORDS} AS w, {sql_type('type')} AS t, {sql_place('jurisdiction')} AS j, {sql_source('source')} AS s FROM documents)"
_FIRST = f"""(
    SELECT id, source_file, source_row, {sql_type('type')} AS t, {sql_place('jurisdiction')} AS j, coalesce(estimated_tokens, 0) AS tokens, loaded_at
    FROM accepted QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at) = 1
)"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    labels = {"type": type_label("type"), "jurisdiction": jurisdiction_label("jurisdiction"), "source": source_label("source")}
    return table(spark, d, "documents").withColumns(labels)


def _accepted(spark: SparkSession, d: str) -> DataFrame:
    """Each accepted record once, at its first delivery."""
    rows = table(spark, d, "accepted").select(
        "id", "source_file", "source_row", type_label("type").alias("type"), jurisdiction_label("jurisdiction").alias("jurisdiction"),
        F.coalesce("estimated_tokens", F.lit(0)).alias("tokens"), "loaded_at",
    )
    first = F.min(F.struct("loaded_at", "source_file", "source_row", "type", "jurisdiction", "tokens")).alias("f")
    return rows.groupBy("id").agg(first).select("id", "f.*")


@query("stats_by_group", f"SELECT t AS type, j AS jurisdiction, {_SUMS} FROM {_DOCS} GROUP BY ALL")
def _(spark, d):
    return stats.grouped_stats(_documents(spark, d), ["type", "jurisdiction"])


@query(
    "stats_grouping_sets",
    f"""SELECT t AS type, j AS jurisdiction, s AS source, CAST(CASE WHEN grouping(t) = 1 THEN 0 WHEN grouping(s) = 1 THEN 2 ELSE 3 END AS BIGINT) AS level, {_SUMS}
    FROM {_DOCS} GROUP BY GROUPING SETS ((t, j), (t, j, s), ())""",
)
def _(spark, d):
    return stats.grouping_set_stats(_documents(spark, d), [["type", "jurisdiction"], ["type", "jurisdiction", "source"], []])


@query(
    "rollup_shares",
    f"""WITH p AS (
        SELECT 'type' AS level, t AS value, {_SUMS} FROM {_DOCS} GROUP BY t UNION ALL SELECT 'jurisdiction', j, {_SUMS} FROM {_DOCS} GROUP BY j
    ) SELECT level, value, documents, estimated_tokens, round(estimated_tokens / sum(estimated_tokens) OVER (PARTITION BY level), 9) AS token_share FROM p""",
)
def _(spark, d):
    return stats.rollup_shares(_documents(spark, d), ["type", "jurisdiction"]).withColumn("token_share", F.round("token_share", 9))


_MISSING = ", ".join(f"count(*) FILTER (coalesce({c}, '') = '') AS missing_{c}" for c in ("text", "type", "jurisdiction", "source"))


@query("global_summary", f"SELECT {_SUMS}, {_MISSING} FROM (SELECT *, {_WORDS} AS w FROM legal_raw)")
def _(spark, d):
    return stats.global_summary(table(spark, d, "legal_raw"))


@query("file_totals", f"SELECT source_file, {_SUMS} FROM (SELECT *, {_WORDS} AS w FROM legal_raw) GROUP BY ALL")
def _(spark, d):
    return stats.grouped_stats(table(spark, d, "legal_raw"), ["source_file"])


_KEY = "chr(0) || source_file || chr(0) || source_row"


@query("stable_ids", f"SELECT 'sha256:' || sha256('legal' || {_KEY}) AS id, count(*) AS deliveries FROM legal_raw GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "legal_raw").select(stable_id(F.lit("legal"), "source_file", "source_row").alias("id"))
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("deliveries"))


@query("ratio_sample", f"SELECT source_file, source_row, count(*) AS deliveries FROM legal_raw WHERE substr(sha256('{SEED}' || chr(0) || 'slimpajama' || {_KEY}), 1, 16) < '{threshold_hex(0.1)}' GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "legal_raw").filter(sampled(SEED, "slimpajama", "source_file", "source_row", 0.1))
    return rows.groupBy("source_file", "source_row").agg(F.count(F.lit(1)).alias("deliveries"))


_CHANCES = {("caselaw", "US"): 0.05, ("contracts", "US"): 0.25, ("legislation", "EU"): 0.5, ("legislation", "Switzerland"): 1.0}
_CHANCE_SQL = " OR ".join(
    f"(t = '{k}' AND j = '{p}'" + ("" if threshold_hex(c) is None else f" AND substr(sha256('{SEED}' || chr(0) || 'legal' || {_KEY}), 1, 16) < '{threshold_hex(c)}'") + ")" for (k, p), c in _CHANCES.items()
)


@query("bernoulli_by_stratum", f"SELECT source_file, source_row, t AS type, j AS jurisdiction FROM (SELECT DISTINCT source_file, source_row, {sql_type('type', 'text_type')} AS t, {sql_place('jurisdiction')} AS j FROM legal_raw) WHERE {_CHANCE_SQL}")
def _(spark, d):
    rows = table(spark, d, "legal_raw").select("source_file", "source_row", type_label("type", "text_type").alias("type"), jurisdiction_label("jurisdiction").alias("jurisdiction")).distinct()
    return sampling.bernoulli_by_stratum(rows, _CHANCES, SEED, "legal")


@query(
    "shuffle_order",
    f"""SELECT id, priority, bucket, sha256('{SEED}' || chr(0) || 'bucket' || chr(0) || bucket) AS bucket_key FROM (
        SELECT *, CAST(('0x' || substr(priority, 15, 2))::INTEGER % 128 AS BIGINT) AS bucket FROM (SELECT id, sha256('{SEED}' || chr(0) || id) AS priority FROM {_FIRST}))""",
)
def _(spark, d):
    return sampling.shuffled(_accepted(spark, d).select("id"), SEED)


_MARK_SPACE = r"[\x{09}-\x{0d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_MARKER = (
    rf"(?i){_MARK_SPACE}*(?:page{_MARK_SPACE}+\p{{Nd}}{{1,6}}(?:{_MARK_SPACE}+(?:of|/){_MARK_SPACE}*\p{{Nd}}{{1,6}})?|\p{{Nd}}{{1,6}}{_MARK_SPACE}+(?:of|/){_MARK_SPACE}*\p{{Nd}}{{1,6}}"
    rf"|lines?{_MARK_SPACE}+\p{{Nd}}{{1,7}}(?:{_MARK_SPACE}*[-–]{_MARK_SPACE}*\p{{Nd}}{{1,7}})?){_MARK_SPACE}*"
)
_UNMARKED = f"array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_full_match(x, '{_MARKER}')), chr(10))"


@query("page_marker_removal", f"SELECT doc_id, sha256(c) AS cleaned, c <> text AS changed FROM (SELECT doc_id, text, {_UNMARKED} AS c FROM documents)")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text", rules.without_markers(F.col("text")).alias("c"))
    return rows.select("doc_id", F.sha2("c", 256).alias("cleaned"), (F.col("c") != F.col("text")).alias("changed"))


@query("run_collapse", f"SELECT k AS doc_id, x AS text FROM {sql_collapsed('documents', 'doc_id', 'text')}")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", rules.without_runs(F.col("text")).alias("text"))


_METRICS = f"""
    SELECT doc_id, type, length(c) AS chars, len(w) AS words,
        CASE WHEN length(regexp_replace(c, '[{_SPACE}]', '', 'g')) > 0 THEN length(regexp_replace(c, '[^\\p{{L}}]', '', 'g')) / length(regexp_replace(c, '[{_SPACE}]', '', 'g')) ELSE 0 END AS alphabetic,
        (length(c) - length(replace(c, chr(65533), ''))) / greatest(length(c), 1) AS replacement,
        CASE WHEN len(l) > 0 THEN (len(l) - list_unique(l)) / len(l) ELSE 0 END AS lines,
        CASE WHEN len(w) >= 10 THEN (len(w) - 9 - list_unique(list_transform(range(1, len(w) - 8), lambda i: array_to_string(list_slice(w, i, i + 9), ' ')))) / (len(w) - 9) ELSE 0 END AS grams
    FROM (
        SELECT doc_id, type, c, list_transform(regexp_extract_all(c, '[\\p{{L}}\\p{{N}}_]+'), lambda x: lower(x)) AS w,
            list_filter(list_transform(string_split(c, chr(10)), lambda x: trim(lower(regexp_replace(x, '[{_SPACE}]+', ' ', 'g')))), lambda x: length(x) >= 20) AS l
        FROM (SELECT doc_id, {sql_type('type')} AS type, regexp_replace(x, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS c
            FROM documents JOIN {sql_collapsed('documents', 'doc_id', _UNMARKED)} ON k = doc_id)
    )"""
_REASONS = f"""
    SELECT doc_id, type, list_filter([
        CASE WHEN chars < 200 THEN 'too_few_characters' END, CASE WHEN words < 30 THEN 'too_few_words' END, CASE WHEN alphabetic < 0.2 THEN 'low_alphabetic_ratio' END,
        CASE WHEN replacement > 0.01 THEN 'high_replacement_character_ratio' END, CASE WHEN lines > 0.6 THEN 'high_repeated_line_ratio' END,
        CASE WHEN grams > 0.5 THEN 'high_repeated_10gram_ratio' END], lambda x: x IS NOT NULL) AS reasons
    FROM ({_METRICS})"""


def _ruled(spark: SparkSession, d: str) -> DataFrame:
    return rules.apply_rules(_documents(spark, d).select("doc_id", "type", "text"), Rules())


@query("rule_metrics", f"SELECT doc_id, chars AS characters, words, round(alphabetic, 6) AS alphabetic_ratio, round(replacement, 6) AS replacement_ratio, round(lines, 6) AS repeated_line_ratio, round(grams, 6) AS repeated_ngram_ratio FROM ({_METRICS})")
def _(spark, d):
    m = F.col("rules.metrics")
    return _ruled(spark, d).select(
        "doc_id", m.character_count.cast("long").alias("characters"), m.word_count.cast("long").alias("words"), F.round(m.alphabetic_ratio, 6).alias("alphabetic_ratio"),
        F.round(m.replacement_character_ratio, 6).alias("replacement_ratio"), F.round(m.repeated_line_ratio, 6).alias("repeated_line_ratio"), F.round(m.repeated_ngram_ratio, 6).alias("repeated_ngram_ratio"),
    )


@query("rule_reasons", f"SELECT doc_id, array_to_string(reasons, ',') AS reasons, len(reasons) = 0 AS accepted FROM ({_REASONS})")
def _(spark, d):
    return _ruled(spark, d).select("doc_id", F.array_join("rules.reasons", ",").alias("reasons"), "rules.accepted")


@query("rejections_by_reason", f"SELECT type, reason, count(*) AS rejected_rows FROM (SELECT type, unnest(reasons) AS reason FROM ({_REASONS})) GROUP BY ALL")
def _(spark, d):
    return rules.rejections_by_reason(_ruled(spark, d), ["type"])


@query("rejection_rates", f"SELECT type, count(*) AS rows, count(*) FILTER (len(reasons) > 0) AS rejected_rows, round(count(*) FILTER (len(reasons) > 0) / count(*), 9) AS rejection_rate, count(*) FILTER (len(reasons) > 0) / count(*) > 0.1 AS alarm FROM ({_REASONS}) GROUP BY ALL")
def _(spark, d):
    return rules.rejection_rates(_ruled(spark, d), ["type"]).drop("flagged_rows").withColumn("rejection_rate", F.round("rejection_rate", 9))


@query("normalize_documents", f"SELECT doc_id, {sql_normal('text')} AS text FROM documents")
def _(spark, d):
    return normalize.normalize(table(spark, d, "documents").select("doc_id", "text"))


@query("exact_dedup", f"SELECT min(doc_id) AS doc_id, h AS text_hash FROM (SELECT doc_id, sha256({sql_canonical('text')}) AS h FROM documents) GROUP BY h")
def _(spark, d):
    return dedup.first_copies(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"]).select("doc_id", "text_hash")


# Exact copies, then all pairs of first copies by the shingles they share, with exact similarity.
_ALIKE = f"""WITH h AS (SELECT doc_id, text, min(doc_id) OVER (PARTITION BY sha256({sql_canonical('text')})) AS first FROM documents),
    s AS (SELECT * FROM {sql_shingles('(SELECT * FROM h WHERE doc_id = first)', 'doc_id', 'text')}), n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
    p AS (SELECT a.k AS u, b.k AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k > b.k GROUP BY ALL),
    e AS (SELECT u, v FROM p JOIN n a ON a.k = u JOIN n b ON b.k = v WHERE c / (a.n + b.n - c) >= 0.8 UNION SELECT doc_id, first FROM h WHERE doc_id <> first),
    d AS (SELECT node AS doc_id, component AS representative FROM {sql_reached('e', '(SELECT doc_id AS node FROM h)')}),
    l AS (SELECT d.*, CASE WHEN doc_id = representative THEN 'kept' WHEN first = representative THEN 'exact' ELSE 'near' END AS kind, 'sha256:' || sha256(CAST(representative AS VARCHAR)) AS dedup_cluster_id FROM d JOIN h USING (doc_id))"""


@query("near_dedup", f"{_ALIKE} SELECT * FROM l")
def _(spark, d):
    return dedup.deduplicate(table(spark, d, "documents").select("doc_id", "text"), NearDuplicates()).drop("text")


@query(
    "near_dedup_audit",
    f"""{_ALIKE}, t AS (SELECT * FROM {sql_shingles('documents', 'doc_id', 'text')}), m AS (SELECT k, count(*) AS n FROM t GROUP BY k)
    SELECT l.doc_id AS duplicate, representative, kind, CASE WHEN kind = 'exact' THEN 1.0 ELSE c / (a.n + b.n - c) END::DOUBLE AS similarity, dedup_cluster_id AS cluster_id
    FROM l LEFT JOIN m a ON a.k = doc_id LEFT JOIN m b ON b.k = representative
        LEFT JOIN (SELECT x.k AS u, y.k AS v, count(*) AS c FROM t x JOIN l ON l.doc_id = x.k JOIN t y ON y.k = representative AND y.g = x.g GROUP BY ALL) ON u = doc_id AND v = representative
    WHERE kind <> 'kept'""",
)
def _(spark, d):
    return dedup.match_audit(dedup.deduplicate(table(spark, d, "documents").select("doc_id", "text"), NearDuplicates()))


@query(
    "components",
    """WITH RECURSIVE e AS (
        SELECT DISTINCT 'g:' || policy_group AS u, 'p:' || policy_uid AS v FROM sft_records WHERE policy_group IS NOT NULL AND policy_uid IS NOT NULL
    ), b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e), r(node, reach) AS (SELECT u, u FROM b UNION SELECT r.node, b.v FROM r JOIN b ON r.reach = b.u)
    SELECT node, min(reach) AS component FROM r GROUP BY node""",
)
def _(spark, d):
    edges = table(spark, d, "sft_records").select(F.concat(F.lit("g:"), "policy_group").alias("u"), F.concat(F.lit("p:"), "policy_uid").alias("v"))
    return components.connected_components(edges)


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    """Each record of legal_raw at its first delivery, with its scan order."""
    rows = table(spark, d, "legal_raw").select(
        "source_file", "source_row", type_label("type", "text_type").alias("type"), jurisdiction_label("jurisdiction").alias("jurisdiction"), source_label("source").alias("source"), "text", "loaded_at"
    )
    first = F.min_by(F.struct("type", "jurisdiction", "source", "text"), F.struct("loaded_at", "text")).alias("f")
    scan = F.struct(F.lit(0).alias("corpus_rank"), F.col("source_file").alias("major"), F.col("source_row").alias("minor"))
    return rows.groupBy("source_file", "source_row").agg(first).select(F.lit("legal").alias("corpus"), "source_file", "source_row", "f.*", scan.alias("ordinal"))


# The accept path over legal_raw: first deliveries, normalized, judged by the rules, the first of equal canonical texts kept.
_CLEAN = f"""WITH f AS (
        SELECT source_file, source_row, {sql_type('type', 'text_type')} AS type, {sql_place('jurisdiction')} AS jurisdiction, {sql_source('source')} AS source, {sql_normal('text')} AS text
        FROM legal_raw QUALIFY row_number() OVER (PARTITION BY source_file, source_row ORDER BY loaded_at, text NULLS FIRST) = 1),
    k AS (SELECT *, source_file || chr(0) || source_row AS doc_id FROM f),
    r AS ({_REASONS.replace(sql_type('type') + ' AS type', 'type').replace('documents', 'k')}),
    c AS (SELECT k.* REPLACE (regexp_replace(x, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS text), r.reasons, sha256('legal' || chr(0) || k.doc_id) AS h
        FROM k JOIN r ON r.doc_id = k.doc_id JOIN {sql_collapsed('k', 'doc_id', _UNMARKED)} y ON y.k = k.doc_id),
    a AS (SELECT *, len(reasons) = 0 AND row_number() OVER (PARTITION BY len(reasons) = 0, {sql_canonical('text')} ORDER BY source_file, source_row) > 1 AS copy FROM c),
    s AS (SELECT *, CASE WHEN len(reasons) > 0 THEN 'rules' WHEN copy THEN 'exact_deduplication' END AS stage, CASE WHEN copy THEN ['exact_duplicate'] ELSE reasons END AS why, {_TOKENS.format(_WORDS)} AS tokens FROM a)"""


@query("accepted_records", f"{_CLEAN} SELECT 'sha256:' || h AS id, text, 'legal' AS corpus, type, jurisdiction, source, source_file, source_row, tokens AS estimated_tokens, CAST(NULL AS DOUBLE) AS perplexity FROM s WHERE stage IS NULL")
def _(spark, d):
    return accept.accepted(accept.without_exact_copies(accept.prepared(_candidates(spark, d))))


@query("rejected_records", f"{_CLEAN} SELECT 'legal' AS corpus, source_file, source_row, stage, why AS reasons FROM s WHERE stage IS NOT NULL")
def _(spark, d):
    return accept.rejected(accept.without_exact_copies(accept.prepared(_candidates(spark, d))))


@query(
    "accept_counters",
    f"""{_CLEAN} SELECT 'legal' AS corpus, type, count(*) AS input_rows, count(*) FILTER (stage IS NULL) AS accepted_rows, CAST(coalesce(sum(tokens) FILTER (stage IS NULL), 0) AS BIGINT) AS accepted_tokens,
        count(*) FILTER (stage = 'rules') AS rule_rejections, count(*) FILTER (stage = 'perplexity') AS perplexity_rejections, count(*) FILTER (stage = 'exact_deduplication') AS exact_duplicates
    FROM s GROUP BY type""",
)
def _(spark, d):
    return accept.stage_counters(accept.without_exact_copies(accept.prepared(_candidates(spark, d))), ("corpus", "type"))


@query("rejection_audit", f"{_CLEAN} SELECT 'legal' AS corpus, stage, reason, count(*) AS rejected_rows FROM (SELECT stage, unnest(why) AS reason FROM s WHERE stage IS NOT NULL) GROUP BY ALL")
def _(spark, d):
    return accept.rejection_counts(accept.without_exact_copies(accept.prepared(_candidates(spark, d))))


@query("perplexity_filter")
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "text")
    lines = spark.sparkContext.broadcast(perplexity.estimated_arpa(rows))
    scored = perplexity.with_perplexity(rows, lambda: perplexity.ArpaModel(lines=lines.value), f"pairs of {d}")
    return scored.select("doc_id", "scored.accepted", F.round("scored.perplexity", 3).alias("perplexity"), "scored.token_count", "scored.reason")


_BEFORE = "coalesce(sum(tokens) OVER ({0} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
_PREFIX = _BEFORE.format("ORDER BY source_file, source_row")


@query("budget_prefix", f"SELECT id, tokens FROM (SELECT id, tokens, {_PREFIX} AS b FROM {_FIRST}) WHERE b < 5000")
def _(spark, d):
    return sampling.budget_prefix(_accepted(spark, d), ["source_file", "source_row"], "tokens", 5000).select("id", "tokens")


@query(
    "largest_remainder",
    """WITH w AS (SELECT type, jurisdiction, CAST(round(target_share * 1000) AS BIGINT) AS n FROM sampling_targets),
    f AS (SELECT *, 4500001 * n / CAST((SELECT sum(n) FROM w) AS DOUBLE) AS x FROM w),
    r AS (SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, type DESC, jurisdiction DESC) AS k, 4500001 - sum(floor(x)) OVER () AS spare FROM f)
    SELECT type, jurisdiction, CAST(floor(x) AS BIGINT) + CAST(k <= spare AS BIGINT) AS quota FROM r""",
)
def _(spark, d):
    rows = table(spark, d, "sampling_targets").collect()
    quotas = sampling.largest_remainder(4_500_001, {(r.type, r.jurisdiction): round(r.target_share * 1000) for r in rows})
    return spark.createDataFrame([(*k, q) for k, q in quotas.items()], "type string, jurisdiction string, quota long")


_SEEDED = f"sha256('{SEED}' || chr(0) || id)"
_QUOTAS = f"(SELECT t, j, CAST(sum(tokens) // 5 AS BIGINT) AS quota FROM {_FIRST} GROUP BY ALL)"
_CHOSEN = f"(SELECT * FROM (SELECT a.*, q.quota, {_BEFORE.format(f'PARTITION BY a.t, a.j ORDER BY {_SEEDED}')} AS b FROM {_FIRST} a JOIN {_QUOTAS} q USING (t, j)) WHERE b < quota)"


def _quotas(rows: DataFrame) -> DataFrame:
    return rows.groupBy("type", "jurisdiction").agg(F.floor(F.sum("tokens") / 5).alias("quota"))


@query("quota_selection", f"SELECT id, t AS type, j AS jurisdiction, tokens, CAST(b AS BIGINT) AS tokens_before FROM {_CHOSEN}")
def _(spark, d):
    rows = _accepted(spark, d)
    return sampling.select_by_quota(rows, _quotas(rows), ["type", "jurisdiction"], "tokens", SEED).select("id", "type", "jurisdiction", "tokens", "tokens_before")


@query(
    "quota_report",
    f"""SELECT q.t AS type, q.j AS jurisdiction, q.quota, coalesce(n, 0) AS selected_documents, CAST(coalesce(s, 0) AS BIGINT) AS selected_tokens, CAST(coalesce(s, 0) - q.quota AS BIGINT) AS difference
    FROM {_QUOTAS} q LEFT JOIN (SELECT t, j, count(*) AS n, sum(tokens) AS s FROM {_CHOSEN} GROUP BY ALL) c USING (t, j)""",
)
def _(spark, d):
    rows = _accepted(spark, d)
    chosen = sampling.select_by_quota(rows, _quotas(rows), ["type", "jurisdiction"], "tokens", SEED)
    return sampling.quota_report(_quotas(rows), chosen, ["type", "jurisdiction"], "tokens")


@query(
    "nested_releases",
    f"""SELECT id, CASE WHEN b < 2000 THEN 'small' WHEN b < 5000 THEN 'medium' ELSE 'large' END AS release
    FROM (SELECT id, {_BEFORE.format(f'ORDER BY {_SEEDED}')} AS b FROM {_FIRST}) WHERE b < 10000""",
)
def _(spark, d):
    return sampling.nested_releases(_accepted(spark, d), {"small": 2000, "medium": 5000, "large": 10_000}, "tokens", SEED).select("id", "release")


_SHARDS = f"""WITH RECURSIVE o AS (SELECT id, tokens, row_number() OVER (ORDER BY {_SEEDED}, id) AS n FROM {_FIRST}),
    f(n, id, tokens, shard, held) AS (
        SELECT n, id, tokens, CAST(0 AS BIGINT), CAST(tokens AS BIGINT) FROM o WHERE n = 1
        UNION ALL
        SELECT o.n, o.id, o.tokens, CASE WHEN f.held > 0 AND f.held + o.tokens > 20000 THEN f.shard + 1 ELSE f.shard END,
            CASE WHEN f.held > 0 AND f.held + o.tokens > 20000 THEN CAST(o.tokens AS BIGINT) ELSE f.held + o.tokens END
        FROM f JOIN o ON o.n = f.n + 1)"""


def _sharded(spark: SparkSession, d: str) -> DataFrame:
    return shards.assign_shards(sampling.shuffled(_accepted(spark, d), SEED), ["priority", "id"], "tokens", 20_000)


@query("shard_assignment", f"{_SHARDS} SELECT id, shard FROM f")
def _(spark, d):
    return _sharded(spark, d).select("id", "shard")


@query("shard_stats", f"{_SHARDS} SELECT shard, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens FROM f GROUP BY ALL")
def _(spark, d):
    return shards.shard_statistics(_sharded(spark, d), "tokens")


@query(
    "packed_sequences",
    f"""WITH o AS (SELECT id, tokens, {_BEFORE.format(f'ORDER BY {_SEEDED}, id').replace('sum(tokens)', 'sum(tokens + 1)')} AS b FROM {_FIRST}),
    s AS (SELECT id, tokens, b, unnest(range(CAST(b // 2048 AS BIGINT), CAST((b + tokens) // 2048 AS BIGINT) + 1)) AS sequence FROM o)
    SELECT id, sequence, CAST(greatest(sequence * 2048 - b, 0) AS BIGINT) AS first_token, CAST(least((sequence + 1) * 2048, b + tokens + 1) - greatest(sequence * 2048, b) AS BIGINT) AS tokens FROM s""",
)
def _(spark, d):
    return shards.packed_sequences(sampling.shuffled(_accepted(spark, d), SEED), ["priority", "id"], "tokens", 2048).select("id", "sequence", "first_token", "tokens")


@query("temperature_weights", f"SELECT l AS lang, n AS size, round(pow(n, 0.5) / sum(pow(n, 0.5)) OVER (), 9) AS weight FROM (SELECT {sql_language('lang')} AS l, count(*) AS n FROM documents GROUP BY ALL)")
def _(spark, d):
    rows = table(spark, d, "documents").select(language_label("lang").alias("lang"))
    return sampling.temperature_weights(rows, ["lang"], 0.5).withColumn("weight", F.round("weight", 9))


@query(
    "capped_shares",
    f"""SELECT type, jurisdiction, n AS size, round(n / sum(n) OVER (PARTITION BY type), 9) AS share, CAST(least(n, floor(sum(n) OVER (PARTITION BY type) * CAST(0.5 AS DOUBLE))) AS BIGINT) AS kept_size
    FROM (SELECT t AS type, j AS jurisdiction, CAST(sum(length(text)) AS BIGINT) AS n FROM {_DOCS} GROUP BY ALL)""",
)
def _(spark, d):
    rows = _documents(spark, d).select("type", "jurisdiction", F.length("text").cast("long").alias("n"))
    return sampling.capped_shares(rows, "type", "jurisdiction", "n").withColumn("share", F.round("share", 9))


@query("ngram_counts", r"""WITH t AS (
        SELECT list_concat(['<s>'], list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0b\f\r]+'), lambda x: x <> ''), ['</s>']) AS w FROM documents)
    SELECT n AS size, g AS ngram, count(*) AS occurrences FROM (
        SELECT n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(list_slice(w, i, i + n - 1), ' '))) AS g FROM t, (SELECT unnest([1, 2, 3, 4, 5]) AS n) WHERE len(w) >= n)
    GROUP BY ALL HAVING n < 3 OR count(*) > 1""")
def _(spark, d):
    rows = table(spark, d, "documents")
    parts = [perplexity.ngram_counts(rows, n, least=1 if n < 3 else 2).select(F.lit(n).alias("size"), "ngram", "occurrences") for n in range(1, 6)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


@query("hash_split", f"SELECT policy_group, CASE WHEN p < 9900 THEN 'train' WHEN p < 9950 THEN 'validation' ELSE 'test' END AS split FROM (SELECT DISTINCT policy_group, ('0x' || substr(sha256(policy_group || '{SEED}'), 1, 16))::UBIGINT % 10000 AS p FROM sft_records WHERE policy_group IS NOT NULL)")
def _(spark, d):
    groups = table(spark, d, "sft_records").filter("policy_group IS NOT NULL").select("policy_group").distinct()
    return groups.select("policy_group", split_of(SEED, "policy_group", {"train": 9900, "validation": 50, "test": 50}).alias("split"))


_SPLIT = "CASE WHEN lower(trim(split)) IN ('val', 'valid', 'dev') THEN 'validation' ELSE nullif(lower(trim(split)), '') END"


@query("groups_apart", f"SELECT policy_group, count(DISTINCT {_SPLIT}) AS splits FROM sft_records WHERE policy_group IS NOT NULL GROUP BY ALL HAVING count(DISTINCT {_SPLIT}) > 1")
def _(spark, d):
    rows = table(spark, d, "sft_records").filter("policy_group IS NOT NULL").select("policy_group", split_label("split").alias("split"))
    return sft.groups_apart(rows, "policy_group")


_ESCAPED = "replace(replace(replace(replace({0}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't')"
_TURN = "'{\"content\": \"' || " + _ESCAPED.format("m.content") + " || '\", \"role\": \"' || m.role || '\"}'"
_PAIR = f"sha256('[' || array_to_string(list_transform(messages, lambda m: {_TURN}), ', ') || ']')"


@query(
    "sft_pairs",
    f"""SELECT direction, min(id) AS record_id, {_PAIR} AS id, list_sort(list_distinct(flatten(list(list_transform(provenance, lambda p: p.file || '#' || p.row || '#' || p.split))))) AS places
    FROM sft_records GROUP BY direction, messages""",
)
def _(spark, d):
    rows = table(spark, d, "sft_records").select("direction", "messages", "provenance", F.col("id").alias("record_id"))
    places = F.sort_array(F.transform("provenance", lambda p: F.concat_ws("#", p.file, p.row.cast("string"), p.split)))
    return sft.deduplicated_pairs(rows, ["record_id"]).select("direction", "record_id", "id", places.alias("places"))


@query(
    "generation_references",
    f"""SELECT direction, split, min(id) AS id, sha256(p) AS prompt_hash, list(a ORDER BY first) AS answers FROM (
        SELECT direction, split, p, a, min(id) AS first, min(id) AS id FROM (SELECT direction, {_SPLIT} AS split, id, messages[1].content AS p, messages[2].content AS a FROM sft_records)
        WHERE split IN ('validation', 'test') GROUP BY direction, split, p, a)
    GROUP BY direction, split, p""",
)
def _(spark, d):
    rows = table(spark, d, "sft_records").select("id", "direction", split_label("split").alias("split"), F.col("policy_group").alias("group_id"), "messages", F.col("id").alias("place"))
    seen = sft.generation_view(rows, "place")
    return seen.select("direction", "split", "id", F.sha2(sft.prompt_text(), 256).alias("prompt_hash"), F.col("references").alias("answers"))


_PROMPT = "list_filter(messages, lambda m: m.role = 'user')[1].content"
_TIED = f"""(SELECT policy_group AS u, min(policy_group) OVER (PARTITION BY direction, p) AS v FROM (
    SELECT policy_group, direction, {sql_canonical(_PROMPT)} AS p FROM sft_records WHERE policy_group IS NOT NULL) WHERE p IS NOT NULL)"""
_GROUPS = sql_reached(_TIED, "(SELECT DISTINCT policy_group AS node FROM sft_records WHERE policy_group IS NOT NULL)")


@query("prompt_groups", f"SELECT node, component FROM {_GROUPS}")
def _(spark, d):
    return sft.group_of_prompts(table(spark, d, "sft_records"))


@query(
    "group_splits",
    f"""WITH g AS (SELECT DISTINCT component AS group_id FROM {_GROUPS}), n AS (SELECT count(*) AS n FROM g), r AS (SELECT group_id, row_number() OVER (ORDER BY sha256('{SEED}:' || group_id), group_id) - 1 AS k FROM g)
    SELECT group_id, CASE WHEN k < round_even(n * 0.1, 0) THEN 'validation' WHEN k < 2 * round_even(n * 0.1, 0) THEN 'test' ELSE 'train' END AS split FROM r, n""",
)
def _(spark, d):
    return sft.assign_group_splits(sft.group_of_prompts(table(spark, d, "sft_records")), SEED, 0.1, 0.1)


@query(
    "conflicting_prompts",
    f"""SELECT p AS prompt_hash, count(*) AS rows, count(DISTINCT a) AS answers FROM (
        SELECT sha256({sql_canonical(_PROMPT)}) AS p, sha256({sql_canonical("list_filter(messages, lambda m: m.role = 'assistant')[1].content")}) AS a FROM sft_records)
    GROUP BY p HAVING count(DISTINCT a) > 1""",
)
def _(spark, d):
    return sft.conflicting_prompts(table(spark, d, "sft_records"))


@query("valid_conversations", "SELECT DISTINCT id, len(messages) > 0 AND messages[-1].role = 'assistant' AND len(list_filter(messages, lambda m: m.role = 'user')) > 0 AND len(list_filter(messages, lambda m: trim(coalesce(m.content, '')) = '')) = 0 AS valid FROM sft_records")
def _(spark, d):
    return table(spark, d, "sft_records").select("id", sft.valid_conversation("messages").alias("valid")).distinct()


@query("pair_order", f"SELECT DISTINCT id, sha256('{SEED}:' || id) AS order_hash FROM sft_records")
def _(spark, d):
    return sft.ordered_pairs(table(spark, d, "sft_records").select("id").distinct(), SEED)


@query("joint_view", f"SELECT DISTINCT id, {_SPLIT} AS split, sha256('{SEED}:joint:' || id) AS order_hash FROM sft_records WHERE {_SPLIT} IN ('train', 'validation')")
def _(spark, d):
    rows = table(spark, d, "sft_records").select("id", split_label("split").alias("split")).distinct()
    return sft.joint_view(rows, SEED)


@query(
    "pool_sample",
    f"""WITH g AS (SELECT t AS pool, j AS subset, count(*) AS n FROM {_FIRST} WHERE t IN ('caselaw', 'contracts') GROUP BY ALL),
    x AS (SELECT *, 60 * n / CAST(sum(n) OVER (PARTITION BY pool) AS DOUBLE) AS x FROM g),
    q AS (SELECT pool, subset, floor(x) + CAST(row_number() OVER (PARTITION BY pool ORDER BY x - floor(x) DESC, subset DESC) <= 60 - sum(floor(x)) OVER (PARTITION BY pool) AS INT) AS quota FROM x),
    r AS (SELECT id, t AS pool, j AS subset, row_number() OVER (PARTITION BY t, j ORDER BY {_SEEDED}, id) AS k FROM {_FIRST})
    SELECT id, pool, subset FROM r JOIN q USING (pool, subset) WHERE k <= quota""",
)
def _(spark, d):
    rows = _accepted(spark, d).select("id", F.col("type").alias("pool"), F.col("jurisdiction").alias("subset")).filter(F.col("pool").isin("caselaw", "contracts"))
    return sft.pool_sample(rows, 120, ["subset"], {"caselaw": 0.5, "contracts": 0.5}, seed=SEED)


@query(
    "multiple_choice",
    "SELECT id, 'Which group?' || chr(10) || array_to_string(list_transform(range(1, len(c) + 1), lambda i: chr(CAST(64 + i AS INT)) || '. ' || c[i]), chr(10)) || chr(10) || 'Answer:' AS prompt FROM (SELECT DISTINCT id, [direction, policy_uid, policy_group] AS c FROM sft_records WHERE policy_uid IS NOT NULL AND policy_group IS NOT NULL)",
)
def _(spark, d):
    rows = table(spark, d, "sft_records").filter("policy_uid IS NOT NULL AND policy_group IS NOT NULL").select("id", F.array("direction", "policy_uid", "policy_group").alias("c")).distinct()
    return rows.select("id", sft.multiple_choice_prompt(F.lit("Which group?"), "c").alias("prompt"))


@query(
    "preferred_copies",
    f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256({sql_canonical('text')}) ORDER BY -length(text), doc_id) AS k FROM documents) WHERE k = 1""",
)
def _(spark, d):
    rows = table(spark, d, "documents").select("doc_id", dedup.text_hash(spark, F.col("text")).alias("cluster"), (-F.length("text")).alias("shorter"))
    return dedup.preferred_copies(rows, "cluster", ["shorter"], "doc_id").select("doc_id")


@query("file_inventory", "SELECT source_file, count(*) AS rows, count(*) FILTER (text IS NULL) AS empty_rows, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS bytes FROM legal_raw GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "legal_raw")
    return rows.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("text").isNull()).alias("empty_rows"), F.coalesce(F.sum(text_bytes("text")), F.lit(0)).alias("bytes"))


@query(
    "evaluation_averages",
    f"""WITH r AS (SELECT {sql_source('source')} AS task, {sql_type('type')} AS label, CASE WHEN length(text) > 1500 THEN 'caselaw' ELSE 'contracts' END AS predicted FROM documents),
    c AS (SELECT task, label, count(*) AS n, sum((label = predicted)::INT) AS h FROM r GROUP BY ALL),
    t AS (SELECT task, sum(n) AS n, sum(h) AS h, avg(h / n) AS balanced FROM c GROUP BY ALL)
    SELECT round(sum(h) / sum(n), 9) AS micro_accuracy, round(avg(h / n), 9) AS macro_accuracy, round(avg(balanced), 9) AS macro_balanced_accuracy FROM t""",
)
def _(spark, d):
    rows = _documents(spark, d).select("source", "type", F.when(F.length("text") > 1500, "caselaw").otherwise("contracts").alias("predicted"))
    got = sft.evaluation_averages(rows, "source", "type", "predicted")
    return got.select(*[F.round(c, 9).alias(c) for c in got.columns])


_BARE = r"regexp_replace({0}, '[^\p{{L}}\p{{N}}]+', '', 'g')"
_TRAIN = "(SELECT source_file || '#' || source_row AS id, text FROM legal_raw WHERE text IS NOT NULL)"


@query(
    "contamination",
    f"""WITH t AS (SELECT DISTINCT id, text, {sql_canonical('text')} AS c FROM {_TRAIN}), v AS (SELECT id AS e, text, {sql_canonical('text')} AS c FROM accepted),
    a AS (SELECT c, min(e) AS e FROM v GROUP BY c), b AS (SELECT {_BARE.format('c')} AS c, min(e) AS e FROM v GROUP BY ALL),
    x AS (SELECT * FROM {sql_shingles('(SELECT DISTINCT id, text FROM t)', "id || chr(0) || sha256(text)", 'text')}),
    y AS (SELECT * FROM {sql_shingles('(SELECT DISTINCT e, text FROM v)', "e || chr(0) || sha256(text)", 'text')}),
    n AS (SELECT k, count(*) AS n FROM x GROUP BY k), m AS (SELECT k, count(*) AS n FROM y GROUP BY k),
    p AS (SELECT x.k AS u, y.k AS v, count(*) AS c FROM x JOIN y USING (g) GROUP BY ALL),
    f AS (
        SELECT id, e, 0 AS rank, 1.0::DOUBLE AS similarity, 'exact' AS kind FROM t JOIN a USING (c) WHERE {_BARE.format('c')} <> ''
        UNION ALL SELECT id, e, 1, 1.0, 'punctuation' FROM t JOIN b ON b.c = {_BARE.format('t.c')} WHERE b.c <> ''
        UNION ALL SELECT split_part(u, chr(0), 1), split_part(v, chr(0), 1), 2, c / (n.n + m.n - c), 'near' FROM p JOIN n ON n.k = u JOIN m ON m.k = v WHERE c / (n.n + m.n - c) >= 0.8)
    SELECT id, e AS evaluation_id, kind, similarity FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank, similarity DESC, e) = 1""",
)
def _(spark, d):
    train = table(spark, d, "legal_raw").filter("text IS NOT NULL").select(F.concat_ws("#", "source_file", "source_row").alias("id"), "text")
    return decontam.contamination(train, table(spark, d, "accepted").select("id", "text"))
