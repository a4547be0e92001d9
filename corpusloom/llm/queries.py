"""Queries of the training-data operators over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import flow, forms, mixing, packing, quality, repetition, splits, tokens, truncation
from corpusloom.queries import sql_folded, sql_nfkc, sql_reached, sql_source, sql_string
from corpusloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL counterpart where SQL can express it."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return put


def _same_look(x: str) -> str:
    """SQL of the form in which texts that look the same are equal."""
    single, several, gone = [], [], []
    for i in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)):
        c = chr(i)
        to = unicodedata.normalize("NFC", forms.plain(c))
        if to == "":
            gone.append(c)
        elif len(to) == 1 and to != c:
            single.append((c, to))
        elif len(to) > 1 and to != c and (i < 0x180 or 0x2000 <= i < 0x2190 or 0xFB00 <= i < 0xFB07):
            several.append((c, to))
    for c, to in several:
        x = f"replace({x}, {sql_string(c)}, {sql_string(to)})"
    # translate drops what has no counterpart
    whole = "".join(a for a, _ in single) + "".join(gone)
    x = f"translate(nfc_normalize({x}), {sql_string(whole)}, {sql_string(''.join(b for _, b in single))})"
    return f"nfc_normalize(regexp_replace({x}, '\\r\\n?', chr(10), 'g'))"


@query(
    "p1_found",
    f"""WITH f AS (SELECT doc_id, text, {_same_look('text')} AS form FROM documents WHERE text IS NOT NULL)
    SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text""",
)
def _(spark, d):
    return forms.look_alike_pairs(table(spark, d, "documents"))


@query("p1_forms")
def _(spark, d):
    return forms.with_form(table(spark, d, "documents").select("doc_id", "text"))


@query(
    "p1_classes",
    f"""WITH f AS (SELECT doc_id, text, {_same_look('text')} AS form FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, class_id, links FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY form) AS class_id, count(*) OVER (PARTITION BY form) - count(*) OVER (PARTITION BY form, text) AS links FROM f) WHERE links > 0""",
)
def _(spark, d):
    return forms.look_alike_classes(table(spark, d, "documents"))


_TYPE = "lower(trim(coalesce(nullif(trim({0}), ''), {1})))"
_LABEL = "CASE WHEN {0} IN ('case law', 'case-law', 'case_law') THEN 'caselaw' WHEN {0} = 'legal_mc4' THEN 'legal-mc4' ELSE {0} END"
_PLACE = "CASE lower(trim({0})) WHEN 'us' THEN 'US' WHEN 'eu' THEN 'EU' WHEN 'uk' THEN 'UK' WHEN 'switzerland' THEN 'Switzerland' WHEN 'n/a' THEN 'N/A' WHEN 'na' THEN 'N/A' ELSE trim({0}) END"


@query(
    "p2_found",
    f"""
    WITH records AS (
        SELECT source_file, source_row, min({_LABEL.format(_TYPE.format("type", "text_type"))}) AS t, min({_PLACE.format("jurisdiction")}) AS j
        FROM legal_raw GROUP BY ALL
    )
    SELECT s.type, s.jurisdiction FROM sampling_targets s
    LEFT JOIN (SELECT t, j, count(*) AS n FROM records GROUP BY ALL) c
        ON c.t = {_LABEL.format(_TYPE.format("s.type", "NULL"))} AND c.j = {_PLACE.format("s.jurisdiction")}
    WHERE coalesce(c.n, 0) < greatest(s.min_rows, s.target_share::DECIMAL(18, 9) * (SELECT count(*) FROM records) / 5)
    """,
)
def _(spark, d):
    return flow.StratifiedSample(table(spark, d, "legal_raw"), table(spark, d, "sampling_targets")).short()


@query("p2_report")
def _(spark, d):
    return flow.StratifiedSample(table(spark, d, "legal_raw"), table(spark, d, "sampling_targets")).report()


@query("p2_sample")
def _(spark, d):
    return flow.StratifiedSample(table(spark, d, "legal_raw"), table(spark, d, "sampling_targets")).sample()


@query("p3_found")
def _(spark, d):
    return quality.not_prose(table(spark, d, "documents"))


@query("p3_statistics")
def _(spark, d):
    return quality.text_statistics(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "quality.*")


# Words in runs of ten that occurred earlier in the text, as the definition has them.
_REPEATED = f"""(WITH t AS (SELECT doc_id, regexp_extract_all(regexp_replace({sql_folded(sql_nfkc('text'))}, '\\p{{Cf}}', '', 'g'), '[\\p{{L}}\\p{{N}}\\p{{M}}]+') AS w FROM documents),
    g AS (SELECT doc_id, n, i, row_number() OVER (PARTITION BY doc_id, run ORDER BY i) AS r FROM (
        SELECT doc_id, len(w) AS n, unnest(range(1, len(w) - 8)) AS i, unnest(list_transform(range(1, len(w) - 8), lambda i: array_to_string(list_slice(w, i, i + 9), ' '))) AS run FROM t)),
    c AS (SELECT DISTINCT doc_id, n, i + k AS at FROM g, (SELECT unnest(range(10)) AS k) WHERE r > 1)
    SELECT doc_id, count(*) / any_value(n) AS share FROM c GROUP BY doc_id)"""


@query("p4_found", f"SELECT doc_id FROM {_REPEATED} WHERE share >= 0.4")
def _(spark, d):
    return repetition.Repetition(table(spark, d, "documents")).repetitive()


@query("p4_shares")
def _(spark, d):
    return repetition.Repetition(table(spark, d, "documents")).flagged()


@query("p4_report")
def _(spark, d):
    return repetition.Repetition(table(spark, d, "documents")).report()


# Tokens by words; the cases of p5, p7 and p8 are clear of their limits under any count.
_ABOUT = "greatest(1.45 * len(regexp_split_to_array(trim({0}), '\\s+')), strlen({0}) / 4.5)"


@query("p5_found", f"SELECT DISTINCT id FROM accepted WHERE estimated_tokens IS NULL OR estimated_tokens < 0.5 * {_ABOUT.format('text')} OR estimated_tokens > 2 * {_ABOUT.format('text')}")
def _(spark, d):
    return tokens.misestimated(table(spark, d, "accepted"))


@query("p5_budget")
def _(spark, d):
    return tokens.token_budget([table(spark, d, "accepted"), table(spark, d, "documents")])


_BARE = f"regexp_replace({sql_folded(sql_nfkc('m.content'))}, '\\s+', '', 'g')"
_TIED = f"""(SELECT policy_group AS u, min(policy_group) OVER (PARTITION BY direction, p) AS v FROM (
    SELECT policy_group, direction, {_BARE} AS p FROM (SELECT policy_group, direction, unnest(messages) AS m FROM sft_records WHERE policy_group IS NOT NULL) WHERE lower(m.role) = 'user') WHERE p <> '')"""
_CLASSES = sql_reached(_TIED, "(SELECT DISTINCT policy_group AS node FROM sft_records WHERE policy_group IS NOT NULL)")


@query("p6_found", f"WITH c AS (SELECT * FROM {_CLASSES}) SELECT a.node AS policy_group_a, b.node AS policy_group_b FROM c a JOIN c b ON a.component = b.component AND a.node < b.node")
def _(spark, d):
    return splits.group_pairs(splits.tied_groups(table(spark, d, "sft_records")))


@query("p6_classes", f"SELECT * FROM (SELECT node AS policy_group, component AS class_id, count(*) OVER (PARTITION BY component) - 1 AS links FROM {_CLASSES}) WHERE links > 0")
def _(spark, d):
    return splits.group_classes(splits.tied_groups(table(spark, d, "sft_records")))


def _labels() -> list:
    """What splits are stratified by: the direction, the length and the file a record comes from."""
    return ["direction", splits.length_class(), F.get("provenance", 0)["file"]]


@query("p6_splits")
def _(spark, d):
    assigned = splits.assign_splits(table(spark, d, "sft_records"), table(spark, d, "split_targets"), _labels())
    return assigned.select("id", "direction", "policy_group", "component", "assigned_split")


@query("p6_report")
def _(spark, d):
    targets = table(spark, d, "split_targets")
    return splits.split_report(splits.assign_splits(table(spark, d, "sft_records"), targets, _labels()), targets, _labels())


def _capacity(spark: SparkSession, d: str) -> int:
    return table(spark, d, "pack_capacities").filter("pack_name = 'sft_sequence'").first().capacity_tokens


@query("p7_found", f"SELECT doc_id FROM documents, pack_capacities WHERE pack_name = 'sft_sequence' AND {_ABOUT.format('text')} > capacity_tokens")
def _(spark, d):
    return packing.split_documents(packing.pack(table(spark, d, "documents"), _capacity(spark, d)))


@query("p7_containers")
def _(spark, d):
    return packing.pack(table(spark, d, "documents"), _capacity(spark, d))


@query("p7_fill")
def _(spark, d):
    capacity = _capacity(spark, d)
    return packing.fill_report(packing.pack(table(spark, d, "documents"), capacity), capacity)


@query(
    "p8_found",
    f"""WITH t AS (SELECT {sql_source('source')} AS s, sum({_ABOUT.format('text')}) AS n FROM documents GROUP BY ALL)
    SELECT DISTINCT m.source FROM mix_targets m LEFT JOIN t ON t.s = {sql_source('m.source')} WHERE coalesce(n, 0) * max_repeats < target_share * (SELECT sum(n) FROM t)""",
)
def _(spark, d):
    return mixing.Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).short()


@query("p8_mixture")
def _(spark, d):
    return mixing.Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).documents()


@query("p8_report")
def _(spark, d):
    return mixing.Mixture(table(spark, d, "documents"), table(spark, d, "mix_targets")).report()


@query("p9_found")
def _(spark, d):
    return truncation.cut_texts(table(spark, d, "documents")).filter("cut AND doc_id IS NOT NULL").select("doc_id").distinct()


@query("p9_source_rates")
def _(spark, d):
    return truncation.cut_rates(truncation.cut_texts(table(spark, d, "documents")))
