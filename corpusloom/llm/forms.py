"""One consistent form for texts that look the same.

Only the clusters of a text around characters that may change (look-alikes, compatibility forms,
marks, invisible ones) can change; texts without them pass as they are. The distinct clusters of
the corpus are few. They are exploded to positioned code points, joined with the decompositions
and look-alikes (a table made from the Unicode character database, so of bounded size), their
combining marks ordered by class and recomposed, and the rebuilt clusters are put back into the
texts.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import computed
from corpusloom.operators.joins import join_groups
from corpusloom.session import cut_lineage

# Letters that look like a Latin letter, by script.
LOOK_ALIKES = {
    "Cyrillic": "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT ХX ҮY ԚQ ԜW аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ѵv ӏl",
    "Greek": "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ϳj",
    "Armenian": "ՕO ՍU օo սu հh",
    "Latin": "ɑa ɡg",
}
# Compatibility decompositions that keep the look; others (superscripts, fractions, circles) differ visibly.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
# The long s and its ligature, whose decompositions look different.
KEPT = "ſﬅ"
_INVISIBLE = {"Cf", "Cc", "Cs"}
_VARIATION = (*range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0), 0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)


@cache
def look_alikes() -> dict[str, str]:
    """Letter by the letter that it looks like."""
    return {pair[0]: pair[1] for text in LOOK_ALIKES.values() for pair in text.split()}


@cache
def _decomposed(ch: str) -> str:
    """Full decomposition of a character, canonical or of the same look."""
    d = unicodedata.decomposition(ch)
    if not d or ch in KEPT or 0xAC00 <= ord(ch) <= 0xD7A3:
        return ch
    parts = d.split()
    if parts[0][0] == "<":
        if parts[0] not in SAME_LOOK or (len(parts) > 2 and parts[1] == "0020"):
            return ch
        parts = parts[1:]
    return "".join(_decomposed(chr(int(p, 16))) for p in parts)


def plain(ch: str) -> str:
    """What stands for a character before marks are recomposed; empty for an invisible one."""
    kind = unicodedata.category(ch)
    if ch in "\u0085  ":
        return "\n"
    if kind in _INVISIBLE or ord(ch) in _VARIATION:
        return ch if ch in "\t\n" else ""
    if kind == "Zs":
        return " "
    return "".join(look_alikes().get(c, c) for c in _decomposed(ch))


def _group_class(ch: str) -> int | None:
    """Combining class of what attaches to the character before it, else null; conjoining jamo count as class 0."""
    if 0x1161 <= ord(ch) <= 0x11FF:
        return 0
    return unicodedata.combining(ch) or None


@cache
def stable_class() -> str:
    """Body of a regex class of characters beyond ASCII that never change and attach to nothing: all such of the blocks that most texts are made of."""
    def changes(i: int) -> bool:
        ch = chr(i)
        return _group_class(ch) is not None or unicodedata.normalize("NFC", plain(ch)) != ch or unicodedata.category(ch) == "Cn"

    parts = ["".join(rf"\x{i:02x}" for i in range(0x80, 0x100) if not changes(i))]
    for low, high in ((0x100, 0x180), (0x2010, 0x2070), (0x20A0, 0x20C0)):
        start = None
        for i in range(low, high + 1):
            ok = i < high and not changes(i)
            if ok and start is None:
                start = i
            elif not ok and start is not None:
                parts.append(rf"\x{{{start:x}}}-\x{{{i - 1:x}}}")
                start = None
    return "".join(parts)


@cache
def unstable() -> str:
    """Regex of a character that may change or attach; ASCII is passed over at once."""
    return rf"[^\x09\x0a\x20-\x7e](?<![{stable_class()}])"


@cache
def cluster() -> str:
    """Regex of what may change: a run of such characters, with the one before it, to which marks may attach."""
    return rf"(?:[\x20-\x7e]|[{stable_class()}])?(?:{unstable()})+"


@cache
def compositions() -> dict[str, dict[str, str]]:
    """Composed character by base letter and the marks applied to it in order."""
    out: dict[str, dict[str, str]] = {}
    for i in range(0x20000):
        ch = chr(i)
        if unicodedata.decomposition(ch)[:1] not in ("", "<") or 0xAC00 <= i <= 0xD7A3:
            if unicodedata.normalize("NFC", ch) == ch and len(full := unicodedata.normalize("NFD", ch)) > 1:
                out.setdefault(full[0], {})[full[1:]] = ch
    for i in range(0xAC00, 0xD7A4):
        full = unicodedata.normalize("NFD", chr(i))
        out.setdefault(full[0], {})[full[1:]] = chr(i)
        if len(full) == 3:
            out.setdefault(unicodedata.normalize("NFC", full[:2]), {})[full[2]] = chr(i)
    return out


@cache
def _character_rows() -> list[tuple[str, list[dict]]]:
    rows = []
    # Beyond the first two planes only the compatibility ideographs and the tags change or attach.
    for i in (*range(0x09), 0x0B, 0x0C, *range(0x0E, 0xD800), *range(0xE000, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)):
        ch = chr(i)
        kind = unicodedata.category(ch)
        if kind in ("Cf", "Cc", "Zs", "Zl", "Zp") or kind[0] == "M" or unicodedata.decomposition(ch) or ch in look_alikes() or i in _VARIATION or _group_class(ch) is not None:
            to = plain(ch)
            if to != ch or _group_class(ch) is not None:
                rows.append((ch, [{"c": c, "cc": _group_class(c)} for c in to]))
    return rows


def character_table(spark: SparkSession) -> DataFrame:
    """Characters that may change or attach, with the code points that stand for them and their classes."""
    part = pa.struct([("c", pa.string()), ("cc", pa.int32())])
    ch, parts = zip(*_character_rows())
    return spark.createDataFrame(pa.table({"ch": pa.array(ch), "parts": pa.array(parts, pa.list_(part))}))


def composition_table(spark: SparkSession) -> DataFrame:
    """Base letters with their composed characters by the marks applied."""
    base, comp = zip(*((b, list(m.items())) for b, m in compositions().items()))
    return spark.createDataFrame(pa.table({"base": pa.array(base), "comp": pa.array(comp, pa.map_(pa.string(), pa.string()))}))


def _recomposed() -> Column:
    """A base with its marks in order: a mark composes unless one of its class that did not stands before it."""
    state = F.struct(F.lit("").alias("done"), F.lit("").alias("rest"), F.lit(-1).alias("last"))

    def step(s: Column, m: Column) -> Column:
        joined = F.concat(s.done, m.c)
        fits = F.coalesce(F.map_contains_key("comp", joined), F.lit(False)) & ((s["last"] < m.cc) | (s.rest == ""))
        return F.when(fits, F.struct(joined.alias("done"), s.rest.alias("rest"), s["last"].alias("last"))).otherwise(
            F.struct(s.done.alias("done"), F.concat(s.rest, m.c).alias("rest"), m.cc.alias("last"))
        )

    def finish(s: Column) -> Column:
        return F.concat(F.when(s.done == "", F.coalesce("base", F.lit(""))).otherwise(F.col("comp")[s.done]), s.rest)

    return F.aggregate("marks", state, step, finish)


def cluster_forms(clusters: DataFrame) -> DataFrame:
    """The ``form`` of each of the distinct strings in column ``cluster``."""
    spark = clusters.sparkSession
    alone = F.array(F.struct(F.col("ch").alias("c"), F.lit(None).cast("int").alias("cc")))
    points = (
        clusters.select("cluster", F.posexplode(F.split("cluster", "")).alias("pos", "ch"))
        .join(F.broadcast(character_table(spark)), "ch", "left")
        .select("cluster", "pos", F.posexplode(F.coalesce("parts", alone)).alias("sub", "p"))
        .select("cluster", "pos", "sub", "p.*")
    )
    begins = F.sum(F.col("cc").isNull().cast("int")).over(Window.partitionBy("cluster").orderBy("pos", "sub"))
    marks = F.sort_array(F.collect_list(F.when(F.col("cc").isNotNull(), F.struct("cc", "pos", "sub", "c"))))
    groups = points.withColumn("n", begins).groupBy("cluster", "n").agg(F.max(F.when(F.col("cc").isNull(), F.col("c"))).alias("base"), marks.alias("marks"))
    composed = groups.join(F.broadcast(composition_table(spark)), "base", "left")
    pieces = F.sort_array(F.collect_list(F.struct("n", _recomposed().alias("s"))))
    built = composed.groupBy("cluster").agg(F.array_join(F.transform(pieces, lambda x: x.s), "").alias("form"))
    return clusters.join(built, "cluster", "left").select("cluster", F.coalesce("form", F.lit("")).alias("form"))


def _key(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _forms_by_text(rows: DataFrame) -> DataFrame:
    """``__key`` of each text of ``rows``, the number ``n`` of its copies, and the forms of its clusters in order."""
    found = rows.select("__key", F.posexplode(F.regexp_extract_all("__tidy", F.lit(cluster()), F.lit(0))).alias("pos", "cluster"))
    found = cut_lineage(found.groupBy("__key", "pos", "cluster").agg(F.count(F.lit(1)).alias("copies")))
    counts = cut_lineage(found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = cut_lineage(cluster_forms(counts.select("cluster")).join(counts, "cluster"))
    forms = join_groups(found, known, ["cluster"], total)
    placed = F.transform(F.sort_array(F.collect_list(F.struct("pos", "form"))), lambda x: x.form)
    return forms.groupBy("__key").agg(F.max("copies").alias("n"), placed.alias("__forms"))


def with_form(df: DataFrame, text: str = "text", name: str = "form") -> DataFrame:
    """The table with the one form of its texts in column ``name``; a column of that name is replaced.

    Texts that a reader cannot tell apart get equal forms: compatibility forms of the same look,
    ligatures, separate accents, invisible characters, blanks of another kind, look-alike letters
    of another script and CR LF line ends. Any visible difference stays. A null text has a null
    form, an empty one an empty form; repeated rows stay. Only texts with characters that may
    change are shuffled, each distinct one once; texts that very many rows share are rebuilt where
    they are.
    """
    spark_rows = df.drop(name)
    tidy = F.regexp_replace(F.col(text), r"\r\n?", "\n")
    rows = computed(spark_rows.withColumn("__tidy", tidy), "__key", F.when(F.col("__tidy").rlike(unstable()), _key(F.col("__tidy"))))
    same = rows.filter("__key IS NULL").withColumn(name, F.col("__tidy"))
    touched = rows.filter("__key IS NOT NULL")
    forms = cut_lineage(_forms_by_text(touched))
    total = forms.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    joined = join_groups(touched, forms, ["__key"], total)
    kept = F.split("__tidy", cluster(), -1)
    zipped = F.zip_with(kept, "__forms", lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    changed = joined.withColumn(name, F.array_join(zipped, ""))
    return same.select(*spark_rows.columns, name).unionByName(changed.select(*spark_rows.columns, name))


def _variants(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (``k``, hash ``t`` of the text, hash ``f`` of its form) of forms that are written in several ways; and the ways (``f``, ``t``, ``n``)."""
    rows = with_form(df.select(F.col(key).alias("k"), F.col(text).alias("text")).filter("k IS NOT NULL AND text IS NOT NULL"))
    hashed = cut_lineage(rows.select("k", _key(F.col("text")).alias("t"), _key(F.col("form")).alias("f")))
    ways = hashed.groupBy("f", "t").agg(F.count(F.lit(1)).alias("n"))
    mixed = ways.groupBy("f").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1").select("f")
    ways = cut_lineage(ways.join(mixed, "f", "left_semi"))
    return hashed.join(ways.select("f", "t"), ["f", "t"], "left_semi").distinct(), ways


def look_alike_pairs(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs of rows whose texts look the same but differ in code points, smaller key first, each once.

    Null texts and null keys are in no pair. Identical texts are no pair, so a group of copies
    yields pairs only with its differently written members. The ways of writing are paired first;
    their rows are joined to the pairs by slices, so that work is in proportion to the result.
    """
    members, ways = _variants(df, key, text)
    slices = 16
    other = ways.select("f", F.col("t").alias("u"))
    pairs = ways.select("f", "t").join(other, "f").filter("t <> u")
    sliced = F.pmod(F.xxhash64("k"), F.lit(slices)).cast("int").alias("slice")
    spread = pairs.select("t", "u", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    left = members.select("t", F.col("k").alias("a"), sliced).join(spread, ["t", "slice"]).select("a", "u", sliced_key("a", slices))
    right = members.select(F.col("t").alias("u"), F.col("k").alias("b")).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    found = left.join(right, ["u", "side"]).filter("a < b")
    return found.select(F.col("a").alias(f"{key}_a"), F.col("b").alias(f"{key}_b")).distinct()


def sliced_key(name: str, slices: int) -> Column:
    """A slice of rows by their key, as ``side``."""
    return F.pmod(F.xxhash64(F.lit("side"), name), F.lit(slices)).cast("int").alias("side")


def look_alike_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row that looks like another but is written differently: its key, ``class_id`` (the least key of the class) and the number of its ``links``."""
    members, ways = _variants(df, key, text)
    distinct = members.groupBy("f", "t").agg(F.min("k").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = distinct.groupBy("f").agg(F.min("least").alias("class_id"), F.sum("n").alias("n"))
    groups = cut_lineage(distinct.withColumnRenamed("n", "own").drop("least").join(classes, "f"))
    total = groups.agg(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    rows = join_groups(members, groups.select("f", "t", "class_id", F.col("own").alias("n"), (F.col("n") - F.col("own")).alias("links")), ["f", "t"], total)
    return rows.select(F.col("k").alias(key), "class_id", "links")
