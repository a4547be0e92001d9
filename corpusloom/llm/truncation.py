"""Texts that were cut before their end, found by the company of their last words.

Words and stops of all texts are reduced to shapes and counted as trigrams, with how often each
ends a block. How often a text's last trigram ends one (its terminal rate) decides: what is
frequent inside texts but almost never terminal speaks for a cut. Rates of rare trigrams lean
on those of the last two shapes, of the last one and of its class, so that a word broken in the
middle is judged by how rarely lower-case words end a block. Loaders' marks, closing lines and
whether the end reads as running text are features beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.labels import source_label
from corpusloom.functions.text import computed
from corpusloom.llm.quality import FUNCTION_WORDS
from corpusloom.operators.joins import join_groups
from corpusloom.session import cut_lineage

#: A terminal rate of at most this share of that of all trigrams is "almost never".
RARELY = 0.25
#: Occurrences that the rate of the shorter shape counts for.
LEAN = 5
#: A short last block whose shape or wording ends at least this share of all distinct texts (and CLOSING_TEXTS of them), and more than
#: CLOSING_BEGUN of the blocks that begin with it, is a closing line, unless more than MARKED_SHARE of those texts bear a mark.
CLOSING_SHARE, CLOSING_TEXTS, CLOSING_BEGUN, MARKED_SHARE = 0.0003, 3, 0.05, 0.1
#: Tokens of a last block up to which it may be a closing line.
CLOSING_TOKENS = 10
#: Share of function words from which a last block is running text.
RUNNING = 0.12
#: Characters that hold the tokens of a closing line and one more.
BLOCK_HEAD = 160
#: Characters at the end of a text in which its last three tokens are looked for first.
LAST = 100
#: Characters at the end of a text that hold its last tokens and whatever the patterns of the end admit.
TAIL = 400
_WHITE = " \t\n\r\u00a0\u2002\u2007\u2009\u202f\u3000"
# A last line between dashes, as loaders add it to every text.
_RECORD = r"^\s*[-=_~]{2,}.*[-=_~]{2,}\s*$"
# What loaders leave at a cut: dots, a broken character, a note in brackets, the begin of a tag, entity or escape, a dash.
_MARK = (
    r"(?i)(?:\s*(?:\x{2026}|\.{3,}|\x{FFFD}+|[\[(<{]\s*(?:truncated|cut|cut off|more|continued|snip|snipped|\.{3}|\x{2026})[^\])>}\n]{0,20}[\])>}]"
    r"|</?[a-z]{0,10}|&[a-z#0-9]{1,8}|\\u[0-9a-f]{0,4}|\s[-\x{2013}])){1,4}\s*\z"
)
# What one of these begins with, and characters that hold the longest.
_MARK_BEGIN, MARK = r"[\x{2026}\x{FFFD}\[(<{&\\]|\s[-\x{2013}]|\.\.\.", 48
# Abbreviations whose full stop ends no sentence.
_ABBREVIATED = r"(?:^|[\s(])(?:No|Nos|Art|Arts|Nr|Abs|v|vs|cf|para|paras|Sec|sec|Ch|ch|p|pp|Vol|vol|Dr|Mr|Mrs|Ms|Prof|St|al|Ltd|Inc|Co|αρ|αρθ|παρ|чл|ал)\.\z"
# Last lines that close a text wherever they stand.
_CLOSED = r"(?i)^[^\p{L}\p{N}]*(?:the end|end|end of (?:the )?(?:text|document|file))[^\p{L}\p{N}]*\z"
# Quotes and brackets that close after a stop, and notes in brackets after it.
_CLOSERS = r"(?<=[.!?\x{037E}])(?:[\"'\x{201D}\x{2019}\x{00BB})\]]+|\s*[\[(][^\])\n]{1,40}[\])])+\s*\z"
_CLOSING, _STOPS = ("\"", "'", "\u201d", "\u2019", "\u00bb", ")", "]"), (".", "!", "?", "\u037e")
#: Characters that hold an abbreviation and what stands before it.
ABBREVIATION = 10
# A character that is written more plainly; printable ASCII is passed over at once.
_ODD = r"[^\x0a\x20-\x7e](?<=[\p{Cf}\x{FF01}-\x{FF5E}\p{Zs}\t])"
# Classes of shapes: words, capitalised words, numbers, stops, others.
WORD, CAPITAL, NUMBER, STOP, OTHER = range(5)


def _without_end(text: Column, characters: Column) -> Column:
    return F.rtrim(F.left(text, F.length(text) - characters), F.lit(_WHITE))


def plain_end(text: Column) -> Column:
    """A text without invisible characters, with full-width and odd blanks as plain ones."""
    wide = "".join(chr(i) for i in range(0xFF01, 0xFF5F))
    narrow = "".join(chr(i - 0xFEE0) for i in range(0xFF01, 0xFF5F))
    plain = F.regexp_replace(F.regexp_replace(F.translate(text, wide, narrow), r"\p{Cf}+", ""), r"[\p{Zs}\t]+", " ")
    return F.when(text.rlike(_ODD), plain).otherwise(text)


def shapes(text: Column, capitals: bool = False) -> Column:
    """Words and stops in order; numbers and (without ``capitals``) capitalised words by a sign each, other words as they stand; a break between blocks is one too."""
    s = F.regexp_replace(text, r"[0-9]+(?:[.,][0-9]+)*", "\u0001")
    if not capitals:
        s = F.regexp_replace(s, r"\p{Lu}[\p{L}\p{M}]*", "\u0002")
    return F.regexp_extract_all(s, F.lit(r"[\p{L}\p{M}]+|\n\n|[^\s\p{L}\p{M}]"), F.lit(0))


def identity(x: Column) -> Column:
    """A 61-bit hash of a shape with its class in the lowest three bits; what is longer than a character is a word."""
    first = F.ascii(x)
    kind = (
        F.when(first.between(97, 122), WORD).when(x == "\u0002", CAPITAL).when(x == "\u0001", NUMBER).when(x.isin(".", "!", "?", "\u037e"), STOP)
        .when(F.char_length(x) > 1, WORD).when((first >= 128) & x.rlike(r"^\p{L}"), WORD).otherwise(OTHER)
    )
    return F.shiftleft(F.xxhash64(x), 3).bitwiseOR(kind.cast("long"))


def gram_keys(a: Column, b: Column, c: Column) -> list[Column]:
    """Keys of a trigram, of its last two shapes and of its last one, each made from the next."""
    one = identity(c)
    two = F.xxhash64(b, one)
    return [F.xxhash64(a, two).alias("three"), two.alias("two"), one.alias("one")]


def padded(tokens: Column) -> Column:
    """Shapes of a block after signs for its begin."""
    return F.concat(F.array(F.lit("\n\n"), F.lit("\n\n")), tokens)


def trigram_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Trigrams of the shapes of all texts by their keys, how often they occur (``n``) and how often they end a block (``ends``).

    The break between blocks is a shape of its own. The last trigram of a text and that before
    its last break are left out: they may be those of a cut, or of what a loader put after one.
    """
    plain = computed(df.select(text), "s", F.concat(F.lit("\n\n"), plain_end(F.col(text))))
    last = F.length(F.substring_index("s", "\n\n", -1))
    marked = F.concat(F.left("s", F.length("s") - last - 2), F.lit("\u0004"), F.right("s", last))
    rows = plain.select(shapes(marked).alias("t"))
    room = F.greatest(F.size("t") - 3, F.lit(0))
    fours = F.arrays_zip(*[F.slice("t", F.lit(i), room).alias(a) for i, a in enumerate("abcd", 1)])
    each = rows.select(F.explode(fours).alias("g")).select("g.*").filter(~F.col("c").isin("\n\n", "\u0004") & (F.col("d") != "\u0004"))
    grams = each.select(*gram_keys(F.col("a"), F.col("b"), F.col("c")), (F.col("d") == "\n\n").cast("int").alias("e"))
    return grams.groupBy("three", "two", "one").agg(F.count(F.lit(1)).alias("n"), F.sum("e").alias("ends"))


def terminal_rates(slim: DataFrame, counts: DataFrame) -> tuple[DataFrame, float]:
    """The rows of ``slim`` that have last shapes (``three``, ``two``, ``one``), with their ``rate`` and ``evidence``; and the rate of all trigrams.

    The ends of stopped texts count as terminal beside those of inner blocks, each distinct text
    once and the one that is judged left out. ``evidence`` names the longest shape that was seen
    elsewhere: trigram, pair, last, or class. Any sentence may be a text's last, so a stop (not
    that of an abbreviation) is judged by its own rate, whatever words stand before it.
    """
    whole = F.count(F.lit(1))
    ended = slim.filter("one IS NOT NULL").groupBy("three", "two", "one", "content").agg(whole.alias("copies"), F.max(F.col("stopped").cast("int")).alias("stops"))
    asked = cut_lineage(ended.groupBy("three", "two", "one").agg(F.sum("copies").alias("n"), F.sum("stops").alias("stops")))
    every = counts.unionByName(asked.filter("stops > 0").select("three", "two", "one", F.col("stops").alias("n"), F.col("stops").alias("ends")))
    sums = lambda df, keys, k: df.groupBy(*keys).agg(F.sum("n").alias(f"n{k}"), F.sum("ends").alias(f"e{k}"))
    ones = cut_lineage(sums(every, ["one"], 1))
    kind = F.col("one").bitwiseAND(F.lit(7).cast("long")).cast("int")
    classes = {r.kind: (r.n, r.e) for r in ones.groupBy(kind.alias("kind")).agg(F.sum("n1").alias("n"), F.sum("e1").alias("e")).collect()}
    base = sum(e for _, e in classes.values()) / max(sum(n for n, _ in classes.values()), 1)
    pairs = cut_lineage(asked.groupBy("two", "one").agg(whole.alias("n")))
    last = cut_lineage(pairs.groupBy("one").agg(whole.alias("n")).join(ones, "one", "left"))
    of_pairs = sums(every.join(pairs, ["two", "one"], "left_semi"), ["two", "one"], 2)
    known = join_groups(pairs.withColumnRenamed("n", "asked"), last, ["one"], pairs.count()).drop("n").withColumnRenamed("asked", "n")
    known = cut_lineage(known.join(of_pairs, ["two", "one"], "left"))
    of_triples = sums(every.join(asked, ["three", "two", "one"], "left_semi"), ["three", "two", "one"], 3)
    known = join_groups(asked.select("three", "two", "one", F.col("n").alias("rows")), known, ["two", "one"], asked.count()).drop("n").withColumnRenamed("rows", "n")
    known = cut_lineage(known.join(of_triples, ["three", "two", "one"], "left").fillna(0))
    rows = join_groups(slim, known, ["three", "two", "one"], slim.count()).drop("n")

    own = F.col("stopped").cast("int")
    rate = F.lit(float(base))
    for k, (n, e) in classes.items():
        rate = F.when(kind == k, (F.lit(float(e)) - own + LEAN * base) / (F.lit(float(n)) - own + LEAN)).otherwise(rate)
    for k in (1, 2, 3):
        longer = (F.col(f"e{k}") - own + LEAN * rate) / (F.col(f"n{k}") - own + LEAN)
        rate = longer if k == 1 else F.when(F.col("stopped"), rate).otherwise(longer)
    evidence = F.when(F.col("stopped") & (F.col("n1") > own), "last").when(F.col("n3") > own, "trigram").when(F.col("n2") > own, "pair").when(F.col("n1") > own, "last").otherwise("class")
    return rows.select(*slim.columns, rate.alias("rate"), evidence.alias("evidence")), base


def begun_blocks(df: DataFrame, text: str, asked: DataFrame) -> DataFrame:
    """For each ``shape`` of ``asked`` (of at most CLOSING_TOKENS tokens) the blocks of all texts that begin with it and go on."""
    block = df.select(F.explode(F.split(F.col(text), "\n\n")).alias("b")).select(F.left("b", F.lit(BLOCK_HEAD)).alias("b")).filter("b <> ''")
    both = F.array(*[F.slice(shapes(plain_end(F.col("b")), capitals), 1, CLOSING_TOKENS + 1) for capitals in (False, True)])
    heads = block.select(F.explode(F.array_distinct(both)).alias("t"))
    lengths = sorted(r.k for r in asked.select(F.size(F.split("shape", " ")).alias("k")).distinct().collect())
    starts = F.filter(F.array(*map(F.lit, lengths or [CLOSING_TOKENS])), lambda k: k <= F.size("t"))
    begin = lambda k: F.xxhash64(k, F.array_join(F.slice("t", F.lit(1), k - 1), " "))
    begun = heads.select("t", F.explode(starts).alias("k")).select(begin(F.col("k")).alias("h"), F.element_at("t", F.col("k")).alias("token"), (F.size("t") > F.col("k")).alias("more"))
    lines = asked.select("shape", F.split("shape", " ").alias("t")).select("shape", begin(F.size("t")).alias("h"), F.element_at("t", -1).alias("end"))
    # A longer last word goes on too: what ends in a broken word is the begin of the whole one.
    goes_on = F.col("token").startswith(F.col("end")) & (F.col("more") | (F.col("token") != F.col("end")))
    return begun.join(F.broadcast(lines), "h").filter(goes_on).groupBy("shape").agg(F.count(F.lit(1)).alias("begun"))


def endings(df: DataFrame, key: str, text: str) -> DataFrame:
    """Each text without a loader's line (of at most TAIL characters) and mark (``bare``), and whether it had a mark."""
    trimmed = F.rtrim(F.col(text), F.lit(_WHITE))
    last_line = F.substring_index("trimmed", "\n", -1)
    rows = df.select(F.col(key).alias("key"), source_label("source").alias("source"), trimmed.alias("trimmed"))
    short = (F.length(last_line) <= TAIL) & (F.length(last_line) < F.length("trimmed"))
    record = F.when(short, plain_end(last_line).rlike(_RECORD)).otherwise(False)
    rows = rows.withColumn("full", F.when(record, _without_end(F.col("trimmed"), F.length(last_line))).otherwise(F.col("trimmed")))
    tail = F.right("full", F.lit(TAIL))
    begun = F.right("full", F.lit(MARK)).rlike(_MARK_BEGIN)
    rows = rows.withColumn("mark", F.when(begun, F.length(tail) - F.length(F.regexp_replace(tail, _MARK, ""))).otherwise(0))
    bare = F.when(F.col("mark") > 0, _without_end(F.col("full"), F.col("mark"))).otherwise(F.col("full"))
    return rows.select("key", "source", (F.col("mark") > 0).alias("marked"), bare.alias("bare"))


def _running(block: Column, previous: Column) -> Column:
    """Whether the last block, or the one before it where that is a short single line, reads as running text."""
    short = (F.length(block) < 40) & ~block.rlike(r"[\n\t;|]|^[^\p{L}\p{N}]")
    words = F.regexp_extract_all(F.lower(F.when(short, F.concat_ws(" ", previous, block)).otherwise(block)), F.lit(r"[\p{L}\p{M}]+"), F.lit(0))
    common = F.filter(words, lambda w: w.isin(*_function_words()))
    return F.size(common) >= F.greatest(F.lit(1), RUNNING * F.size(words))


def _function_words() -> list[str]:
    return list(dict.fromkeys(w for kinds in FUNCTION_WORDS.values() for text in kinds for w in text.split() if w != "no"))


def described_ends(df: DataFrame, key: str, text: str) -> DataFrame:
    """Each text's features: its last three shapes (``three``, ``two``, ``one``), whether it is marked, stopped and running, and the shapes of a short last block.

    What ends with a sentence's stop reads as running text; elsewhere function words tell.
    """
    whole = F.substring_index("bare", "\n\n", -1)
    before = F.rtrim(F.left("bare", F.greatest(F.length("bare") - F.length(whole) - 2, F.lit(0))))
    parts = endings(df, key, text).select(
        "key", "source", "marked", F.xxhash64("bare").alias("content"), (F.length("bare") > 0).alias("any"), (F.length(whole) <= BLOCK_HEAD).alias("short"),
        plain_end(F.right("bare", F.lit(TAIL))).alias("end"), whole.alias("block"), F.right(F.substring_index(before, "\n\n", -1), F.lit(TAIL)).alias("previous"),
    )
    named = lambda c: F.when(F.size(c) <= CLOSING_TOKENS, F.array_join(c, " "))
    parts = parts.withColumn("end", F.rtrim(F.when(F.right(F.rtrim("end"), F.lit(1)).isin(*_CLOSING), F.regexp_replace("end", _CLOSERS, "")).otherwise(F.col("end"))))
    abbreviated = F.right("end", F.lit(ABBREVIATION)).rlike(_ABBREVIATED)
    stopped = F.right("end", F.lit(1)).isin(*_STOPS) & ~abbreviated
    # The first token of a cut tail may be a broken one; where four are there the last three are whole.
    ending = F.when(abbreviated, F.left("end", F.length("end") - 1)).otherwise(F.col("end"))
    parts = computed(parts.withColumns({"stopped": stopped, "end": ending}), "t", shapes(F.right("end", F.lit(LAST))))
    stopped = F.col("stopped")
    parts = computed(parts, "t", F.when((F.size("t") > 3) | (F.length("end") <= LAST), padded(F.col("t"))).otherwise(padded(shapes(F.col("end")))))
    rows = parts.select(
        "key", "source", "marked", "content", "any", F.coalesce(stopped, F.lit(False)).alias("stopped"), F.when(F.size("t") > 2, F.slice("t", -3, 3)).alias("t"),
        *[F.when(F.col("short"), shapes(plain_end(F.col("block")), capitals)).alias(name) for capitals, name in ((False, "block_shape"), (True, "block_words"))],
        (F.col("short") & plain_end(F.col("block")).rlike(_CLOSED)).alias("closed"), F.when(stopped & ~F.col("marked"), True).otherwise(_running(plain_end(F.col("block")), F.col("previous"))).alias("running"),
    )
    last = [F.when(F.col("t").isNotNull(), k).alias(n) for k, n in zip(gram_keys(*[F.get("t", i) for i in range(3)]), ("three", "two", "one"))]
    return cut_lineage(rows.select("key", "source", "marked", "stopped", "content", "any", "running", "closed", *last, named("block_shape").alias("shape"), named("block_words").alias("wording")))


def closing_lines(slim: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """The ``shape`` of the short last blocks that close texts; at most 1 / CLOSING_SHARE shapes and as many wordings."""
    least = max(CLOSING_TEXTS, CLOSING_SHARE * slim.select("content").distinct().count())
    lines = slim.select("content", "marked", F.explode(F.array_distinct(F.array("shape", "wording"))).alias("shape")).filter("shape IS NOT NULL").groupBy("shape", "content").agg(F.max("marked").alias("marked"))
    lines = lines.groupBy("shape").agg(F.count(F.lit(1)).alias("alike"), F.count_if("marked").alias("marks"))
    lines = cut_lineage(lines.filter((F.col("alike") >= least) & (F.col("marks") <= MARKED_SHARE * F.col("alike"))))
    begun = lines.join(begun_blocks(df, text, lines), "shape", "left").fillna(0, ["begun"])
    return cut_lineage(begun.filter(F.col("alike") > CLOSING_BEGUN * (F.col("alike") + F.col("begun"))).select("shape"))


def cut_texts(df: DataFrame, key: str = "doc_id", text: str = "text", trigrams: bool = True) -> DataFrame:
    """All rows with ``key``, ``source``, their trigram evidence and ``cut``.

    A text is cut if it reads as running text, ends in shapes that almost never end a block, and
    bears a loader's mark or no closing line. A null text, like an empty or blank one, is not
    cut. Repeated rows stay, but texts that end alike are counted by distinct texts, the one that
    is judged left out. ``rate`` is the terminal rate of the last trigram and ``evidence`` the
    longest shape of it that was seen elsewhere. Without ``trigrams`` the features alone decide
    (for comparison).
    """
    slim = described_ends(df, key, text)
    closing = closing_lines(slim, df, text)
    rated, base = terminal_rates(slim, cut_lineage(trigram_counts(df, text)))
    rated = rated.unionByName(slim.filter("one IS NULL").withColumns({"rate": F.lit(None).cast("double"), "evidence": F.lit("none")}))
    by_shape, by_wording = closing.withColumn("closing_shape", F.lit(True)), closing.select(F.col("shape").alias("wording"), F.lit(True).alias("closing_words"))
    lined = rated.join(F.broadcast(by_shape), "shape", "left").join(F.broadcast(by_wording), "wording", "left")
    lined = lined.withColumn("closing", F.coalesce("closing_shape", "closing_words", "closed", F.lit(False))).fillna(False, ["marked", "any", "running"])
    rare = F.coalesce(F.col("rate") <= RARELY * base, F.lit(False)) if trigrams else F.lit(True)
    cut = F.col("any") & F.col("running") & (F.col("marked") | ~F.col("closing")) & rare
    return lined.select(F.col("key").alias(key), "source", "marked", "stopped", "running", "closing", "evidence", "rate", cut.alias("cut"))


def cut_rates(cut: DataFrame) -> DataFrame:
    """Texts, cut texts and their share by source."""
    n = F.count(F.lit(1))
    return cut.groupBy("source").agg(n.alias("texts"), F.count_if("cut").alias("cut_texts"), (F.count_if("cut") / n).alias("cut_share"))
