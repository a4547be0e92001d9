"""The operators on small tables: nulls, empty tables, repeated rows, clashing names, and brute force."""

import random
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import flow, forms, mixing, packing, quality, queries, repetition, splits, tokens, truncation

PROSE = "The court below held that the appeal must be dismissed, since the claimant had not shown that the contract was binding on the parties. "
DOCS = "doc_id long, text string, lang string, source string, form string, tokens long, quality string, shard int, k string"


def docs(spark, rows):
    """Rows of (doc_id, text[, source]) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", "f", 7, "q", 1, "k") for r in rows], DOCS)


def forms_of(spark, texts):
    got = forms.with_form(docs(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert len(got) == len(texts)
    return [r.form for r in got]


def test_forms(spark):
    same = ["Ｆile no. ５", "File no. 5", "F​ile no. 5", "Fіle nо. 5", "File no. 5"]
    assert set(forms_of(spark, same)) == {"File no. 5"}
    assert forms_of(spark, ["café", "café", "cafe", None, "", "ﬁn", "a\r\nb"]) == ["café", "café", "cafe", None, "", "fin", "a\nb"]
    kept = ["x²", "x2", "1", "l", "I", "½", "1/2", "ſo", "so"]
    assert forms_of(spark, kept) == kept


def test_forms_order_marks_and_compose_like_unicode(spark):
    texts = ["ế", "ế", "ậ", "ậ", "q̣̇", "q̣̇", "각", "́x", "ạ́̂", "각", "Å", "ắ"]
    got = forms_of(spark, texts)
    assert got == [unicodedata.normalize("NFC", t) for t in texts]


def test_look_alike_pairs(spark):
    df = docs(spark, [(1, "paper"), (2, "pаper"), (3, "paper"), (4, "papers"), (2, "pаper"), (None, "раper"), (5, None), (6, "")])
    assert {tuple(r) for r in forms.look_alike_pairs(df).collect()} == {(1, 2), (2, 3)}
    assert forms.look_alike_pairs(df.limit(0)).collect() == []
    assert {tuple(r) for r in forms.look_alike_classes(df).collect()} == {(1, 1, 1), (2, 1, 2), (3, 1, 1)}
    assert forms.look_alike_classes(df.limit(0)).collect() == []


def test_pairs_of_many_copies(spark):
    """A third of all rows are copies of one text: pairs only with its other ways of writing."""
    rows = [(i, "paper") for i in range(40)] + [(100, "pаper"), (101, "раper")] + [(200 + i, f"other {i}") for i in range(40)]
    got = {tuple(r) for r in forms.look_alike_pairs(docs(spark, rows)).collect()}
    assert got == {(i, j) for i in range(40) for j in (100, 101)} | {(100, 101)}


def test_stable_characters_need_no_cluster():
    import re

    stable = re.compile("[\t\n" + re.sub(r"\\x\{(\w+)\}|\\x(\w\w)", lambda m: "\\" + f"U{int(m[1] or m[2], 16):08x}", forms.stable_class()) + r"\x20-\x7e]")
    rest = (chr(i) for i in range(0x20000, 0x110000) if not (0x2F800 <= i < 0x2FA20 or 0xE0000 <= i < 0xE0200))
    assert not any(unicodedata.decomposition(c) or unicodedata.combining(c) or unicodedata.category(c) in ("Cf", "Zs") for c in rest)
    for i in (*range(0x180), *range(0x2000, 0x2100)):
        if stable.fullmatch(chr(i)):
            assert unicodedata.normalize("NFC", forms.plain(chr(i))) == chr(i) or chr(i) in "\t\n"
    assert all(stable.fullmatch(c) for c in "aZ09 éßü–—“”’€§©") and not any(stable.fullmatch(c) for c in "\u00a0\u200b\u0301ﬁаο…ĳ")


def test_token_budget_and_estimates(spark):
    df = spark.createDataFrame(
        [("a", "one two three", 3, " X_y", "case law"), ("b", "one two three", None, "x-Y", "caselaw"), ("c", "one two three", 90, None, None), ("d", None, 0, "x-y", ""), ("a", "one two three", 3, "x-y", "caselaw"), (None, "word", 50, "z", "t")],
        "id string, text string, estimated_tokens long, source string, type string",
    )
    assert {r.id for r in tokens.misestimated(df).collect()} == {"b", "c"}
    rows = {(r.level, r.source, r.language, r.type): (r.documents, r.tokens) for r in tokens.token_budget([df, df.limit(0)]).collect()}
    assert rows["source", "x-y", None, None] == (4, 9)
    assert rows["slice", "x-y", "und", "caselaw"] == (3, 9)
    assert rows["total", None, None, None] == (6, 13)


def test_packing(spark):
    rows = [(i, "lorem ipsum dolor " * (i % 9 + 1)) for i in range(60)] + [(100, "amet sit " * 900), (101, None), (102, ""), (3, "lorem ipsum dolor " * 4)]
    df = docs(spark, rows)
    got = packing.pack(df, 256, shard_tokens=1000, shard_rows=30)
    counts = {r.doc_id: r.tokens for r in tokens.with_tokens(df.filter("doc_id >= 100")).collect()}
    boxes = {r.container: r.n for r in got.groupBy("container").agg(F.sum("tokens").alias("n")).collect()}
    assert max(boxes.values()) <= 256
    assert got.filter("doc_id = 100").agg(F.sum("tokens")).first()[0] == counts[100]
    assert got.filter("piece = 0").count() == len(rows)
    assert [r.doc_id for r in packing.split_documents(got).collect()] == [100]
    report = packing.fill_report(got, 256).first()
    assert report.least_containers <= report.containers <= report.least_containers + 12
    assert packing.pack(df.limit(0), 256).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, 0)


def test_retrieval_brings_neighbours_together(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"topic{i % 20}word{rng.randrange(40)}" for _ in range(20 + i % 7)) + " of the and to", "s") for i in range(600)]
    df = docs(spark, rows)
    purity, fills = {}, {}
    for way in (True, False):
        got = packing.pack(df, 1024, shard_tokens=20_000, retrieval=way).collect()
        boxes = {}
        for r in got:
            boxes.setdefault(r.container, []).append(r)
        assert sorted(r.doc_id for r in got) == list(range(600)) and max(sum(r.tokens for r in b) for b in boxes.values()) <= 1024
        purity[way] = sum(max([r.doc_id % 20 for r in b].count(t) for t in range(20)) for b in boxes.values()) / 600
        fills[way] = sum(r.tokens for r in got) / (1024 * len(boxes))
    assert purity[True] > 2 * purity[False] and fills[True] > fills[False] - 0.05


def test_mixture(spark):
    rows = [(i, "one two three four " * 20, "Big") for i in range(40)] + [(100 + i, "one two three four " * 20, " small_x ") for i in range(4)] + [(200, None, "Big"), (201, "w", None)]
    targets = spark.createDataFrame([("big", 0.5, 3), ("small-x", 0.4, 2), ("none", 0.1, 5)], "source string, target_share double, max_repeats long")
    mix = mixing.Mixture(docs(spark, rows), targets, block_tokens=16)
    report = {r.source: r for r in mix.report().collect()}
    assert {r.source for r in mix.short().collect()} == {"small-x", "none"}
    assert report["none"].actual_tokens == 0 and report["small-x"].most_copies == 2 and report["big"].most_copies <= 3
    assert abs(sum(r.actual_tokens for r in report.values()) - mix.total) <= 100
    for seed in range(4):  # a text without tokens at the head of the order is no copy too many
        few = mixing.Mixture(docs(spark, [(1, "", "big"), (2, None, "big"), (3, "a few words", "big"), (4, "", "big")]), spark.createDataFrame([("big", 1.0, 2)], targets.schema), seed=seed)
        assert max(r.copies for r in few.documents().collect()) <= 2
    many = mixing.Mixture(docs(spark, rows), targets, block_tokens=64, shard_rows=3)
    got = {r.source: r for r in many.report().collect()}
    assert got["big"].most_copies <= 3 and abs(got["big"].actual_tokens - got["big"].planned_tokens) <= 16 * 100 and got["small-x"].actual_tokens <= 2 * 4 * 81
    assert {r.source for r in many.short().collect()} == {"small-x", "none"}
    again = {tuple(r) for r in mixing.Mixture(docs(spark, rows).repartition(5), targets, block_tokens=64, shard_rows=3).documents().collect()}
    assert again == {tuple(r) for r in many.documents().collect()}
    empty = mixing.Mixture(docs(spark, rows).limit(0), targets)
    assert empty.documents().collect() == [] and {r.source for r in empty.short().collect()} == set()


def raw(spark, rows):
    schema = "source_file string, source_row long, type string, text_type string, jurisdiction string, loaded_at timestamp, quota long, bucket int"
    return spark.createDataFrame([(*r, datetime(2024, 1, 1 + i % 5), 1, 1) for i, r in enumerate(rows)], schema)


def test_stratified_sample(spark):
    rows = [("f", i, "Case Law", None, "us") for i in range(50)] + [("f", i, "caselaw", None, "US ") for i in range(20)] + [("g", i, "", "contracts", "EU") for i in range(30)] + [("h", 1, None, None, None), (None, None, None, None, None)]
    targets = spark.createDataFrame([("caselaw", "US", 0.4, 2), ("contracts", "EU", 0.5, 40), ("other", "UK", 0.1, 1)], "type string, jurisdiction string, target_share double, min_rows long")
    sample = flow.StratifiedSample(raw(spark, rows), targets)
    report = {r.type: r for r in sample.report().collect()}
    assert report["caselaw"].available_rows == 50 and report["contracts"].needed_rows == 40
    assert {tuple(r) for r in sample.short().collect()} == {("contracts", "EU"), ("other", "UK")}
    drawn = {(r.type, r.jurisdiction): r["count"] for r in sample.sample().groupBy("type", "jurisdiction").count().collect()}
    assert drawn == {(r.type, r.jurisdiction): r.drawn_rows for r in report.values() if r.drawn_rows}
    assert sum(drawn.values()) == 30 + 2  # the floors that can be kept are more than a fifth of the 82 records
    exact = flow.StratifiedSample(raw(spark, rows), targets.withColumn("min_rows", F.lit(1).cast("long")), seed=5)
    assert exact.sample().count() == 16 == sum(r.quota_rows for r in exact.report().collect())
    again = flow.StratifiedSample(raw(spark, rows).repartition(3), targets).sample()
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in sample.sample().collect()}
    empty = flow.StratifiedSample(raw(spark, rows).limit(0), targets)
    assert empty.sample().collect() == [] and empty.short().count() == 3


def test_quality_and_not_prose(spark):
    junk = "\n".join(f"{i};{i * 7};{i * 31}" for i in range(50))
    df = docs(spark, [(1, PROSE * 3), (2, junk), (2, junk), (3, None), (4, ""), (None, junk)])
    assert [r.doc_id for r in quality.not_prose(df).collect()] == [2]
    got = quality.text_statistics(df)
    assert got.count() == 6 and got.filter("doc_id = 3").first().quality.words == 0
    assert quality.not_prose(df.limit(0)).collect() == []


def test_repetition(spark):
    once = " ".join(f"word{i}" for i in range(60))
    df = docs(spark, [(1, once), (2, f"{once}. {once.upper()}!"), (2, f"{once}. {once.upper()}!"), (3, None), (4, ""), (5, "a " * 5)])
    found = repetition.Repetition(df, holdout=2000)
    assert [r.doc_id for r in found.repetitive().collect()] == [2]
    assert found.flagged().filter("doc_id = 2").first().repeated_share == pytest.approx(0.5)
    assert repetition.Repetition(df.limit(0)).repetitive().collect() == []


def test_learned_cutoffs_decide(spark, monkeypatch):
    """The rows found are those that reach the cutoff learned on the holdout, nothing else."""
    long = [" ".join(f"w{i}x{k}" for k in range(200)) for i in range(40)]
    some = [f"{t} {' '.join(t.split()[: 28])}" for t in long[:5]]  # 12 % repeated: ordinary
    many = [f"{t} {t}" for t in long[5:10]]
    df = docs(spark, list(enumerate(long + some + many)))
    found = repetition.Repetition(df, holdout=3000)
    assert {r.doc_id for r in found.repetitive().collect()} == set(range(45, 50))
    assert set(found.cutoffs.values()) == {found.cutoffs["en"]} and 0.15 < found.cutoffs["en"] < 0.4
    report = {r.label: r for r in found.report().collect()}
    assert report["ordinary"].upper_bound <= repetition.RISK and report["repetitive"].rejected == report["repetitive"].texts > 500
    monkeypatch.setattr(repetition, "CUTOFFS", (0.6, 0.58))
    assert repetition.Repetition(df, holdout=3000).repetitive().collect() == []
    assert repetition.Repetition(df.limit(2), holdout=1).cutoffs in ({}, {"en": repetition.STRICTEST})


def test_cutoffs_come_from_every_text(spark):
    """A table of many more texts than the holdout asks for: each is planted once, and a rare language learns from all of its texts."""
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(100)), "DE-de" if i % 5 == 0 else "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = repetition.Repetition(df, holdout=100)
    assert {r.stratum: r["count"] for r in found.holdout.groupBy("stratum").count().collect()} == {"de": 600, "en": 2400}
    assert sum(r.texts for r in found.report().collect()) == 3000
    assert max(found.cutoffs.values()) < repetition.STRICTEST and set(found.cutoffs) == {"de", "en"}
    assert found.flagged().count() == 3000 and found.repetitive().collect() == []


SFT = "id string, direction string, policy_group string, messages array<struct<role: string, content: string>>, split string, component string"


def sft_rows(spark, rows):
    return spark.createDataFrame([(str(i), d, g, None if u is None else [("user", u), ("assistant", "y")], "train", "c") for i, (d, g, u) in enumerate(rows)], SFT)


def test_tied_groups_and_splits(spark):
    rows = [("a", "g1", "Hello  World"), ("a", "g2", "hello world"), ("b", "g3", "hello world"), ("a", "g2", "x"), ("a", "g4", "Ｘ"), ("a", None, "x"), ("a", "g5", None), ("a", "g6", ""), ("a", "g7", " ")]
    df = sft_rows(spark, rows)
    pairs = {tuple(r) for r in splits.group_pairs(splits.tied_groups(df)).collect()}
    assert pairs == {("g1", "g2"), ("g1", "g4"), ("g2", "g4")}
    more = df.unionByName(sft_rows(spark, [("a" if i % 3 else "b", f"h{i // 2}", f"prompt {i}") for i in range(400)]))
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], "split string, target_share double")
    got = splits.assign_splits(more, targets)
    assert got.count() == more.count() and got.filter("assigned_split IS NULL").count() == 0
    report = splits.split_report(got, targets).collect()
    assert all(r.groups_apart == 0 and abs(r.actual_share - r.target_share) < 0.03 for r in report)
    where = {r.policy_group: r.assigned_split for r in got.collect() if r.policy_group}
    assert where["g1"] == where["g2"] == where["g4"]
    assert splits.assign_splits(df.limit(0), targets).collect() == []
    assert {tuple(r) for r in splits.group_classes(splits.tied_groups(df)).collect()} == {("g1", "g1", 2), ("g2", "g1", 2), ("g4", "g1", 2)}
    null_group = got.filter("policy_group IS NULL").first()
    assert null_group.assigned_split == where["g1"]  # it shares a message with g2
    assert splits.group_pairs(splits.tied_groups(df.limit(0))).collect() == []


def test_shares_hold_in_many_shards(spark):
    """Components are dealt to shards, each with needs of its own: the shares of all rows and of every label stay near the targets."""
    rng = random.Random(8)
    rows = [("a" if rng.random() < 0.3 else "b", f"h{i // rng.randint(1, 4)}", f"prompt {i} " + "x" * (10 ** rng.randint(0, 3))) for i in range(3000)]
    df = sft_rows(spark, rows)
    targets = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], "split string, target_share double")
    labels = ["direction", splits.length_class()]
    got = splits.assign_splits(df, targets, labels, shard_components=150)
    report = splits.split_report(got, targets, labels).collect()
    assert got.count() == 3000 and all(r.groups_apart == 0 and abs(r.actual_share - r.target_share) < 0.01 and r.largest_drift < 0.03 for r in report)


def test_labels_of_many_values(spark):
    """Every value of a label column is apportioned, not only the most frequent ones, also where its rows would lie in many shards."""
    df = sft_rows(spark, [("a" if i % 3 else "b", f"h{i}", f"prompt {i}") for i in range(4000)])
    shares = {"train": 0.8, "validation": 0.1, "test": 0.1}
    targets = spark.createDataFrame(list(shares.items()), "split string, target_share double")
    value = F.col("id").cast("int") % 400
    for shard_components in (20_000, 400):
        got = splits.assign_splits(df, targets, ["direction", value], shard_components=shard_components)
        by_value = got.groupBy(value.alias("v")).pivot("assigned_split", list(shares)).count().fillna(0).collect()
        assert len(by_value) == 400 and sum((r.train, r.validation, r.test) == (8, 1, 1) for r in by_value) > 380
        report = splits.split_report(got, targets, ["direction"]).collect()
        assert all(abs(r.actual_share - r.target_share) < 0.005 and r.largest_drift < 0.03 for r in report)
        assert max(r.largest_drift for r in splits.split_report(got, targets, [value]).collect()) == max(max(abs(r[k] / 10 - x) for k, x in shares.items()) for r in by_value)
    again = splits.assign_splits(df.repartition(3), targets, ["direction", value], shard_components=400)
    assert {(r.id, r.assigned_split) for r in again.collect()} == {(r.id, r.assigned_split) for r in got.collect()}


def test_labels_that_no_two_rows_share(spark):
    """Where each row has a value of its own, the rows still have the shares of the targets; a split without a share gets none."""
    df = sft_rows(spark, [("a" if i % 3 else "b", f"h{i // 2 if i < 900 else 0}", f"prompt {i}") for i in range(1200)])
    targets = spark.createDataFrame([("train", 0.7), ("val", 0.2), ("test", 0.1), ("none", None)], "split string, target_share double")
    for shard_components in (20_000, 90):
        report = splits.split_report(splits.assign_splits(df, targets, ["direction", "id"], shard_components=shard_components), targets).collect()
        assert all(r.groups_apart == 0 and abs((r.actual_share or 0) - r.target_share) < 0.01 for r in report)


def test_cut_texts(spark):
    whole = [(i, PROSE * 2 + f"The matter was remitted to the court of Town{chr(65 + i % 26)}.", "s") for i in range(30)]
    closed = [(100 + i, PROSE + "\n\nTHE END", "s") for i in range(5)]
    cut = [(200, PROSE + "The claimant had not shown that the contr", "t"), (201, PROSE + "The appeal must be dismissed, since the…", "t"), (202, PROSE + "Since the claimant had not shown that\n\n-- loader record 7 --", "t"), (202, PROSE + "Since the claimant had not shown that\n\n-- loader record 7 --", "t"), (203, PROSE + "The parties are bound as laid down in No.", "t")]
    other = [(300, "- oak anvils\n- steel bolts\n- plain kilns", "t"), (301, None, "t"), (302, "", None), (303, PROSE + "(signed)”", "s")]
    df = docs(spark, whole + closed + cut + other)
    got = truncation.cut_texts(df)
    assert got.count() == df.count()
    assert sorted(r.doc_id for r in got.filter("cut").collect()) == [200, 201, 202, 202, 203]
    rates = {r.source: r.cut_share for r in truncation.cut_rates(got).collect()}
    assert rates["s"] == 0 and rates["t"] == pytest.approx(5 / 7) and rates["UNKNOWN"] == 0
    assert truncation.cut_texts(df.limit(0)).collect() == []


def test_closing_lines_are_distinct_rare_inside_and_never_beat_a_mark(spark):
    clause = "\n\n7. The Supplier shall keep the records of the contract as the parties agreed."
    whole = [(i, PROSE + clause * 3 + f" Held at Town{chr(65 + i % 26)}{chr(97 + i // 26)}.", "s") for i in range(60)]
    begun = [(100 + i, PROSE + f"The court of Place{chr(97 + i)} was right.\n\n7. The Suppl", "t") for i in range(3)]
    copies = [(200 + i, PROSE + "\n\nIt was for the claim", "t") for i in range(4)]
    marked = [(300, PROSE + "\n\nTHE END…", "t")]
    closed = [(400 + i, PROSE + f"It was Case{chr(97 + i)}.\n\nTHE END", "s") for i in range(5)]
    got = truncation.cut_texts(docs(spark, whole + begun + copies + marked + closed))
    assert sorted(r.doc_id for r in got.filter("cut").collect()) == [100, 101, 102, 200, 201, 202, 203, 300]


def test_trigrams_decide(spark):
    heard = "The claimant of Town{0} was heard.\n\nThe court had said so.\n\nThe record was kept as filed under no. {1}"
    ended = [(i, PROSE + heard.format(chr(97 + i), i), "s") for i in range(8)]
    blocks = [(20 + i, "\n\n".join([PROSE + "The record was kept as filed under no. 5", PROSE, "It was so.", PROSE + f"It was Case{chr(97 + i)}."]), "s") for i in range(8)]
    cut = [(100, PROSE + "The record of the matter was kept and the claimant", "t"), (101, PROSE + "The record of the matt", "t"), (102, PROSE + "As laid down in No.", "t")]
    df = docs(spark, ended + blocks + cut)
    got = {r.doc_id: r for r in truncation.cut_texts(df).collect()}
    assert [i for i, r in sorted(got.items()) if r.cut] == [100, 101, 102]
    plain = {r.doc_id for r in truncation.cut_texts(df, trigrams=False).filter("cut").collect()}
    assert plain > {100, 101, 102} and len(plain) > 10
    assert got[0].rate > got[100].rate and not got[0].stopped and got[101].evidence in ("class", "last")


def test_trigrams_count_blocks(spark):
    df = docs(spark, [(1, "One two.\n\nthree four.\n\nfive six.\n\nseven"), (2, None), (3, "")])
    assert truncation.trigram_counts(df).agg(F.sum("n"), F.sum("ends")).first()[:] == (2 + 3 + 2, 2)  # by block: the first shape of a text ends no trigram, what stands before the last break is left out


def test_names():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"p{i}" for i in range(1, 10)}
    assert {f"p{i}_found" for i in range(1, 10)} <= set(queries.QUERIES)
    assert set(queries.ORACLE) <= set(queries.QUERIES)
