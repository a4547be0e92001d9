import hashlib
import json
import random
import re
import unicodedata
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.config import NearDuplicates, Normalization, Perplexity, Rules
from corpusloom.functions import hashing, pytext
from corpusloom.functions.text import estimated_tokens, word_count
from corpusloom.operators import components, decontam, dedup, normalize, perplexity, rules, sampling, sft, shards, stats
from corpusloom.plans import accept, pipelines
from corpusloom.sources import convert, jsonl, sinks
from corpusloom.streaming import accept as stream

AGREEMENT = (
    "The parties agree that the supplier delivers the goods by the end of the month.\nPage 12 of 40\nThe buyer pays the price within thirty days after delivery has been confirmed. "
    "Either party may end this agreement in writing. Notices are sent to the address above. The law of the seat governs all disputes. Changes need the written form to be valid."
)


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")


def test_normalization_literal(spark):
    raw = "ﬁrst\r\n<p>Section&nbsp;1 &amp; 2</p>\x00\n\n\n\nEnd"
    got = normalize.normalize(texts(spark, [raw, None, "", "a&lt;b&gt;c", "x<script>y</script>z", " \t lead \n\n\n\n\n tail  "])).orderBy("doc_id").collect()
    assert got[0].text == "first\n\nSection 1 & 2\n\n\nEnd"
    assert [r.text for r in got[1:]] == ["", "", "ac", "xz", "lead\n\n\n tail"]


def test_settings_are_validated():
    for bad in (lambda: Normalization(unicode_form="X"), lambda: Normalization(max_blank_lines=-1), lambda: Rules(min_alphabetic_ratio=2), lambda: Perplexity(threshold=0), lambda: NearDuplicates(bands=7)):
        with pytest.raises(ValueError):
            bad()
    assert Rules().fingerprint() == Rules().fingerprint() != Rules(min_words=3).fingerprint()


def test_rules_literals(spark):
    phrase = "one two three four five six seven eight nine ten "
    got = rules.apply_rules(texts(spark, [AGREEMENT, phrase * 30, None, "a" * 400, AGREEMENT + "�" * 20, AGREEMENT + "!" * 12])).orderBy("doc_id").select("rules.*").collect()
    assert got[0].accepted and "Page 12" not in got[0].text and got[0].transformations == ["removed_page_or_line_markers"]
    assert got[1].reasons == ["high_repeated_10gram_ratio"]
    assert got[2].reasons == ["too_few_characters", "too_few_words", "low_alphabetic_ratio"]
    assert got[3].text == "aaa" and got[3].transformations == ["collapsed_repeated_punctuation"]
    assert not got[5].text.endswith("!!!!") and got[5].text.endswith("!!!")


WORDY = st.text(alphabet="aB1_ \n\t\xa0 \x1cé́½ẞ-", max_size=60)


@settings(max_examples=15, deadline=None)
@given(st.lists(WORDY, min_size=1, max_size=12))
def test_measures_equal_python(spark, values):
    rows = texts(spark, values).select("doc_id", word_count("text").alias("w"), estimated_tokens("text").alias("t"), rules.metrics(F.col("text"), Rules()).alias("m")).orderBy("doc_id").collect()
    for value, row in zip(values, rows):
        words = re.findall(r"\b\w+\b", value)
        grams = [tuple(w.lower() for w in words[i : i + 10]) for i in range(len(words) - 9)]
        inked = [c for c in value if not c.isspace()]
        assert row.w == len(value.split()) and row.t == int(len(value.split()) * 1.3)
        assert row.m.word_count == len(words) and row.m.character_count == len(value)
        assert row.m.alphabetic_ratio == pytest.approx(sum(c.isalpha() for c in value) / len(inked) if inked else 0)
        assert row.m.repeated_ngram_ratio == pytest.approx((len(grams) - len(set(grams))) / len(grams) if grams else 0)


def test_hashing_equals_python(spark):
    row = spark.range(1).select(
        hashing.stable_id(F.lit("c"), F.lit("f.jsonl"), F.lit(7)).alias("id"), hashing.priority(42, F.lit("x")).alias("p"), hashing.hash_bucket(hashing.priority(42, F.lit("x")), 100).alias("b")
    ).first()
    digest = hashlib.sha256(b"42\0x").hexdigest()
    assert row.id == "sha256:" + hashlib.sha256(b"c\0f.jsonl\x007").hexdigest() and row.p == digest and row.b == int(digest[:16], 16) % 100
    rows = spark.range(2000)
    small, large = ({r.id for r in rows.filter(hashing.sampled(1, "c", F.lit("f"), F.col("id"), p)).collect()} for p in (0.1, 0.3))
    assert small < large and 140 < len(small) < 260
    assert rows.filter(hashing.sampled(1, "c", F.lit("f"), F.col("id"), 1.0)).count() == 2000


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(45)] + [(f"c{i}", f"c{i + 1}") for i in range(30)] + [(None, "z"), ("y", "y")]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else find(parent[x])

    for a, b in edges:
        if a and b and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a string, b string"), spark.createDataFrame([("y",), ("q",)], "n string")).collect()}
    assert got == {x: find(x) for x in parent} | {"y": "y", "q": "q"}
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).collect() == []


def shingles(text, config):
    """Word n-grams as the reference method has them."""
    words = re.findall(r"\w+", text.casefold())
    if len(words) < config.min_words:
        return set()
    return {tuple(words[i : i + config.ngram_size]) for i in range(max(1, len(words) - config.ngram_size + 1))}


def share(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="aBc_ ßΣ.1é\n", max_size=80), max_size=8))
def test_shingle_sets_equal_python(values):
    config = NearDuplicates(ngram_size=3, min_words=2)
    found, edges = dedup.shingle_sets(pa.array(values, pa.string()), config)
    sets = [shingles(t, config) for t in values]
    assert [len(s) for s in sets] == np.diff(edges).tolist()
    mine = [set(found[a:b].tolist()) for a, b in zip(edges, edges[1:])]
    assert all(share(mine[i], mine[j]) == share(sets[i], sets[j]) for i in range(len(values)) for j in range(i))


def test_signatures_estimate_the_similarity():
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    config = NearDuplicates(num_permutations=1024, bands=32)
    texts = [" ".join(words), " ".join(words[:300] + [f"x{i}" for i in range(100)])]
    found, edges = dedup.shingle_sets(pa.array(texts), config)
    sig = dedup.signatures(found, edges, config)
    assert abs((sig[0] == sig[1]).mean() - share(*(shingles(t, config) for t in texts))) < 0.05
    assert (dedup.signatures(found[:0], np.zeros(2, int), config) == 2**64 - 1).all()


def test_deduplication_equals_all_pairs(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(12)]
    rows = [b for b in base] + [b + " tail" for b in base[:6]] + [base[0].upper(), "  " + base[1], None, "", "short text"] + [base[2] + f" x{i}" for i in range(5)]
    df = texts(spark, rows)
    config = NearDuplicates(num_permutations=128, bands=32)
    got = {r.doc_id: (r.representative, r.kind) for r in dedup.deduplicate(df, config).collect()}
    sets = [shingles(pytext.canonical(t or ""), config) for t in rows]
    keys = [pytext.canonical(t or "") for t in rows]
    first = {}
    for i, k in enumerate(keys):
        first.setdefault(k, i)
    root = {i: first[keys[i]] for i in range(len(rows))}
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                alike = sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
                if alike or keys[i] == keys[j]:
                    low = min(root[i], root[j])
                    if root[i] != low or root[j] != low:
                        root[i] = root[j] = low
                        changed = True
    assert {i: r for i, (r, _) in got.items()} == root
    assert {k for _, k in got.values()} == {"kept", "exact", "near"}
    audit = {r.duplicate: r for r in dedup.match_audit(dedup.deduplicate(df, config), config).collect()}
    assert audit[18].similarity == 1.0 and audit[12].kind == "near" and audit[12].similarity >= 0.8
    assert dedup.deduplicate(df.limit(0), config).collect() == []


def test_large_buckets_lose_no_link(spark):
    rng = random.Random(5)
    core, ring = [f"c{i}" for i in range(60)], [f"w{i}" for i in range(240)] * 2
    rows = [" ".join(core + ring[12 * (i % 20) : 12 * (i % 20) + 140] + [f"t{i}"]) for i in range(80)]
    rows += [" ".join(core + rng.choices(ring, k=140)) for _ in range(10)]
    keep = NearDuplicates(num_permutations=1, bands=1)
    sets = [shingles(t, keep) for t in rows]
    seeded = (NearDuplicates(num_permutations=1, bands=1, seed=s) for s in range(1000))
    found, edges = dedup.shingle_sets(pa.array(rows), keep)
    config = next(c for c in seeded if len(set(dedup.signatures(found, edges, c)[:, 0].tolist())) == 1)
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    got = {r.doc_id: r.representative for r in dedup.deduplicate(texts(spark, rows), config).collect()}
    assert len(rows) > dedup.PAIRED and [got[i] for i in range(len(rows))] == root


def test_recall_against_brute_force_and_few_rounds_on_boilerplate(spark):
    rng = random.Random(11)
    boiler = [f"b{i}" for i in range(70)]
    rows = []
    for _ in range(150):  # half of each text is the same boilerplate; every second one has an edited copy
        own = [f"o{rng.randrange(10**6)}" for _ in range(80)]
        rows.append(" ".join(boiler + own))
        edited = own[:]
        edited[rng.randrange(80)] = "edited"
        rows.append(" ".join(boiler + edited))
    config = NearDuplicates()
    sets = [shingles(t, config) for t in rows]
    true = {(i, j) for i in range(len(rows)) for j in range(i) if share(sets[i], sets[j]) >= 0.8}
    edges = dedup.near_duplicate_edges(texts(spark, rows), config, "doc_id").collect()
    found = {(r.ordinal, r.other) for r in edges}
    assert found <= true and len(found) >= 0.95 * len(true) and len(true) == 150
    half = NearDuplicates(similarity_threshold=0.5, num_permutations=240, bands=60)
    mixed = [" ".join(own.split()[: 80 + i % 40] + [f"z{i}_{k}" for k in range(40 - i % 40)]) for i, own in enumerate(rows[:80])]
    sets = [shingles(t, half) for t in rows[:80] + mixed]
    true = {(i, j) for i in range(160) for j in range(i) if share(sets[i], sets[j]) >= 0.5}
    got = {r.doc_id: r.representative for r in dedup.deduplicate(texts(spark, rows[:80] + mixed), half).collect()}
    assert sum(got[i] == got[j] for i, j in true) >= 0.95 * len(true)


def test_cluster_ids_and_unverified_buckets(spark):
    body = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, "a", body), (2, " ", body + " tail"), (3, None, body.upper()), (4, None, "Other text")], "doc_id long, id string, text string")
    rows = {r.doc_id: r for r in dedup.deduplicate(df, record_id="id").collect()}
    digest = lambda x: "sha256:" + hashlib.sha256(x.encode()).hexdigest()
    assert {i: r.kind for i, r in rows.items()} == {1: "kept", 2: "near", 3: "exact", 4: "kept"}
    assert {rows[i].dedup_cluster_id for i in (1, 2, 3)} == {digest("a")} and rows[4].dedup_cluster_id == digest(digest("other text"))
    loose = NearDuplicates(num_permutations=240, bands=60, verify=False)
    assert {r.doc_id: r.representative for r in dedup.deduplicate(df, loose).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_allocation():
    weights = {("a", "x"): 5, ("b", "y"): 3, ("c", "z"): 1}
    assert sampling.largest_remainder(10, weights) == {("a", "x"): 6, ("b", "y"): 3, ("c", "z"): 1}
    assert sum(sampling.largest_remainder(4_500_000_000, {("a", str(i)): 7**i for i in range(11)}).values()) == 4_500_000_000
    assert sampling.largest_remainder(0, weights) == dict.fromkeys(weights, 0) and sampling.corpus_targets(5, 0.5) == (2, 3)
    adjusted, received = sampling.redistribute({("a",): 10, ("b",): 10, ("c",): 10}, {("a",): 4, ("b",): 12, ("c",): 99})
    assert adjusted == {("a",): 4, ("b",): 12, ("c",): 14} and received[("c",)] == 4
    with pytest.raises(ValueError):
        sampling.redistribute({("a",): 10}, {("a",): 4})
    with pytest.raises(ValueError):
        sampling.check_overshoot({"a": 102}, {"a": 100}, 0.01)


def test_prefix_sums_do_not_depend_on_slices(spark):
    df = spark.createDataFrame([(f"g{i % 3}" if i % 7 else None, i, i % 5 or None) for i in range(200)], "g string, o long, n long")
    results = [{(r.g, r.o): r.before for r in sampling.prefix_sums(df, ["o"], "n", groups=["g"], slices=k).collect()} for k in (1, 9)]
    assert results[0] == results[1]
    sums = {}
    for g, o, n in sorted(((r.g, r.o, r.n) for r in df.collect()), key=lambda x: x[1]):
        assert results[0][g, o] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + (n or 0)
    with pytest.raises(ValueError):
        sampling.budget_prefix(df, ["o"], "n", 10_000)


def fold(tokens, target):
    """Next-fit as a loop."""
    shard, held, out = -1, None, []
    for t in tokens:
        if held is None or (held > 0 and held + t > target):
            shard, held = shard + 1, 0
        held += t
        out.append(shard)
    return out


@pytest.mark.parametrize("tokens,target", [([(i * 7) % 13 for i in range(300)], 20), ([0, 0, 30, 5, 8, 3, 0, 9, 90, 0, 1, 0], 10), ([0, 0, 0], 5), ([3] * 40, 1), ([1] * 100 + [500] + [4] * 60, 16)])
def test_next_fit_equals_the_fold_over_many_slices(spark, tokens, target):
    df = spark.createDataFrame([(i, t or None) for i, t in enumerate(tokens)], "o long, n long")
    for slices in (64, 2, 1):
        got = [r.shard for r in shards.assign_shards(df, ["o"], "n", target, slices).orderBy("o").collect()]
        assert got == fold(tokens, target)
    assert shards.assign_shards(df.limit(0), ["o"], "n", target).collect() == []


def test_perplexity(spark, tmp_path):
    arpa = tmp_path / "m.arpa"
    arpa.write_text("\\data\\\n\n\\1-grams:\n-1.0\t<unk>\n-1.0\ta\t-0.5\n-1.0\t<s>\t-0.25\n-1.0\t</s>\n\n\\2-grams:\n-0.25\ta a\n\n\\end\\\n")
    model = perplexity.ArpaModel(str(arpa))
    assert model.score("a a") == pytest.approx(-0.25 - 1.0 - 0.25 - 0.5 - 1.0)
    got = perplexity.with_perplexity(texts(spark, ["a a", "b " * 5, None]), lambda: perplexity.ArpaModel(str(arpa)), "t", Perplexity(threshold=9.0)).orderBy("doc_id").select("scored.*").collect()
    assert got[0].token_count == 3 and got[0].perplexity == pytest.approx(10.0) and got[0].reason == "perplexity_above_threshold"
    assert got[2].reason == "too_few_words_for_perplexity"
    counts = {r.ngram: r.occurrences for r in perplexity.ngram_counts(texts(spark, ["A b a b", None]), 2).collect()}
    assert counts == {"<s> a": 1, "a b": 2, "b a": 1, "b </s>": 1, "<s> </s>": 1}


def test_statistics(spark):
    df = spark.createDataFrame([("a", "x", "one two"), ("a", None, "é"), ("b", "x", None)], "k string, j string, text string")
    rows = {(r.k, r.j, r.level): r for r in stats.grouping_set_stats(df, [["k"], ["k", "j"], []]).collect()}
    assert rows["a", None, 1].words == 3 and rows["a", None, 2].text_bytes == 2 and rows[None, None, 0].estimated_tokens == 3
    assert stats.grouped_stats(df.limit(0), ["k"]).collect() == []


def test_pairs(spark):
    block = "<|begin_odrl|> {\"uid\": \"u\", \"b\": 1} <|end_odrl|><|begin_rcir|>x<|end_rcir|>"
    got = sft.policy_pairs(spark.createDataFrame([("i", "text", block)], "instruction string, input string, output string"), "text2odrl", "Do it.").first()
    assert got.policy_uid == "u" and got.policy_group == hashlib.sha256(b'{"b": 1}').hexdigest() and got.messages[0].content == "Do it.\n\ntext"
    for bad in ("<|begin_odrl|> <|end_odrl|>", "", block + block):
        with pytest.raises(Exception):
            sft.policy_pairs(spark.createDataFrame([("i", "text", bad)], "instruction string, input string, output string"), "text2odrl", "Do it.").collect()
    message = [{"content": 'q "é"\n', "role": "user"}, {"content": "a", "role": "assistant"}]
    made = spark.createDataFrame([(message,)], "messages array<struct<role: string, content: string>>").select(sft.pair_id()).first()[0]
    assert made == hashlib.sha256(json.dumps(message, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def test_splits_do_not_depend_on_order(spark):
    rows = [("d", f"g{i:02d}", [("user", f"p{max(i, 1)}"), ("assistant", "a")]) for i in range(30)]
    schema = "direction string, policy_group string, messages array<struct<role: string, content: string>>"
    made = []
    for data in (rows, rows[::-1]):
        groups = sft.group_of_prompts(spark.createDataFrame(data, schema))
        assert {r.component for r in groups.filter("node IN ('g00', 'g01')").collect()} == {"g00"}
        made.append({tuple(r) for r in sft.assign_group_splits(groups, 42, 0.1, 0.1).collect()})
    assert made[0] == made[1]
    with pytest.raises(ValueError):
        sft.check_leakage(spark.createDataFrame([("g", "train"), ("g", "test")], "group_id string, split string"))


def test_preferred_copies_and_precedence(spark):
    df = spark.createDataFrame([(1, "c", 5), (2, "c", 3), (3, "c", 3), (4, "d", 9)], "id long, cluster string, badness long")
    assert {r.id for r in dedup.preferred_copies(df, "cluster", ["badness"], "id").collect()} == {2, 4}
    pairs = spark.createDataFrame([(i, s, [("user", "q"), ("assistant", "a" if i < 3 else "b")]) for i, s in enumerate(["web", "gold", "gold", "other"])], "id long, source string, messages array<struct<role: string, content: string>>")
    assert {r.id for r in sft.by_precedence(pairs, ["gold", "web"]).collect()} == {1, 3}


def test_chat_forms(spark):
    schema = "turns array<struct<role: string, content: string>>"
    rows = [([("Human", "q"), ("gpt", "a")],), ([("user", "q")],), ([("assistant", "a"), ("user", "q")],), ([("user", " "), ("assistant", "a")],), ([],), (None,)]
    got = spark.createDataFrame(rows, schema).select(sft.valid_conversation(sft.canonical_chat("turns")).alias("ok")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, False]
    quiz = spark.createDataFrame([("Q?", ["x", "y"])], "q string, c array<string>").select(sft.multiple_choice_prompt("q", "c")).first()[0]
    assert quiz == "Q?\nA. x\nB. y\nAnswer:"
    tasks = spark.createDataFrame([("cuad_a",), ("hearsay",), (None,)], "task_name string")
    assert {r.task_name for r in sft.without_tasks(tasks, ["cuad_*"]).collect()} == {"hearsay", None}


def test_contamination(spark):
    evaluation = spark.createDataFrame([("e1", AGREEMENT), ("e2", "Short one, here!"), ("e3", "")], "id string, text string")
    train = spark.createDataFrame([("t1", AGREEMENT.upper()), ("t2", "short one here"), ("t3", AGREEMENT + " And one more."), ("t4", "clean"), ("t5", None)], "id string, text string")
    found = decontam.contamination(train, evaluation)
    assert {(r.id, r.evaluation_id, r.kind) for r in found.collect()} == {("t1", "e1", "exact"), ("t2", "e2", "punctuation"), ("t3", "e1", "near")}
    assert {r.id for r in decontam.decontaminated(train, found).collect()} == {"t4", "t5"}


def test_lines_are_numbered_and_judged(spark, tmp_path):
    lines = ['{"text": "a", "type": ""}', "", "[1]", "{bad", '{"text": "b"} x', '{"text": "c", "text_type": "t"}']
    (tmp_path / "b.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps({"text": f"row {i}", "pad": "y" * 90}) for i in range(4000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        parsed = jsonl.parsed_lines(jsonl.numbered_lines(spark, str(tmp_path)), jsonl.LEGAL)
        rows = parsed.filter("source_file = 'b.jsonl'").orderBy("source_row").collect()
        assert [r.source_row for r in rows] == [1, 2, 3, 4, 5, 6] and [r.error is None for r in rows] == [True, False, False, False, False, True]
        numbered = parsed.filter("source_file = 'a.jsonl'").select("source_row", "record.text").collect()
        assert len(numbered) == 4000 and all(r.text == f"row {r.source_row - 1}" for r in numbered)
        assert [(r.type, r.source) for r in jsonl.legal_records(parsed, "c").filter("source_file = 'b.jsonl'").orderBy("source_row").collect()] == [("UNKNOWN", "UNKNOWN"), ("t", "UNKNOWN")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_build(spark, tmp_path):
    legal, replay = tmp_path / "legal", tmp_path / "replay"
    legal.mkdir(), replay.mkdir()
    rng = random.Random(4)
    body = lambda: " ".join(f"word{rng.randrange(900)}" for _ in range(60))
    shared = body()
    (legal / "x.jsonl").write_text("\n".join(json.dumps({"text": t, "type": "caselaw", "jurisdiction": "US"}) for t in [shared, "tiny", *(body() for _ in range(20))]))
    (replay / "y.jsonl").write_text("\n".join(json.dumps({"text": t, "meta": {"redpajama_set_name": "web"}}) for t in [shared.upper(), *(body() for _ in range(10))]))
    out = str(tmp_path / "out")
    manifest = pipelines.build_corpus(spark, str(legal), str(replay), out, pipelines.Build(shard_tokens=400))
    counters = {r["corpus"]: r for r in manifest["counters"]}
    assert counters["legal"]["rule_rejections"] == 1 and counters["replay"]["exact_duplicates"] == 1
    rows = [json.loads(line) for s in manifest["shards"] for line in open(f"{out}/{s['file']}", encoding="utf-8")]
    assert len(rows) == 31 and len({r["id"] for r in rows}) == 31
    for s in manifest["shards"]:
        assert hashlib.sha256(open(f"{out}/{s['file']}", "rb").read()).hexdigest() == s["sha256"]
    with pytest.raises(FileExistsError):
        pipelines.build_corpus(spark, str(legal), None, out)


def test_build_with_a_model_limits_and_resume(spark, tmp_path, monkeypatch):
    legal = tmp_path / "legal"
    legal.mkdir()
    rng = random.Random(4)
    body = lambda: " ".join(f"word{rng.randrange(900)}" for _ in range(60))
    odd = " ".join(["zzz"] * 5 + [f"qq{i}" for i in range(60)])
    lines = [json.dumps({"text": t, "type": "caselaw", "jurisdiction": "US"}) for t in [*(body() for _ in range(8)), odd, "tiny"]]
    (legal / "x.jsonl").write_text("\n".join([*lines, "{broken", *lines[:3]]))
    model = tmp_path / "m.arpa"
    arpa = perplexity.estimated_arpa(texts(spark, [json.loads(x)["text"] for x in lines[:8]]))
    model.write_text("\n".join(arpa))
    config = pipelines.Build(model_path=str(model), perplexity_threshold=300.0, keep_work=True)
    out = str(tmp_path / "out")
    monkeypatch.setattr(pipelines, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        pipelines.build_corpus(spark, str(legal), None, out, config)
    monkeypatch.undo()
    monkeypatch.setattr(pipelines, "accept_all", lambda *a, **k: (_ for _ in ()).throw(AssertionError("the stage is there")))
    manifest = pipelines.build_corpus(spark, str(legal), None, out, config)
    monkeypatch.undo()
    counters = manifest["counters"][0]
    assert (counters["input_rows"], counters["accepted_rows"], counters["perplexity_rejections"], counters["rule_rejections"], counters["exact_duplicates"]) == (13, 8, 1, 1, 3)
    assert manifest["scanned_rows"] == {"legal": 14} and manifest["inputs"]["legal"][0]["invalid_rows"] == 1
    assert manifest["inputs"]["legal"][0]["sha256"] == hashlib.sha256((legal / "x.jsonl").read_bytes()).hexdigest()
    audit = [json.loads(x) for f in (tmp_path / "out" / "rejected").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(r["stage"] for r in audit) == ["exact_deduplication"] * 3 + ["perplexity", "rules"] and all("text" not in r for r in audit)
    few = pipelines.build_corpus(spark, str(legal), None, str(tmp_path / "few"), pipelines.Build(max_legal_rows=3))
    assert few["documents"] == 3 and not (tmp_path / "few.work").exists()
    with pytest.raises(ValueError):
        perplexity.scorer_of()
    with pytest.raises(FileNotFoundError):
        perplexity.load_model(str(tmp_path / "none"))
    assert perplexity.normalized_perplexity("word1 word2", perplexity.load_model(str(model))) > 1


def test_corpus_statistics_go_on_after_a_stop(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"f{k}.jsonl").write_text("\n".join([json.dumps({"text": "one two", "type": "t", "jurisdiction": "US"}), json.dumps({"text": None, "type": ""}), "bad"]))
    out = str(tmp_path / "out")
    first = pipelines.corpus_statistics(spark, str(tmp_path / "*.jsonl"), out, files_at_once=2)
    want = {"documents": 6, "words": 6, "bad_json": 3, "missing_text": 3, "missing_type": 3, "missing_jurisdiction": 3, "missing_source": 6, "estimated_tokens": 7}
    assert {k: first[k] for k in want} == want
    staged = next((tmp_path / "out" / ".partial" / "00000").glob("*.parquet")).stat().st_mtime_ns
    again = pipelines.corpus_statistics(spark, str(tmp_path / "*.jsonl"), out, files_at_once=2)
    assert {k: again[k] for k in want} == want and next((tmp_path / "out" / ".partial" / "00000").glob("*.parquet")).stat().st_mtime_ns == staged
    with pytest.raises(FileNotFoundError):
        pipelines.corpus_statistics(spark, str(tmp_path / "*.none"), out)


def test_pairs_from_tables(spark, tmp_path):
    rows = [("do", f"text {i}", f'<|begin_odrl|>{{"uid": "u{i}", "n": {i // 2}}}<|end_odrl|><|begin_rcir|>x<|end_rcir|>') for i in range(40)]
    spark.createDataFrame(rows, "instruction string, input string, output string").coalesce(1).write.parquet(str(tmp_path / "train"))
    manifest = pipelines.prepare_pairs_from(spark, {"text2odrl": {"train": str(tmp_path / "train")}}, {"text2odrl": "Turn it."}, str(tmp_path / "out"))
    counts = {r["split"]: (r["rows"], r["groups"]) for r in manifest["counts"]}
    assert sum(n for n, _ in counts.values()) == 40 and counts["validation"][1] == counts["test"][1] == 2
    assert len(json.loads((tmp_path / "out" / "inputs.json").read_text())["text2odrl"]["train"]) == 1


def test_sequences_masks_pools_and_chats(spark):
    rows = spark.createDataFrame([(0, 5), (1, 0), (2, 12), (3, None)], "o long, n long")
    got = [(r.o, r.sequence, r.first_token, r.tokens) for r in shards.packed_sequences(rows, ["o"], "n", 8).orderBy("o", "sequence").collect()]
    assert got == [(0, 0, 0, 6), (1, 0, 0, 1), (2, 0, 0, 1), (2, 1, 1, 8), (2, 2, 9, 4), (3, 2, 0, 1)]
    pairs = spark.createDataFrame([([("user", "ab"), ("assistant", "c")],)], "messages array<struct<role: string, content: string>>")
    masked = sft.loss_masked(pairs, lambda t: [ord(c) for c in t], 8, end=0).first()
    assert masked.input_ids == [97, 98, 99, 0] and masked.labels == [-100, -100, 99, 0]
    with pytest.raises(Exception):
        sft.loss_masked(pairs, lambda t: [1] * 9, 8).collect()
    pool = spark.createDataFrame([(str(i), "a" if i < 60 else "b", f"s{i % 3}") for i in range(100)], "id string, pool string, subset string")
    drawn = sft.pool_sample(pool, 20, ["subset"], {"a": 0.5, "b": 0.5})
    assert {(r.pool, r["count"]) for r in drawn.groupBy("pool").count().collect()} == {("a", 10), ("b", 10)} and drawn.select("id").distinct().count() == 20
    with pytest.raises(ValueError):
        sft.pool_sample(pool, 200, ["subset"], {"a": 0.5, "b": 0.5})
    talk = spark.createDataFrame([([("human", "q"), ("gpt", "a")],)], "conversations array<struct<from: string, value: string>>")
    assert [tuple(m) for m in sft.chat_rows(talk, "conversations").first().messages] == [("user", "q"), ("assistant", "a")]
    ask = spark.createDataFrame([("i", "p", "a")], "instruction string, prompt string, answer string")
    assert [tuple(m) for m in sft.chat_rows(ask, "instruction_prompt").first().messages] == [("user", "i\n\np"), ("assistant", "a")]
    quiz = spark.createDataFrame([("Q?", [str(i) for i in range(27)])], "q string, c array<string>")
    with pytest.raises(Exception):
        quiz.select(sft.multiple_choice_prompt("q", "c")).collect()
    held = sft.grouped_holdout(spark.createDataFrame([(f"g{i}", f"g{i}") for i in range(50)], "node string, component string"), 1, 0.01, 3, 5)
    assert held.filter("held_out").count() == 3 and held.count() == 50


def test_samples_gates_and_arrow_tables(spark, tmp_path):
    import pyarrow.ipc

    table = pa.table({"text": ["a", "b"], "n": [1, 2]})
    (tmp_path / "set").mkdir()
    with pyarrow.ipc.new_stream(str(tmp_path / "set" / "data-00000.arrow"), table.schema) as sink:
        sink.write_table(table)
    assert [tuple(r) for r in convert.read_rows(spark, str(tmp_path / "set")).orderBy("n").collect()] == [("a", 1), ("b", 2)]
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps({"text": f"text {i}"}) for i in range(5)))
    records = jsonl.legal_records(jsonl.parsed_lines(jsonl.numbered_lines(spark, str(tmp_path / "x.jsonl")), jsonl.LEGAL), "c")
    assert [(r.id, r.text) for r in jsonl.sample_rows(records, 2, 4).orderBy("id").collect()] == [("sample-1", "text"), ("sample-2", "text")]
    with pytest.raises(ValueError):
        sinks.check_gates(records, {"short": F.length("text") < 6})
    assert sinks.check_gates(records, {"short": F.length("text") < 7}) is records


def test_convert_and_sinks(spark, tmp_path):
    texts(spark, ["a", None]).withColumn("drop", F.lit(1)).write.parquet(str(tmp_path / "in"))
    written, preview = convert.convert(spark, str(tmp_path / "in"), str(tmp_path / "out"), drop=["drop"], preview=1)
    assert written == 2 and set(preview[0]) == {"doc_id", "text"}
    with pytest.raises(ValueError):
        convert.require_columns(texts(spark, []), ["nope"])
    quiz = spark.createDataFrame([("q", "law", ["x", "y"], 1)], "question string, subject string, choices array<string>, answer int")
    assert convert.multiple_choice_rows(quiz, "law").first().label == "B"
    with pytest.raises(Exception):
        convert.multiple_choice_rows(quiz, "art").collect()
    staged = sinks.stage(texts(spark, ["a"]), str(tmp_path / "s"), "f1")
    assert sinks.stage(texts(spark, ["a", "b"]), str(tmp_path / "s"), "f1").count() == staged.count() == 1
    assert sinks.stage(texts(spark, ["a", "b"]), str(tmp_path / "s"), "f2").count() == 2


def test_stream_accepts_each_text_once(spark, tmp_path):
    rows = [("c", "f", i, "t", "j", "s", AGREEMENT if i % 2 else AGREEMENT + f" Item {i}.", datetime(2024, 1, 1 + i)) for i in range(6)] + [("c", "f", 9, "t", "j", "s", "tiny", datetime(2024, 1, 2))]
    schema = "corpus string, source_file string, source_row long, type string, jurisdiction string, source string, text string, loaded_at timestamp"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    stream.run_available(stream.accepted_stream(source).select("id", "text", "loaded_at"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_canonical_text():
    assert pytext.canonical(" Straße  ＡＢ\n") == "strasse ab" and pytext.canonical("ς") == pytext.canonical("Σ")
    assert pytext.without_controls("a\u0085b​\n\t") == "ab\n\t"
    assert unicodedata.normalize("NFKC", "ﬁ") == pytext.decoded("ﬁ", True, True, "NFKC", True)


def test_accept_path(spark):
    rows = [("c", "f", i, "t", "j", "s", t, (0, i)) for i, t in enumerate([AGREEMENT, AGREEMENT.lower(), "tiny", None])]
    df = spark.createDataFrame(rows, "corpus string, source_file string, source_row long, type string, jurisdiction string, source string, text string, ordinal struct<a: long, b: long>")
    done = accept.without_exact_copies(accept.prepared(df))
    assert [r.source_row for r in accept.accepted(done).collect()] == [0]
    assert {(r.source_row, r.stage) for r in accept.rejected(done).collect()} == {(1, "exact_deduplication"), (2, "rules"), (3, "rules")}
    counters = accept.stage_counters(done).first()
    assert (counters.input_rows, counters.accepted_rows, counters.rule_rejections, counters.exact_duplicates) == (4, 1, 2, 1)
