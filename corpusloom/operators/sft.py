"""Instruction-tuning pairs: extraction, fingerprints, grouped splits, dedup, views, audits."""

from __future__ import annotations

import string
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import sha
from corpusloom.functions.pytext import canonical_text, sorted_json
from corpusloom.operators.components import connected_components
from corpusloom.session import arrow_function

# Marks of a chat template that no message may hold.
DELIMITERS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>")
# Roles by the names of other chat formats.
ROLES = {"human": "user", "gpt": "assistant"}
HELD_OUT = ("validation", "test")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tagged_block(c: Column | str, name: str) -> Column:
    """The content of the one block between begin and end mark; fails if it is missing, blank or not the only one."""
    found = F.regexp_extract_all(_col(c), F.lit(rf"(?s)<\|begin_{name}\|>(.*?)<\|end_{name}\|>"), F.lit(1))
    inner = F.regexp_replace(F.get(found, 0), r"\A\s+|\s+\z", "")
    return F.when((F.size(found) == 1) & (inner != ""), inner).otherwise(F.raise_error(F.lit(f"exactly one {name} block with content is needed")))


def required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The table; a row whose columns ``names`` are not all filled fails the job."""
    ok = F.lit(True)
    for n in names:
        ok = ok & F.coalesce(F.regexp_replace(n, r"\s+", "") != "", F.lit(False))
    first = names[0]
    return df.withColumn(first, F.when(ok, F.col(first)).otherwise(F.raise_error(F.lit(f"blank or missing field among {', '.join(names)}"))))


def without_delimiters(df: DataFrame, messages: str = "messages") -> DataFrame:
    """The table; a row with a chat mark in a message fails the job."""
    bad = F.exists(messages, lambda m: F.coalesce(m.content.contains(DELIMITERS[0]) | m.content.contains(DELIMITERS[1]) | m.content.contains(DELIMITERS[2]), F.lit(False)))
    return df.withColumn(messages, F.when(bad, F.raise_error(F.lit("a message holds a chat delimiter"))).otherwise(F.col(messages)))


def chat(user: Column, assistant: Column) -> Column:
    """Messages of one exchange."""
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("user", user), turn("assistant", assistant))


def policy_fingerprint(spark, policy: Column | str) -> Column:
    """SHA-256 of a policy's canonical JSON without its top-level uid; null where it is no JSON."""
    return F.sha2(sorted_json(spark, policy, without="uid"), 256)


def policy_pairs(df: DataFrame, direction: str, instruction: str, structured: bool = True) -> DataFrame:
    """``policy_uid``, ``policy_group`` and ``messages`` from ``instruction``, ``input`` and ``output``.

    ``text2odrl``: the policy stands in the output's odrl block, an rcir block must be there.
    ``odrl2text``: the policy stands in the input's odrl block, an nlir block must be there and the
    answer is the summary block. ``structured`` keeps input and output as they are.
    """
    spark = df.sparkSession
    rows = required(df, ["instruction", "input", "output"])
    if direction == "text2odrl":
        rows = rows.withColumns({"__policy": tagged_block("output", "odrl"), "__check": tagged_block("output", "rcir")})
        answer = sorted_json(spark, "__policy")
    elif direction == "odrl2text":
        rows = rows.withColumns({"__policy": tagged_block("input", "odrl"), "__check": tagged_block("output", "nlir")})
        answer = tagged_block("output", "summary")
    else:
        raise ValueError(f"unknown direction {direction}")
    question = F.col("input") if structured or direction == "text2odrl" else sorted_json(spark, "__policy")
    rows = rows.withColumns({
        "direction": F.lit(direction),
        "policy_uid": F.get_json_object("__policy", "$.uid"),
        "policy_group": policy_fingerprint(spark, "__policy"),
        "messages": chat(F.concat(F.lit(instruction + "\n\n"), question), F.col("output") if structured else answer),
    })
    return without_delimiters(rows.filter("__check IS NOT NULL").drop("__policy", "__check"))


def prompt_text(messages: str = "messages") -> Column:
    """The first user message."""
    return F.get(F.filter(messages, lambda m: m.role == "user"), 0)["content"]


def group_of_prompts(df: DataFrame) -> DataFrame:
    """``node`` and ``component``: policy groups tied by equal prompts of a direction, named by the least group."""
    prompts = df.select("policy_group", F.col("direction"), canonical_text(df.sparkSession, prompt_text()).alias("prompt")).filter("policy_group IS NOT NULL AND prompt IS NOT NULL").distinct()
    least = prompts.groupBy("direction", "prompt").agg(F.min("policy_group").alias("least"))
    return connected_components(prompts.join(least, ["direction", "prompt"]).select("policy_group", "least"), df.select("policy_group"))


def assign_group_splits(components: DataFrame, seed: int, validation: float, test: float) -> DataFrame:
    """``group_id`` and ``split``: roots in a seeded order, the first to validation, the next to test, the rest to train.

    Sizes are rounded half to even; a split that stays empty fails. The roots are ranked by slices.
    """
    from corpusloom.operators.sampling import prefix_sums

    roots = components.select(F.col("component").alias("group_id")).distinct()
    n = roots.count()
    first, second = round(n * validation), round(n * test)
    if min(first, second, n - first - second) < 1:
        raise ValueError("a split would be empty")
    ordered = prefix_sums(roots.withColumns({"order_hash": sha(F.lit(str(seed)), "group_id", separator=":"), "one": F.lit(1)}), ["order_hash", "group_id"], "one", "rank")
    split = F.when(F.col("rank") < first, "validation").when(F.col("rank") < first + second, "test").otherwise("train")
    return ordered.select("group_id", split.alias("split"))


def pair_id(messages: str = "messages") -> Column:
    """SHA-256 of the messages as canonical JSON."""
    escaped = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"\A\[|\]\z", "")
    parts = F.transform(messages, lambda m: F.concat(F.lit('{"content": '), escaped(m.content), F.lit(', "role": '), escaped(m.role), F.lit("}")))
    return F.sha2(F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]")), 256)


def deduplicated_pairs(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Equal message pairs of a direction once: the first row's fields, and all provenance in order."""
    rows = df.withColumn("id", pair_id())
    kept = [c for c in rows.columns if c not in ("id", "direction", "provenance")]
    first = F.min(F.struct(*order, *[c for c in kept if c not in order])).alias("f")
    places = F.sort_array(F.array_distinct(F.flatten(F.collect_list("provenance")))).alias("provenance")
    return rows.groupBy("direction", "id").agg(first, places).select("direction", "id", *[F.col(f"f.{c}").alias(c) for c in kept], "provenance")


def ordered_pairs(df: DataFrame, seed: int, joint: bool = False) -> DataFrame:
    """``order_hash`` by which a split, or the joint view, is ordered."""
    parts = [F.lit(str(seed)), F.lit("joint"), "id"] if joint else [F.lit(str(seed)), "id"]
    return df.withColumn("order_hash", sha(*parts, separator=":"))


def generation_view(df: DataFrame, order: str) -> DataFrame:
    """One row for each prompt outside train: the least id, and all different answers in row order."""
    rows = df.filter(F.col("split").isin(*HELD_OUT)).select(
        "direction", "split", "group_id", "id", F.col(order).alias("place"), prompt_text().alias("prompt"), F.get(F.filter("messages", lambda m: m.role == "assistant"), 0)["content"].alias("answer")
    )
    answers = rows.groupBy("direction", "split", "prompt", "answer").agg(F.min("place").alias("place"), F.min(F.struct("place", "id", "group_id")).alias("f"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("place", "answer"))), lambda x: x.answer)
    grouped = answers.groupBy("direction", "split", "prompt").agg(F.min("f").alias("f"), listed.alias("references"))
    user = F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")))
    return grouped.select("direction", "split", F.col("f.id").alias("id"), F.col("f.group_id").alias("group_id"), user.alias("messages"), "references")


def joint_view(df: DataFrame, seed: int) -> DataFrame:
    """Train and validation of all directions, without test, in their seeded order."""
    return ordered_pairs(df.filter(F.col("split").isin("train", "validation")), seed, joint=True)


def groups_apart(df: DataFrame, group: str = "group_id", split: str = "split") -> DataFrame:
    """Groups that lie in several splits."""
    return df.groupBy(group).agg(F.count_distinct(split).alias("splits")).filter("splits > 1")


def check_leakage(df: DataFrame, group: str = "group_id", split: str = "split") -> None:
    """Fail if a group lies in several splits."""
    found = groups_apart(df, group, split).limit(5).collect()
    if found:
        raise ValueError(f"groups in several splits: {[r[group] for r in found]}")


def grouped_holdout(components: DataFrame, seed: int, share: float, least: int, most: int) -> DataFrame:
    """``group_id`` and whether it belongs to the validation holdout of ``share`` of the groups within bounds."""
    roots = components.select(F.col("component").alias("group_id")).distinct()
    size = min(most, max(least, round(roots.count() * share)))
    held = roots.orderBy(sha(F.lit(str(seed)), "group_id", separator=":")).limit(size)
    return roots.join(held.withColumn("held_out", F.lit(True)), "group_id", "left").fillna(False, ["held_out"])


def conflicting_prompts(df: DataFrame) -> DataFrame:
    """Prompts (by hash of the canonical text) with several different answers, for quarantine."""
    spark = df.sparkSession
    answer = F.get(F.filter("messages", lambda m: m.role == "assistant"), 0)["content"]
    rows = df.select(F.sha2(canonical_text(spark, prompt_text()), 256).alias("prompt_hash"), F.sha2(canonical_text(spark, answer), 256).alias("answer_hash"))
    return rows.groupBy("prompt_hash").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("answer_hash").alias("answers")).filter("answers > 1")


def by_precedence(df: DataFrame, precedence: Sequence[str], source: str = "source", order: str = "id") -> DataFrame:
    """Of rows with equal messages the one from the source that comes first in ``precedence``."""
    rank = F.array_position(F.array(*map(F.lit, precedence)), F.col(source))
    ranked = df.withColumns({"__pair": pair_id(), "__place": F.when(rank > 0, rank).otherwise(len(precedence) + 1)})
    best = ranked.groupBy("__pair").agg(F.min(F.struct("__place", order)).alias("b")).select("__pair", "b.*")
    return ranked.join(best, ["__pair", "__place", order], "left_semi").drop("__pair", "__place")


def canonical_chat(turns: Column | str) -> Column:
    """Turns (from/value or role/content pairs as structs role, content) with roles of one naming."""
    def named(role: Column) -> Column:
        out = F.lower(role)
        for a, b in ROLES.items():
            out = F.when(out == a, b).otherwise(out)
        return out

    return F.transform(_col(turns), lambda t: F.struct(named(t.role).alias("role"), t.content.alias("content")))


def valid_conversation(messages: Column | str) -> Column:
    """Whether user and assistant both speak, nothing is blank, and the assistant has the last word."""
    m = _col(messages)
    filled = F.forall(m, lambda t: F.coalesce(F.regexp_replace(t.content, r"\s+", "") != "", F.lit(False)))
    both = F.exists(m, lambda t: t.role == "user") & F.exists(m, lambda t: t.role == "assistant")
    return F.coalesce((F.size(m) > 0) & filled & both & (F.try_element_at(m, F.lit(-1))["role"] == "assistant"), F.lit(False))


def in_language(df: DataFrame, language: str, columns: Sequence[str]) -> DataFrame:
    """Rows all of whose language columns name the language."""
    for c in columns:
        df = df.filter(F.lower(c) == language)
    return df


def multiple_choice_prompt(question: Column | str, choices: Column | str) -> Column:
    """Question, lettered choices and the begin of an answer; a row with more choices than letters fails the job."""
    letters = F.array(*map(F.lit, string.ascii_uppercase))
    letter = lambda i: F.when(i < 26, F.get(letters, i)).otherwise(F.raise_error(F.lit("a question has more than 26 choices")))
    lines = F.transform(_col(choices), lambda c, i: F.concat(letter(i), F.lit(". "), c))
    return F.concat_ws("\n", _col(question), F.array_join(lines, "\n"), F.lit("Answer:"))


def without_tasks(df: DataFrame, patterns: Sequence[str], task: str = "task_name") -> DataFrame:
    """Rows whose task matches none of the glob selectors."""
    for p in patterns:
        like = p.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%").replace("?", "_")
        df = df.filter(F.coalesce(~F.col(task).like(like), F.lit(True)))
    return df


def evaluation_averages(df: DataFrame, task: str, label: str, predicted: str) -> DataFrame:
    """One row: micro accuracy, macro accuracy over tasks, and macro balanced accuracy."""
    hit = (F.col(label) == F.col(predicted)).cast("double")
    classes = df.groupBy(task, label).agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"))
    tasks = classes.groupBy(task).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.avg(F.col("hits") / F.col("n")).alias("balanced"))
    return tasks.agg(
        (F.sum("hits") / F.sum("n")).alias("micro_accuracy"), F.avg(F.col("hits") / F.col("n")).alias("macro_accuracy"), F.avg("balanced").alias("macro_balanced_accuracy")
    )


def pool_sample(df: DataFrame, total: int, strata: Sequence[str], mix: Mapping[str, float], pool: str = "pool", seed: int = 42, record_id: str = "id") -> DataFrame:
    """``total`` rows from pools in the shares of ``mix``, within a pool in proportion to the rows of its strata; none twice.

    Fails if a pool holds fewer rows than its share. The driver holds a number for each stratum.
    """
    from corpusloom.operators.sampling import check_capacity, largest_remainder, select_by_quota

    groups = [pool, *strata]
    counts = {tuple(r[g] for g in groups): r["n"] for r in df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = largest_remainder(total, {(k,): round(share * 10**9) for k, share in mix.items()})
    held = {(k,): sum(n for g, n in counts.items() if g[0] == k) for k in mix}
    check_capacity(wanted, held)
    quotas = {}
    for (name,), n in wanted.items():
        quotas |= largest_remainder(n, {g: x for g, x in counts.items() if g[0] == name})
    table = df.sparkSession.createDataFrame([(*g, q) for g, q in quotas.items()], ", ".join([*[f"{g} string" for g in groups], "quota long"]))
    chosen = select_by_quota(df.withColumn("__one", F.lit(1)), table, groups, "__one", seed, record_id)
    return chosen.drop("__one", "tokens_before", "priority")


#: Roles and texts of the turns of known instruction sources, by the columns they stand in; ``conversations`` holds turns of its own.
CHAT_SOURCES = {
    "conversations": (),
    "query_response": (("user", "query"), ("assistant", "response")),
    "question_answer": (("user", "question"), ("assistant", "answer")),
    "instruction_prompt": (("user", ("instruction", "prompt")), ("assistant", "answer")),
    "inputs_answer": (("user", "inputs"), ("assistant", "answer")),
}


def chat_rows(df: DataFrame, source: str) -> DataFrame:
    """The table of an instruction source with ``messages`` in the one chat form."""
    if source == "conversations":
        turns = F.transform("conversations", lambda t: F.struct(t["from"].alias("role"), t["value"].alias("content")))
    else:
        text = lambda c: F.col(c) if isinstance(c, str) else F.concat_ws("\n\n", *c)
        turns = F.array(*[F.struct(F.lit(role).alias("role"), text(c).alias("content")) for role, c in CHAT_SOURCES[source]])
    return df.withColumn("messages", canonical_chat(turns))


def loss_masked(df: DataFrame, encode: Callable[[str], list[int]], most: int, end: int | None = None, messages: str = "messages") -> DataFrame:
    """The table with ``input_ids`` and ``labels``: -100 over the prompt, the answer's own tokens and the end mark after it.

    ``encode`` is any tokenizer's function, sent to the workers. Prompt and answer are encoded
    apart, so the mask ends where the answer begins. A row above ``most`` tokens fails the job.
    """

    def mask(prompts: pa.Array, answers: pa.Array) -> pa.Array:
        rows = []
        for prompt, answer in zip(prompts.to_pylist(), answers.to_pylist()):
            a, b = encode(prompt or ""), encode(answer or "") + ([] if end is None else [end])
            if len(a) + len(b) > most:
                raise ValueError(f"a row has {len(a) + len(b)} tokens, more than {most}")
            rows.append({"input_ids": a + b, "labels": [-100] * len(a) + b})
        return pa.array(rows, pa.struct([("input_ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64()))]))

    answer = F.get(F.filter(messages, lambda m: m.role == "assistant"), 0)["content"]
    made = arrow_function(df.sparkSession, mask, "struct<input_ids: array<long>, labels: array<long>>")(prompt_text(messages), answer)
    return df.withColumn("__masked", made).select(*df.columns, "__masked.*")
