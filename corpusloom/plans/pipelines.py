"""Entry points end to end: corpus statistics, budgeted and proportional builds, pair preparation."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import BUILD_DUPLICATES, NearDuplicates, Normalization, Perplexity, Rules, Settings, ranged
from corpusloom.functions.hashing import sampled
from corpusloom.functions.text import TOKENS_PER_WORD, estimated_tokens, text_bytes, tokens_of_words, word_count
from corpusloom.operators import dedup, sampling, sft, shards, stats
from corpusloom.operators.perplexity import scorer_of
from corpusloom.plans import accept
from corpusloom.session import cut_lineage
from corpusloom.sources import jsonl, sinks

LEGAL, REPLAY = "legal", "replay"


@dataclass(frozen=True)
class Build(Settings):
    """Settings of a corpus build; the row limits and a build without a model are for trials."""

    seed: int = 42
    shard_tokens: int = ranged(100_000_000, low=1)
    near_duplicates: bool = True
    verify_candidates: bool = True
    similarity: float = ranged(0.5, above=0, high=1)
    replay_ratio: float = ranged(1.0, low=0, high=1)
    total_tokens: int | None = ranged(None, low=1)
    legal_share: float = ranged(0.9, low=0, high=1)
    oversample: float = ranged(1.5, low=1)
    tolerance: float = ranged(0.01, low=0)
    model_path: str | None = None
    perplexity_threshold: float = ranged(1500.0, above=0)
    score_replay: bool = False
    max_legal_rows: int | None = ranged(None, low=1)
    max_replay_rows: int | None = ranged(None, low=1)
    keep_work: bool = False

    def near(self) -> NearDuplicates | None:
        """Settings of near-duplicate removal, none if it is skipped."""
        if not self.near_duplicates:
            return None
        return replace(BUILD_DUPLICATES, similarity_threshold=self.similarity, verify=self.verify_candidates)


def selection(values: Sequence[str] | None, aliases: Mapping[str, str]) -> set[str] | None:
    """Comma- or blank-separated names with aliases resolved; ALL or * means no selection."""
    if not values:
        return None
    names = [n for v in values for n in v.replace(",", " ").split()] if not any(" " in a for a in aliases) else [n.strip() for v in values for n in v.split(",") if n.strip()]
    if any(n.upper() == "ALL" or n == "*" for n in names):
        return None
    return {aliases.get(n.lower(), n) for n in names}


def in_strata(records: DataFrame, types: set[str] | None, jurisdictions: set[str] | None) -> DataFrame:
    """Records of the selected types (letter case aside) and jurisdictions."""
    if types is not None:
        records = records.filter(F.lower("type").isin(*sorted(t.lower() for t in types)))
    return records if jurisdictions is None else records.filter(F.col("jurisdiction").isin(*sorted(jurisdictions)))


def corpus_statistics(spark: SparkSession, paths: str | Sequence[str], out: str, files_at_once: int = 64) -> dict:
    """Statistics by type, jurisdiction and source as CSV, and the global summary as JSON.

    Partial sums of every ``files_at_once`` files are staged in ``<out>/.partial``; a run that is
    started again with the same files goes on after those it has.
    """
    began = time.time()
    files = jsonl.discover(spark, paths)
    os.makedirs(out, exist_ok=True)
    keys, parts = ["type", "jurisdiction", "source"], []
    missing = [F.count_if(F.coalesce(F.col(f"raw_{c}"), F.lit("")) == "").alias(f"missing_{c}") for c in ("text", *keys)]
    for i in range(0, len(files), files_at_once):
        some = files[i : i + files_at_once]
        parsed = jsonl.parsed_lines(jsonl.numbered_lines(spark, some), jsonl.LEGAL)
        records = jsonl.legal_records(parsed, LEGAL, raw=True)
        summed = records.groupBy("source_file", *keys).agg(
            F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(text_bytes("text")), F.lit(0)).alias("text_bytes"), F.coalesce(F.sum(word_count("text")), F.lit(0)).alias("words"),
            F.count_if("is_bad").alias("bad_json"), *missing,
        )
        mark = hashlib.sha256(json.dumps(some).encode()).hexdigest()
        parts.append(sinks.stage(summed, f"{out}/.partial/{i // files_at_once:05d}", mark))
    partial = reduce(DataFrame.unionByName, parts)
    sums = [F.sum(c).cast("long").alias(c) for c in ("text_bytes", "words")]

    def rolled(by: list[str]) -> DataFrame:
        good = F.sum(F.col("documents") - F.col("bad_json")).alias("documents")
        return partial.groupBy(*by).agg(good, *sums).filter("documents > 0").withColumn("estimated_tokens", tokens_of_words(F.col("words")))

    sinks.write_statistics_csv(rolled(keys[:2]), f"{out}/stats_by_type_jurisdiction.csv", keys[:2])
    sinks.write_statistics_csv(rolled(keys), f"{out}/stats_by_type_jurisdiction_source.csv", keys)
    counters = ["bad_json", *[f"missing_{c}" for c in ("text", *keys)]]
    totals = partial.agg(F.coalesce(F.sum(F.col("documents") - F.col("bad_json")), F.lit(0)).alias("documents"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("text_bytes", "words", *counters)]).first().asDict()
    totals["estimated_tokens"] = int(totals["words"] * TOKENS_PER_WORD)
    seconds = time.time() - began
    summary = totals | {"files": len(files), "text_gb": totals["text_bytes"] / 1e9, "runtime_seconds": round(seconds, 3), "documents_per_second": round(totals["documents"] / max(seconds, 1e-9), 1)}
    sinks.write_json(f"{out}/global_summary.json", summary)
    return summary


def accept_all(legal: DataFrame, replay: DataFrame | None, normalization: Normalization | None = None, rules: Rules | None = None, config: Build | None = None) -> DataFrame:
    """Both corpora through the accept path, copies removed across them; the legal corpus comes first.

    With a model the legal corpus is scored, the replay corpus only if ``score_replay`` is set.
    """
    rows = legal if replay is None else legal.unionByName(replay)
    config = config or Build()
    scorer = scorer_of(path=config.model_path) if config.model_path else None
    asked = None if config.score_replay else F.col("corpus") == LEGAL
    limits = Perplexity(threshold=config.perplexity_threshold)
    return accept.without_exact_copies(accept.prepared(rows, normalization, rules, scorer, limits, asked))


def survivors(rows: DataFrame, near: NearDuplicates | None) -> DataFrame:
    """Accepted records without near duplicates, with their cluster id where one ties them to removed rows."""
    kept = accept.accepted(rows)
    if near is None:
        return kept.withColumn("dedup_cluster_id", F.lit(None).cast("string"))
    order = rows.filter("stage IS NULL").select("id", "ordinal")
    labelled = cut_lineage(dedup.deduplicate(kept.join(order, "id"), near, ordinal="ordinal", record_id="id"))
    tied = labelled.filter("kind <> 'kept'").select("representative").distinct().withColumn("__tied", F.lit(True))
    whole = labelled.filter("kind = 'kept'").join(tied, "representative", "left")
    return whole.withColumn("dedup_cluster_id", F.when(F.col("__tied"), F.col("dedup_cluster_id"))).drop("ordinal", "representative", "kind", "__tied")


def publish(final: DataFrame, out: str, config: Build, rows: DataFrame, manifest: dict, began: float) -> dict:
    """Shuffle, cut into shards, write them aside with audit, manifest and statistics, and put all in place."""
    ordered = sampling.shuffled(final, config.seed)
    placed = cut_lineage(shards.assign_shards(ordered, ["bucket_key", "priority"], "estimated_tokens", config.shard_tokens))
    columns = [*accept.ACCEPTED, "dedup_cluster_id"]
    with sinks.staged(out) as folder:
        files = shards.write_shards(placed, folder, ["bucket_key", "priority"], columns)
        by_corpus = stats.grouped_stats(final, ["corpus"]).collect()
        by_stratum = stats.grouped_stats(final, ["type", "jurisdiction"]).collect()
        total = sum(r.estimated_tokens for r in by_corpus)
        accept.rejected(rows).write.option("ignoreNullFields", "false").json(f"{folder}/rejected")
        accepted = rows.filter("stage IS NULL").count()
        manifest |= {
            "settings": asdict(config), "fingerprint": config.fingerprint(), "shards": files, "counters": [r.asDict() for r in accept.stage_counters(rows).collect()],
            "rejections": [r.asDict() for r in accept.rejection_counts(rows).orderBy("corpus", "stage", "reason").collect()],
            "documents": sum(f["documents"] for f in files), "estimated_tokens": total, "bytes": sum(f["bytes"] for f in files), "gib": sum(f["bytes"] for f in files) / (1 << 30),
            "near_deduplication": {"settings": None if config.near() is None else asdict(config.near()), "input_rows": accepted},
            "runtime_seconds": round(time.time() - began, 3),
        }
        sinks.write_json(f"{folder}/manifest.json", manifest)
        share = lambda r: r.asDict() | {"token_share": r.estimated_tokens / total if total else 0.0}
        sinks.write_json(f"{folder}/statistics.json", {"by_corpus": [share(r) for r in by_corpus], "by_type_jurisdiction": [share(r) for r in by_stratum]})
    return manifest


class Work:
    """Stages of a build beside its output; a build with equal settings and inputs goes on after those that are complete."""

    def __init__(self, out: str, config: Build, *inputs: object) -> None:
        self.folder = f"{out.rstrip('/')}.work"
        self.mark = hashlib.sha256(json.dumps([config.fingerprint(), *inputs], default=str, sort_keys=True).encode()).hexdigest()

    def stage(self, name: str, df: Callable[[], DataFrame], spark: SparkSession) -> DataFrame:
        """The stage's table, made only if it is not there."""
        folder = f"{self.folder}/{name}"
        return sinks.staged_table(spark, folder, self.mark) or sinks.stage(df(), folder, self.mark)

    def done(self, keep: bool) -> None:
        """Remove the stages once the output is in place."""
        if not keep:
            shutil.rmtree(self.folder, ignore_errors=True)


def _lines(spark: SparkSession, paths: str, limit: int | None, schema) -> DataFrame:
    return jsonl.parsed_lines(jsonl.first_rows(jsonl.numbered_lines(spark, paths), limit), schema)


def build_corpus(spark: SparkSession, legal_paths: str, replay_paths: str | None, out: str, config: Build | None = None, types: set[str] | None = None, jurisdictions: set[str] | None = None, replay_target: int | None = None) -> dict:
    """The budgeted build: selected legal records and a hash sample or token budget of the replay corpus."""
    began, config = time.time(), config or Build()
    sinks.refuse_filled(out)
    work = Work(out, config, legal_paths, replay_paths, sorted(types or ()), sorted(jurisdictions or ()), replay_target)
    parsed = {LEGAL: _lines(spark, legal_paths, config.max_legal_rows, jsonl.LEGAL)}
    if replay_paths:
        parsed[REPLAY] = _lines(spark, replay_paths, config.max_replay_rows, jsonl.REPLAY)

    def preprocessed() -> DataFrame:
        legal = in_strata(jsonl.legal_records(parsed[LEGAL], LEGAL), types, jurisdictions)
        replay = None
        if replay_paths:
            replay = jsonl.replay_records(parsed[REPLAY], REPLAY)
            replay = replay.filter(sampled(config.seed, "slimpajama", "source_file", "source_row", config.replay_ratio))
        return accept_all(legal, replay, config=config)

    rows = work.stage("preprocessed", preprocessed, spark)
    if replay_target is not None:
        still = sampling.budget_prefix(rows.filter((F.col("corpus") == REPLAY) & F.col("stage").isNull()), ["ordinal"], "estimated_tokens", replay_target)
        last = still.agg(F.max("ordinal").alias("o")).first().o
        cut = F.struct(F.lit(last.corpus_rank).alias("corpus_rank"), F.lit(last.major).cast("long").alias("major"), F.lit(last.minor).cast("long").alias("minor"))
        rows = rows.filter((F.col("corpus") != REPLAY) | (F.col("ordinal") <= cut))
    final = work.stage("survivors", lambda: survivors(rows, config.near()), spark)
    manifest = {"inputs": {k: [r.asDict() for r in jsonl.input_manifest(spark, p, parsed[k]).orderBy("path").collect()] for k, p in ((LEGAL, legal_paths), (REPLAY, replay_paths)) if p}}
    manifest["scanned_rows"] = {k: sum(f["valid_rows"] + f["invalid_rows"] for f in v) for k, v in manifest["inputs"].items()}
    made = publish(final, out, config, rows, manifest, began)
    work.done(config.keep_work)
    return made


def build_proportional(spark: SparkSession, legal_paths: str, replay_paths: str, weights: Mapping[tuple[str, str], int], out: str, config: Build) -> dict:
    """The proportional build: quotas by stratum, oversampled scan, near-duplicate removal, redistribution, exact selection."""
    began = time.time()
    sinks.refuse_filled(out)
    legal_target, replay_target = sampling.corpus_targets(config.total_tokens, config.legal_share)
    quotas = sampling.largest_remainder(legal_target, weights)
    sampling.check_capacity(quotas, weights)
    work = Work(out, config, legal_paths, replay_paths, sorted(map(str, weights.items())))
    legal = jsonl.legal_records(_lines(spark, legal_paths, config.max_legal_rows, jsonl.LEGAL), LEGAL)
    replay = jsonl.replay_records(_lines(spark, replay_paths, config.max_replay_rows, jsonl.REPLAY), REPLAY)
    capacity = replay.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(estimated_tokens("text")), F.lit(0)).alias("tokens")).first()
    sampling.check_capacity({REPLAY: replay_target}, {REPLAY: capacity.tokens})
    chances = sampling.oversampled(quotas, weights, config.oversample)
    share = sampling.oversampled({REPLAY: replay_target}, {REPLAY: capacity.tokens}, config.oversample)[REPLAY]

    def preprocessed() -> DataFrame:
        some = replay.filter(sampled(config.seed, "slimpajama_1b", "source_file", "source_row", share))
        return accept_all(sampling.bernoulli_by_stratum(legal, chances, config.seed, LEGAL), some, config=config)

    rows = work.stage("preprocessed", preprocessed, spark)
    kept = work.stage("survivors", lambda: survivors(rows, config.near()).withColumns(quota_group()), spark)
    held = {(r.quota_type, r.quota_jurisdiction): r.n for r in kept.groupBy("quota_type", "quota_jurisdiction").agg(F.sum("estimated_tokens").alias("n")).collect()}
    original = {(k.lower(), j): q for (k, j), q in quotas.items()}
    adjusted, received = sampling.redistribute(original, held, {(k.lower(), j): w for (k, j), w in weights.items()})
    wanted = [(*k, original[k], adjusted[k], received[k], held.get(k, 0)) for k in original] + [(REPLAY, REPLAY, replay_target, replay_target, 0, held.get((REPLAY, REPLAY), 0))]
    table = spark.createDataFrame(wanted, "quota_type string, quota_jurisdiction string, target long, quota long, redistributed long, available long")
    chosen = cut_lineage(sampling.select_by_quota(kept, table, ["quota_type", "quota_jurisdiction"], "estimated_tokens", config.seed))
    sums = {r.corpus: r.n for r in chosen.groupBy("corpus").agg(F.sum("estimated_tokens").alias("n")).collect()}
    sampling.check_overshoot(sums, {LEGAL: legal_target, REPLAY: replay_target}, config.tolerance)
    report = sampling.quota_report(table, chosen, ["quota_type", "quota_jurisdiction"], "estimated_tokens")
    manifest = {"quotas": [r.asDict() for r in report.collect()], "replay_capacity": capacity.asDict()}
    made = publish(chosen.drop("quota_type", "quota_jurisdiction", "priority", "tokens_before"), out, config, rows, manifest, began)
    sinks.write_json(f"{out}/quotas.json", manifest["quotas"])
    work.done(config.keep_work)
    return made


def quota_group() -> dict:
    """Columns of the quota group: the replay corpus is one, the legal one is by type and jurisdiction."""
    replay = F.col("corpus") == REPLAY
    return {"quota_type": F.when(replay, REPLAY).otherwise(F.lower("type")), "quota_jurisdiction": F.when(replay, REPLAY).otherwise(F.col("jurisdiction"))}


def prepare_pairs(rows: DataFrame, out: str, seed: int = 42, validation: float = 0.1, test: float = 0.1) -> dict:
    """Pairs of both directions (direction, policy_uid, policy_group, messages, provenance, place) with leakage-safe splits."""
    rows = cut_lineage(rows)
    crossing = sft.groups_apart(rows.select("policy_group", F.explode("provenance.split").alias("split")), "policy_group").count()
    components = cut_lineage(sft.group_of_prompts(rows))
    assigned = sft.assign_group_splits(components, seed, validation, test)
    grouped = rows.join(components.withColumnsRenamed({"node": "policy_group", "component": "group_id"}), "policy_group").join(assigned, "group_id")
    pairs = cut_lineage(sft.ordered_pairs(sft.deduplicated_pairs(grouped, ["place"]), seed))
    sft.check_leakage(pairs)
    counts = pairs.groupBy("direction", "split").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("group_id").alias("groups"))
    with sinks.staged(out) as folder:
        pairs.repartitionByRange("direction", "split", "order_hash").sortWithinPartitions("order_hash").write.partitionBy("direction", "split").json(f"{folder}/pairs")
        sft.generation_view(pairs, "place").write.partitionBy("direction", "split").json(f"{folder}/generation")
        sft.joint_view(pairs, seed).orderBy("order_hash").write.json(f"{folder}/joint")
        manifest = {"seed": seed, "groups_crossing_source_splits": crossing, "counts": [r.asDict() for r in counts.collect()]}
        sinks.write_json(f"{folder}/manifest.json", manifest)
    return manifest


def prepare_pairs_from(spark: SparkSession, folders: Mapping[str, Mapping[str, str]], instructions: Mapping[str, str], out: str, seed: int = 42, validation: float = 0.1, test: float = 0.1, structured: bool = True) -> dict:
    """Pairs from Parquet tables of instruction, input and output, by direction and given split; with the digests of the inputs."""
    rows = None
    for direction, splits in folders.items():
        for split, path in splits.items():
            read = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.monotonically_increasing_id().alias("__id"))
            first = read.groupBy("__file").agg(F.min("__id").alias("__first"))
            placed = read.join(F.broadcast(first), "__file").withColumn("__row", F.col("__id") - F.col("__first"))
            made = sft.policy_pairs(placed, direction, instructions[direction], structured)
            place = F.struct(F.lit(direction).alias("direction"), F.lit(split).alias("split"), F.col("__file").alias("file"), F.col("__row").alias("row"))
            origin = F.array(F.struct(F.col("__file").alias("file"), F.col("__row").cast("long").alias("row"), F.lit(split).alias("split")))
            part = made.select("direction", "policy_uid", "policy_group", "messages", origin.alias("provenance"), place.alias("place"))
            rows = part if rows is None else rows.unionByName(part)
    manifest = prepare_pairs(rows, out, seed, validation, test)
    files = {d: {s: [r.asDict() for r in jsonl.source_inventory(spark, p).orderBy("path").collect()] for s, p in by.items()} for d, by in folders.items()}
    sinks.write_json(f"{out}/inputs.json", files)
    return manifest
