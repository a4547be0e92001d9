"""Command line of the entry points: statistics, build, proportional, pairs, convert."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from corpusloom.functions.labels import JURISDICTIONS, TYPE_ALIASES
from corpusloom.plans import pipelines
from corpusloom.sources import convert

#: Selections by name.
PRESETS = {"eu": {"jurisdictions": ["EU"]}, "legislation": {"types": ["legislation"], "jurisdictions": ["ALL"]}}


def parser() -> argparse.ArgumentParser:
    """The arguments of all commands."""
    top = argparse.ArgumentParser(prog="corpusloom")
    commands = top.add_subparsers(dest="command", required=True)
    stats = commands.add_parser("statistics", help="corpus statistics by type, jurisdiction and source")
    stats.add_argument("--legal", required=True)
    stats.add_argument("--out", required=True)
    build = commands.add_parser("build", help="budgeted corpus build")
    exact = commands.add_parser("proportional", help="build with quotas by stratum")
    for p in (build, exact):
        p.add_argument("--legal", required=True)
        p.add_argument("--replay")
        p.add_argument("--out", required=True)
        p.add_argument("--seed", type=int, default=42)
        p.add_argument("--shard-tokens", type=int, default=100_000_000)
        p.add_argument("--near-dedup", choices=("minhash", "skip"), default="minhash")
        p.add_argument("--dedup-threshold", type=float, default=0.5)
        p.add_argument("--unverified", action="store_true", help="tie candidates without comparing their shingles")
        p.add_argument("--model", help="language model (ARPA, or binary where its package is installed); executors must reach it")
        p.add_argument("--skip-perplexity", action="store_true", help="build without a language model")
        p.add_argument("--perplexity-threshold", type=float, default=1500.0)
        p.add_argument("--score-replay", action="store_true")
        p.add_argument("--max-legal-rows", type=int, help="trial: scan so many rows only")
        p.add_argument("--max-replay-rows", type=int, help="trial: scan so many rows only")
        p.add_argument("--keep-work", action="store_true", help="keep the stages from which a build can go on")
    build.add_argument("--preset", choices=sorted(PRESETS))
    build.add_argument("--types", nargs="*")
    build.add_argument("--jurisdictions", nargs="*")
    build.add_argument("--replay-ratio", type=float, default=0.1)
    build.add_argument("--replay-tokens", type=int)
    exact.add_argument("--total-tokens", type=int, required=True)
    exact.add_argument("--legal-share", type=float, default=0.9)
    exact.add_argument("--weights", required=True, help="JSON file: [[type, jurisdiction, tokens], ...]")
    exact.add_argument("--oversample", type=float, default=1.5)
    exact.add_argument("--tolerance", type=float, default=0.01)
    lines = commands.add_parser("convert", help="Parquet to JSON lines")
    lines.add_argument("source")
    lines.add_argument("out")
    lines.add_argument("--drop", nargs="*", default=[])
    lines.add_argument("--overwrite", action="store_true")
    lines.add_argument("--preview", type=int, default=0)
    pairs = commands.add_parser("pairs", help="instruction pairs with leakage-safe splits")
    pairs.add_argument("--input", nargs=3, action="append", required=True, metavar=("DIRECTION", "SPLIT", "PARQUET"))
    pairs.add_argument("--instruction", nargs=2, action="append", required=True, metavar=("DIRECTION", "TEXT"))
    pairs.add_argument("--out", required=True)
    pairs.add_argument("--seed", type=int, default=42)
    pairs.add_argument("--validation", type=float, default=0.1)
    pairs.add_argument("--test", type=float, default=0.1)
    pairs.add_argument("--plain", action="store_true", help="the bare policy or summary instead of input and output as they are")
    return top


def settings(args: argparse.Namespace, **more: object) -> pipelines.Build:
    """Build settings of the arguments that both builds share."""
    if not args.model and not args.skip_perplexity:
        raise SystemExit("give --model, or --skip-perplexity to build without one")
    return pipelines.Build(
        seed=args.seed, shard_tokens=args.shard_tokens, near_duplicates=args.near_dedup != "skip", verify_candidates=not args.unverified, similarity=args.dedup_threshold, model_path=None if args.skip_perplexity else args.model,
        perplexity_threshold=args.perplexity_threshold, score_replay=args.score_replay, max_legal_rows=args.max_legal_rows, max_replay_rows=args.max_replay_rows, keep_work=args.keep_work, **more,
    )


def main(argv: Sequence[str] | None = None) -> None:
    """Run a command; later arguments win over earlier ones."""
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("corpusloom").getOrCreate()
    if args.command == "statistics":
        print(json.dumps(pipelines.corpus_statistics(spark, args.legal, args.out)))
    elif args.command == "convert":
        rows, preview = convert.convert(spark, args.source, args.out, args.drop, args.overwrite, args.preview)
        print(json.dumps({"rows": rows, "preview": preview}, ensure_ascii=False, default=str))
    elif args.command == "build":
        preset = PRESETS.get(args.preset, {})
        config = settings(args, replay_ratio=1.0 if args.replay_tokens else args.replay_ratio)
        types, places = pipelines.selection(args.types or preset.get("types"), TYPE_ALIASES), pipelines.selection(args.jurisdictions or preset.get("jurisdictions"), JURISDICTIONS)
        pipelines.build_corpus(spark, args.legal, args.replay, args.out, config, types, places, args.replay_tokens)
    elif args.command == "pairs":
        folders: dict = {}
        for direction, split, path in args.input:
            folders.setdefault(direction, {})[split] = path
        print(json.dumps(pipelines.prepare_pairs_from(spark, folders, dict(args.instruction), args.out, args.seed, args.validation, args.test, not args.plain)))
    else:
        config = settings(args, total_tokens=args.total_tokens, legal_share=args.legal_share, oversample=args.oversample, tolerance=args.tolerance)
        with open(args.weights, encoding="utf-8") as f:
            weights = {(t, j): n for t, j, n in json.load(f)}
        pipelines.build_proportional(spark, args.legal, args.replay, weights, args.out, config)


if __name__ == "__main__":
    main()
