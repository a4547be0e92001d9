import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from corpusloom import cli, queries
from corpusloom.plans import pipelines

ROOT = Path(__file__).resolve().parent.parent
SMALL = Path("/root/testdata/sf0.001")


def test_core_does_not_import_the_training_data_package():
    code = "import sys, corpusloom.queries, corpusloom.plans.pipelines, corpusloom.streaming.accept, corpusloom.cli; sys.exit(any(m.startswith('corpusloom.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=ROOT).returncode == 0


def test_entry_points():
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not SMALL.exists(), reason="the test tables are not here")
@pytest.mark.parametrize("name", ["stats_by_group", "stats_grouping_sets", "stable_ids", "quota_selection", "nested_releases", "sft_pairs", "hash_split", "components"])
def test_queries_equal_their_sql(spark, name):
    got = queries.QUERIES[name](spark, str(SMALL))
    columns = sorted(got.columns)
    base = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        base.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    cursor = base.execute(queries.ORACLE[name])
    names = [c[0] for c in cursor.description]
    want = [tuple(str(row[names.index(c)]) for c in columns) for row in cursor.fetchall()]
    assert sorted(names) == columns
    assert sorted(tuple(str(r[c]) for c in columns) for r in got.collect()) == sorted(want)


def test_selection_and_arguments():
    assert pipelines.selection(["case law,Legal_MC4"], {"case law": "caselaw", "legal_mc4": "legal-mc4"}) == {"caselaw", "legal-mc4"}
    assert pipelines.selection(["us EU", "N/A"], {"us": "US", "eu": "EU"}) == {"US", "EU", "N/A"}
    assert pipelines.selection(["ALL"], {}) is None and pipelines.selection(None, {}) is None
    args = cli.parser().parse_args(["build", "--legal", "a", "--out", "o", "--seed", "1", "--seed", "2"])
    assert args.seed == 2 and args.near_dedup == "minhash"
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["nothing"])
