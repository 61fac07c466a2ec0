"""The registered queries: SQL where there is some, whole tables, and the pipeline."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from mailsift.llm.oracle import ORACLE_SQL
from mailsift.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    info = compare(spark, duck(SF_SMALL), name, QUERIES[name], ORACLE_SQL[name], SF_SMALL)
    assert info["ok"], info


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == [*range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())


@pytest.mark.parametrize("name", ["op1_ppm", "op4_simhash", "op5_licenses", "op10_sharding"])
def test_queries_give_a_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], SF_SMALL))
        assert kept[-1].columns == columns
    ids = [sorted(r.doc_id for r in d.select("doc_id").collect()) for d in kept]
    verdict = {r.doc_id for r in QUERIES["op7_quality"](spark, SF_SMALL).filter("kept").collect()}
    assert set(ids[1]) == verdict and len(ids[1]) == len(verdict)
    assert set(ids[2]) <= set(ids[1]) and len(set(ids[2])) == len(ids[2])
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].count(i) for i in set(ids[3])) <= 2
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.filter("not round_trip").count() == 0
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(ids[3])


def test_pipeline_takes_nulls_empty_tables_and_repeated_rows(spark, tmp_path):
    """Through ``run`` itself: odd rows cost no stage, and an empty table gives no rows."""
    import random

    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(90), rnd.choice(["en", None]), rnd.choice(["a", None, ""]), None) for i in range(60)]
    rows += [(None, prose(80), None, None, 1), (None, prose(80), None, None, 1), (70, None, "en", "a", 0),
             (71, "", "en", "a", 0), (72, prose(30_000), "en", "b", None)] + [rows[5]] * 3
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for name, some in (("odd", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(some, kind).withColumn("fp", F.lit("mine")).withColumn("mix_size", F.lit(-1)) \
            .write.parquet(str(folder / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(folder)).collect()
        assert all(r.round_trip for r in out) and bool(out) == bool(some)
        ids = {r.doc_id for r in out}
        assert not ids & {70, 71} and (not some or len(ids) > 20)


def test_queries_run_where_the_package_is_not_installed(tmp_path):
    """From another folder, without PYTHONPATH: workers get all code with their tasks."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    names = [n for n in QUERIES if n not in ("op2_chat", "op5_licenses", "op6_mixing", "op10_sharding")]
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parents[2])!r})
from pyspark.sql import SparkSession
from mailsift.llm.queries import QUERIES
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
for name in {names!r}:
    print(name, QUERIES[name](spark, {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x.split()[0] for x in done.stdout.split("\n") if x] == names
