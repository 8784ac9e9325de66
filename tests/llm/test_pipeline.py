"""Each stage of the corpus pipeline against brute force over its own input, and queries against SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pulsegrid.llm import quality_rules
from pulsegrid.llm.registry import ORACLES, QUERIES

from oracle import assert_same, connect
from test_small_cases import awkward, contaminated, deduplicated, groups, near_copies, prose


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output of each stage, as the stages are run: written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out[name] = docs, result
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert before.dtypes == after.dtypes, name


def test_quality_stage(spark, sf_dir, stages):
    before, after = stages["quality"]
    model = quality_rules.fit_quality(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality_rules.score_quality(before, model).where("predicted = 1").collect()}
    assert texts(after) == {k: v for k, v in texts(before).items() if k in good}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").join(before.select("doc_id"), "doc_id")
    assert labels.join(after.select("doc_id"), "doc_id").count() >= 0.95 * labels.count()


def test_near_duplicate_stage(stages):
    before, after = map(texts, stages["near_duplicates"])
    kept = {i for i, _, c in groups(sorted(before.items())) if i == c}
    assert after == {i: before[i] for i in kept}


def first_of_each_group(rows):
    """The rows that stay, by brute force over texts."""
    linked = groups([(k, t) for k, (_, t) in enumerate(rows)])  # rows as nodes, so ids do not unite texts
    best = {}
    for k, n, c in linked:
        if n:
            i, t = rows[k]
            best.setdefault(c, []).append((i is None, i or 0, t))
    stay = [rows[k] for k, n, _ in linked if not n]
    return sorted([*stay, *[(None if min(x)[0] else min(x)[1], None) for x in best.values()]], key=repr)


def test_near_duplicates_are_decided_by_row(spark):
    a, b = prose(5, 40), prose(6, 40)
    small = [(3, a), (7, a), (7, b), (9, b), (None, a), (None, prose(8, 40)), (None, prose(8, 40)), (1, None), (1, None), (2, "")]
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(small, "doc_id long, text string"), "").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(3, a), (7, b), (None, prose(8, 40)), (1, None), (1, None), (2, "")], key=repr)
    rows = near_copies(12, 120)
    got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert sorted(((r.doc_id, None) for r in got), key=repr) == first_of_each_group(rows)
    assert {(r.doc_id, r.text) for r in got} <= set(rows)


def test_repeated_passage_stage(stages):
    before, after = map(texts, stages["repeated_passages"])
    expected = {i: (before[i] if not n else kept) for i, _, n, kept in deduplicated(sorted(before.items())) if not n or kept}
    assert after == expected
    assert stages["repeated_passages"][1].where("n_chars != char_length(text)").count() == stages["repeated_passages"][0].where("n_chars != char_length(text)").count()


def test_benchmark_stage(spark, sf_dir, stages):
    before, after = map(texts, stages["benchmark_passages"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {i for i, t in before.items() if contaminated(t, items)[1]}
    assert after == {i: t for i, t in before.items() if i not in found}


def test_packing_stage(stages):
    before, pieces = stages["packing"]
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == set(texts(before))
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_run_gives_what_the_stages_give(spark, sf_dir, stages):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(*columns).collect()) == sorted(stages["packing"][1].select(*columns).collect())


def test_awkward_rows_pass_through_all_stages(spark, sf_dir, tmp_path):
    schema = "doc_id long, text string, n_chars long, score string, carried string, k1 string"
    rows = [(i, t, None if t is None else len(t), *more[:3]) for i, t, *more in awkward()]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{tmp_path}/{len(some)}/{name}")
            before, docs = docs, spark.read.parquet(f"{tmp_path}/{len(some)}/{name}")
            if name != "packing":
                assert docs.columns == before.columns
                assert set(map(repr, docs.drop("n_chars", "text").collect())) <= set(map(repr, before.drop("n_chars", "text").collect()))
            else:
                assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name])


def test_all_queries_are_registered():
    names = entry.queries()
    assert [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")] == [n for n in QUERIES]
    assert "pipeline" in names


def test_held_out_accuracy(spark):
    """Labels and languages of rows that no model saw."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    quality = QUERIES["op3_quality_classifier"](spark, folder).where("held_out").join(labels, "doc_id")
    assert quality.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.97
    language = QUERIES["op9_language_id"](spark, folder).where("held_out").join(docs, "doc_id")
    assert language.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.97
