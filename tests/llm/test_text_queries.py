"""The registered queries, their SQL, and the pipeline against its stages' definitions."""

from __future__ import annotations

import sys
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import __spark_entry__ as contract  # noqa: E402
import corpus  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import connect, differences  # noqa: E402
from llm import queries  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SMALL = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op4_decontamination", "op6_exact_top_k", "op11_centroid_clustering"}))
def test_every_document_has_its_row(spark, name):
    rows = queries.QUERIES[name](spark, SMALL).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        made[name] = docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    take = lambda name: [tuple(r) for r in made[name].collect()]
    before = take("toxicity")
    lines = {i: (t, full, gone) for i, t, full, gone in corpus.lines_removed(before, 8)}
    kept = {r[0]: r[1] for r in take("line_dedup")}
    assert kept == {i: t for i, (t, full, gone) in lines.items() if not full or gone < full}
    groups = corpus.jaccard_groups(take("line_dedup"), 5, 80)
    assert {r[0] for r in take("near_duplicates")} == {i for i, n, c in groups if i == c}
    assert {r[0] for r in take("decontamination")} < {r[0] for r in take("near_duplicates")}
    assert {r["doc_id"] for r in made["packing"].select("doc_id").distinct().collect()} == {r[0] for r in take("decontamination")}


def test_pipeline_with_awkward_rows(spark, tmp_path):
    corpus.frame(spark, True).write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").write.parquet(str(tmp_path / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    empty = tmp_path / "empty"
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(tmp_path / f"{table}.parquet")).limit(0).write.parquet(str(empty / f"{table}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_decontamination_tells_rows_of_one_id_apart(spark, tmp_path):
    item = " ".join(f"item{k}" for k in range(20))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    dirty = [(None, f"before {item} after"), (7, f"{item} more"), (8, item), (8, item)]
    clean = [(None, "a clean text"), (None, "a clean text"), (None, None), (7, "another clean text"), (7, None), (9, ""), (None, "")]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in dirty + clean]
    kept = corpus_pipeline.decontamination(spark, corpus.frame(spark, True, rows), str(tmp_path))
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in kept.collect()))) == sorted(map(str, clean))


def test_long_texts_reach_python_in_small_batches(spark):
    """200 documents of 100 KB are fewer rows than one batch may have, but more bytes."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])

    docs = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    stage = corpus_pipeline._stage(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "size long, n long"))
    found = stage(spark, docs, SMALL).collect()
    assert sum(r["n"] for r in found) == 200 and max(r["size"] for r in found) < 5_000_000
