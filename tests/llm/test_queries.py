"""The registered queries over the smallest tables; with SQL where there is some."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from roadflux.llm.oracles import ORACLES
from roadflux.llm.queries import QUERIES
from verification import compare


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "pipeline"])
def test_query(spark, duck, sf_dir, name):
    status, note = compare.check(spark, duck, sf_dir, entry.queries()[name], ORACLES.get(name))
    assert status == ("ok" if name in ORACLES else "rows"), note


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    """Each stage on what its predecessor kept, judged by other means."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    docs = read("documents")
    kept = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], sf_dir).write.parquet(f"{tmp_path}/{k}")
        kept.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(frame.columns == docs.columns for frame in kept[:-1])
    ids = [{r[0] for r in frame.select("doc_id").collect()} for frame in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[-1] == ids[-2]
    toxic = {r.doc_id for r in read("labels").where("toxic = 1").collect()}
    assert len((ids[0] - ids[1]) & toxic) >= 0.5 * len(ids[0] - ids[1])
    items = [" ".join(r.text.lower().split()) for r in read("benchmark").collect()]
    clean = kept[4].agg(F.max(F.array_contains(F.transform(F.array(*map(F.lit, items)), lambda i: F.instr(F.lower("text"), i) > 0), True))).first()[0]
    assert not clean
    total = kept[5].agg(F.sum("taken").alias("t"), F.sum("size").alias("s")).first()
    assert abs(total.t - 1.5 * total.s) <= 0.02 * total.s


def test_stages_keep_rows_with_nulls_and_clashing_columns(spark, sf_dir):
    rows = [(1, "plain words here and there", None, "own", None, 7, "a"), (2, None, "src", None, 5, None, "b"), (None, "no id at all", None, "own", 1, 2, None),
            (3, "", "src", "own", None, 7, "c"), (4, "long " * 30000, "src", "own", 9, 7, "d"), (4, "long " * 30000, "src", "own", 9, 7, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, toxic string, n_words long, severity int, leaked string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.schema.names == docs.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema], name
        kept = [tuple(r) for r in got.collect()]
        assert all(r[2:] in [x[2:] for x in rows] for r in kept), name
        want = {1, 2, None, 4} if name == "near_dedup" else {1, 2, 3, 4, None}
        assert {r[0] for r in kept} == want, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)


def test_pipeline_of_nothing(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_window_operators_on_the_given_documents(spark, sf_dir):
    """op1, op5 and op7 against brute force over all documents of the smallest size."""
    import test_simhash
    import test_substrings
    import test_suffixes
    from roadflux.llm import simhash

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in QUERIES["op1_suffix_dedup"](spark, sf_dir).collect()], key=str)
    assert got == test_suffixes.brute(docs, 50) and sum(r[2] for r in got) > 1000
    got = sorted([tuple(r) for r in QUERIES["op7_substring_dedup"](spark, sf_dir).collect()], key=str)
    assert got == [(d, n, gone, digest) for d, n, gone, _, digest in test_substrings.brute(docs, 13)] and sum(r[2] for r in got) > 100
    ids, prints = [d for d, _ in docs], [simhash.fingerprint(t) for _, t in docs]
    want = sorted(zip(ids, (f"{p:016x}" for p in prints), test_simhash.brute_components(ids, prints)))
    assert sorted(tuple(r) for r in QUERIES["op5_simhash"](spark, sf_dir).collect()) == want
