"""Every query against its SQL, and the pipeline as a whole, on small tables."""

import pytest

import corpus_pipeline
from checks.compare import check, duck
from tests.llm.helpers import awkward, empty
from videonet.llm.common import store
from videonet.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    wrong, rows, _, _ = check(spark, connection, SF_DIR, name, QUERIES, ORACLE)
    assert wrong is None and rows > 0


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = store(docs, name)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("rows", [awkward, empty])
def test_stages_take_awkward_tables(spark, rows):
    docs = rows(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, SF_DIR), name)
        assert out.count() >= 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_pipeline_leaves_no_scratch_tables(spark):
    import os

    from videonet.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    corpus_pipeline.run(spark, SF_DIR).count()
    made = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before if not name.startswith("rdd-")}
    assert made <= {*(name for name, _ in corpus_pipeline.STAGES), "packed"}
