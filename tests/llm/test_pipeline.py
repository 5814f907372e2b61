import pytest

import corpus_pipeline
from cases import LINE, ROWS, documents, tables
from checks.compare import connect, differences
from ledgerpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_reference(spark, duck, name):
    rows, wrong = differences(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert not wrong and rows > 0


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def _ids(df):
    return sorted(str(r["doc_id"]) for r in df.select("doc_id").collect())


def test_stages_hand_on_the_columns_and_take_effect(spark, tmp_path):
    docs = documents(spark, clash=False)
    items = spark.createDataFrame([(1, "the cat sat on the mat")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1), (7, 1)], "doc_id long, quality int")
    folder = tables(tmp_path, documents=docs, benchmark=items, labels=labels)
    stages = dict(corpus_pipeline.STAGES)
    for name in list(stages)[:4]:
        assert stages[name](spark, docs, folder).columns == COLUMNS
    lines = {r["doc_id"]: r for r in stages["line dedup"](spark, docs, folder).collect()}
    assert lines[4]["text"] == "The cat sat on the mat today" and lines[4]["n_chars"] == len(lines[4]["text"])
    assert lines[6]["text"].startswith(LINE) and lines[0]["text"] is None
    assert _ids(stages["n-gram jaccard join"](spark, docs, folder)) == sorted(str(r[0]) for i, r in enumerate(ROWS) if r[0] != 10 and i != 7)
    assert _ids(stages["benchmark decontamination"](spark, docs, folder)) == sorted(str(r[0]) for r in ROWS if r[0] not in (4, 7))
    assert stages["best-fit packing"](spark, docs, folder).count() >= len(ROWS)


def test_stages_with_clashing_names_and_no_rows(spark, tmp_path):
    docs, none = documents(spark), documents(spark, [])
    folder = tables(tmp_path, documents=docs, benchmark=spark.createDataFrame([], "item_id long, text string"),
                    labels=spark.createDataFrame([], "doc_id long, quality int"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        assert {r["found"] for r in out.collect()} <= {"clash"}
        assert stage(spark, none, folder).count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 100
    assert max(r["offset"] + r["length"] for r in rows) <= 2048
    ids = {r["doc_id"] for r in rows}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in ids for d in good) > 0.6 * len(good)
    assert sum(d in ids for d, q in labels.items() if q == 0) < 0.8 * sum(q == 0 for q in labels.values())  # some 60 labels
