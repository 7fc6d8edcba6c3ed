import corpus_pipeline as P
from lodestone.llm.queries import ORACLE, REGISTRY
from tests.oracle_compare import compare, duck

import pytest

SF001 = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    ok, *_, detail = compare(spark, duck(SF001), name, REGISTRY[name], ORACLE[name], SF001)
    assert ok, detail


def test_stages(spark, odd_documents):
    docs = odd_documents.select(*COLUMNS)
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == COLUMNS, name
        assert stage(spark, docs.limit(0), SF001).count() == 0
    kept = P.near_dedup(spark, docs, SF001).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 8, 10, 11]
    assert sum(r["doc_id"] is None for r in kept) == 3


def test_clashing_columns_pass_the_stages(spark, odd_documents):
    """Columns named like those that stages make come through with their values."""
    clash = {"_row": "1", "row": "2", "_group": "'g'", "group": "4", "_key": "'k'", "key": "6", "_spans": "'s'", "doc": "'d'", "h": "9", "_id": "10",
             "toxic": "true", "first": "12"}
    docs = odd_documents.select(*COLUMNS).selectExpr("*", *(f"{v} as `{k}`" for k, v in clash.items()))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        plain = stage(spark, docs.select(*COLUMNS), SF001)
        assert out.columns == docs.columns and out.count() == plain.count(), name
        assert [tuple(r) for r in out.select(*clash).distinct().collect()] == [(1, 2, "g", 4, "k", 6, "s", "d", 9, 10, True, 12)], name
    assert stage(spark, docs, SF001).where("text like '%a.b@c.example.com%'").count() == 0
    assert P.packing(spark, docs, SF001).count() >= docs.count()


def test_decisions_take_effect(spark):
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").limit(1).collect()[0]
    base = " ".join(f"plain{i}" for i in range(60))
    rows = [(1, base), (2, base + " tail"), (3, items["text"]), (4, "write to me@corp.example.com " + " ".join(f"x{i}" for i in range(30))),
            (5, " ".join(f"q{i}" for i in range(40)) + " idiot moron scum stupid loser")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    learn = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(*COLUMNS)
    far = docs.withColumn("doc_id", docs["doc_id"] + 10_000_000)  # no label of theirs
    toxic = P.toxicity_filter(spark, learn.unionByName(far), "/root/testdata/sf0.1").where("doc_id > 10000000").selectExpr(
        "doc_id - 10000000 as doc_id")
    assert {r["doc_id"] for r in toxic.collect()} == {1, 2, 3, 4}
    assert {r["doc_id"] for r in P.near_dedup(spark, docs, SF001).collect()} == {1, 3, 4, 5}
    assert {r["doc_id"] for r in P.decontamination(spark, docs, SF001).collect()} == {1, 2, 4, 5}
    clean = {r["doc_id"]: r for r in P.pii(spark, docs, SF001).collect()}
    assert clean[4]["text"].startswith("write to <EMAIL> x0") and clean[4]["n_chars"] == len(clean[4]["text"]) and clean[1]["text"] == base
    assert {r["doc_id"] for r in P.packing(spark, docs, SF001).collect()} == {1, 2, 3, 4, 5}


def test_rows_are_judged_by_their_own_text(spark):
    """Null and repeated doc_ids: each row's own text decides."""
    def frame(rows):
        return spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long")

    def texts(df):
        return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)

    item = spark.read.parquet(f"{SF001}/benchmark.parquet").first()["text"]
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in ("plain", "other", "third"))
    toxic = " ".join(f"q{i}" for i in range(40)) + " idiot moron scum stupid loser"
    assert texts(P.decontamination(spark, frame([(None, item), (7, item), (7, a), (None, b)]), SF001)) == [(7, a), (None, b)]
    got = P.near_dedup(spark, frame([(1, a), (1, b), (2, a + " tail"), (None, c), (None, c + " tail")]), SF001)
    assert [(d, t.removesuffix(" tail")) for d, t in texts(got)] == [(1, b), (1, a), (None, c)]
    far = 20_000_000  # no label of theirs
    learn = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(*COLUMNS)
    kept = P.toxicity_filter(spark, learn.unionByName(frame([(None, toxic), (far, toxic), (far, a), (None, b)])),
                             "/root/testdata/sf0.1")
    assert texts(kept.where(f"doc_id is null or doc_id = {far}")) == [(far, a), (None, b)]


def test_run(spark):
    packed = P.run(spark, SF001)
    assert 0 < packed.count() and packed.columns[:2] == ["doc_id", "piece"]
