import corpus_pipeline as cp
from ledgerloom.llm import langid, quality
from ledgerloom.llm.common import prepare, table, written

from .test_lines import plain as plain_lines
from .test_packing import check, library  # noqa: F401
from .test_simhash import plain_fingerprint, plain_roots

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, library):  # noqa: F811
    prepare(spark)
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    out = {}
    for name, stage in cp.STAGES:
        before = docs
        docs = written(stage(spark, docs, FOLDER))
        out[name] = (before.collect(), docs.collect())
        if name != "packing":
            assert docs.columns == columns and docs.schema["doc_id"].dataType.simpleString() == "bigint"
    a, b = out["quality"]
    model = quality.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    score = model.score([r.text for r in a])
    assert {r.doc_id for r in b} == {r.doc_id for r, s in zip(a, score) if s >= 0.3}
    good = {r.doc_id for r in table(spark, FOLDER, "labels").filter("quality = 1").collect()}
    assert len(good & {r.doc_id for r in b}) >= 0.98 * len(good) and len(b) < len(a)
    a, b = out["language"]
    lang, score = langid.train(spark.createDataFrame(a)).predict([r.text for r in a])
    assert {r.doc_id for r in b} == {r.doc_id for r, k, s in zip(a, lang, score) if k != "und" and s >= 0.5}
    a, b = out["lines"]
    want = {i: t for i, t, _, _ in plain_lines([(r.doc_id, r.text) for r in a])}
    assert {r.doc_id: (r.text, r.n_chars) for r in b} == {i: (t, len(t)) for i, t in want.items()}
    a, b = out["near_copies"]
    a = sorted(a)
    roots = plain_roots([plain_fingerprint(r.text) for r in a])
    assert sorted(b) == sorted(a[i] for i in set(roots)) and len(b) < len(a)
    a, b = out["packing"]
    check(b, [(r.doc_id, r.text) for r in a], library)
    whole = cp.run(spark, FOLDER)
    order = ["doc_id", "start"]
    assert whole.orderBy(order).collect() == docs.orderBy(order).collect()


def test_odd_documents(spark, tmp_path):
    prepare(spark)
    text = "the good plain words of a document that stays where it is"
    rows = [(1, text, "en", None, None), (1, text, "en", "s", 3), (1, text + " but another one", "en", "s", 3), (2, None, "en", "s", 0),
            (3, "", None, "s", 0), (None, text, "en", "s", 9), (None, None, None, None, None), (4, "12 34", "en", "s", 5)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string, _lines int")
    spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns, kinds = docs.columns, docs.dtypes
    for empty in (False, True):
        own = docs.limit(0) if empty else docs
        for name, stage in cp.STAGES:
            own = written(stage(spark, own, str(tmp_path)))
            if name != "packing":
                assert own.columns == columns and own.dtypes == kinds
        assert (own.count() == 0) is empty


def test_one_of_each_group(spark):
    prepare(spark)
    text = "the good plain words of a document that stays where it is"
    rows = [(1, text), (1, text), (1, "quite other words stand in this one and nowhere else"), (None, text), (None, "an orphan text of its own"),
            (None, "an orphan text of its own"), (7, "an only child")]
    got = cp.without_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[2], rows[4], rows[6]], key=str)
