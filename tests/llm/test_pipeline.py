"""The pipeline's stages on the smallest tables, and the registry."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pitlake.llm import pieces, pii, toxicity
from pitlake.llm.common import BATCH_BYTES, BATCH_SETTING, table
from pitlake.llm.near_texts import near_texts


def test_all_queries_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "sentencepiece"]


def test_stages(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "sentencepiece":
            assert docs.columns == before.columns
        ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
        seen[name] = ids(docs)
        if name == "toxicity":
            model = toxicity.train(before, table(spark, sf, "labels"))
            good = {r["doc_id"] for r in toxicity.score_documents(before, model).where("predicted = 0").collect()}
            assert seen[name] == good
        elif name == "near_dedup":
            kept = {r["doc_id"] for r in near_texts(before, percent=80).where("kept").collect()}
            assert seen[name] == kept
        elif name == "pii":
            assert seen[name] == ids(before)
            left = pii.scan_documents(docs).agg(*[F.sum(c).alias(c) for c in ("n_email", "n_ip", "n_card", "n_phone")]).first()
            assert sum(left) == 0
        elif name == "mixing":
            assert seen[name] <= ids(before)
    assert docs.where(~F.col("round_trip")).count() == 0


def test_one_row_of_a_repeated_id_stays(spark, sf):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words here now then"), (None, None)], "doc_id long, text string")
    got = corpus_pipeline.near_dedup(spark, df, sf).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 1, 2]


def test_rows_of_a_repeated_or_missing_id_are_compared_by_text(spark, sf):
    a, b, c = ("".join(f"{w}{i} " for i in range(30)) for w in ("alpha", "beta", "gamma"))
    rows = [(3, b), (5, b), (5, a), (6, c), (6, c), (7, a + "more"), (None, c), (None, "other words that stand here"), (None, "other words that stand here"), (None, None), (None, None), (8, "")]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    want = [(3, b), (5, a), (6, c), (None, "other words that stand here"), (None, None), (None, None), (8, "")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


CLASHES = ("_use", "__mixture__", "__spans", "_nth", "_row", "row", "m", "number", "rep", "key", "group", "leaf", "spot", "cell", "part", "found", "words", "class", "bucket", "gone", "kept")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_odd_tables(spark, sf, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = table(spark, sf, "documents").limit(0)
    assert stage(spark, docs, sf).count() == 0
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "x" * 100_000, None, "s", 1), (2, "x" * 100_000, None, "s", 1), (3, "some words by a@b.cd here", "en", None, 25), (None, "some words by a@b.cd here", "en", None, 25)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for extra in CLASHES:
        odd = odd.withColumn(extra, F.lit(f"own {extra}"))
    got = stage(spark, odd, sf)
    if name == "sentencepiece":
        assert got.count() == len(rows) and got.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
        return
    assert got.columns == odd.columns
    found = got.collect()
    assert found and all(r[c] == f"own {c}" for r in found for c in CLASHES)
    left = {"toxicity": 6, "near_dedup": 4, "pii": 6}.get(name)
    assert left is None or len(found) == left


def test_a_run_goes_on_where_it_stopped(spark, sf, tmp_path, monkeypatch):
    root, done = f"file://{tmp_path}/run", []

    def stage(name, fails=False):
        def run(spark, docs, sf_dir):
            if fails and not done.count("second"):
                done.append("second")
                raise RuntimeError("lost")
            done.append(name)
            return docs.where("doc_id % 2 = 0")

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", stage("first")), ("second", stage("second", True))])
    with pytest.raises(RuntimeError):
        corpus_pipeline.run(spark, sf, root)
    assert corpus_pipeline.run(spark, sf, root).count() > 0
    assert done == ["first", "second", "second"]


@pytest.mark.parametrize("name", ["toxicity", "near_dedup", "sentencepiece"])
def test_a_stage_gets_texts_in_batches_of_bounded_bytes(spark, sf, name):
    spark.conf.unset(BATCH_SETTING)
    dict(corpus_pipeline.STAGES)[name](spark, table(spark, sf, "documents").limit(10), sf).count()

    def measured(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["id"])

    long = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('words ', 1700) AS text")
    found = [r["id"] for r in long.mapInArrow(measured, "id long").collect()]
    assert len(found) > 5 and max(found) < 1.1 * BATCH_BYTES


def test_an_encoder_remembers_no_text_after_a_task(spark, sf):
    def left(batches):
        list(batches)
        coder = pieces.encoder()
        yield pa.RecordBatch.from_arrays([pa.array([len(getattr(coder, "_index", ())) + len(getattr(coder, "_keys", ())) + len(coder._pairs)])], ["n"])

    docs = table(spark, sf, "documents")
    assert pieces.encode_documents(docs).where("round_trip").count() == docs.count()
    assert {r["n"] for r in docs.select("doc_id").mapInArrow(left, "n long").collect()} == {0}
    coder = pieces.Encoder(pieces.Vocabulary.load())
    texts = ["some words", "more  words and \u4e00", ""]
    before = [x.tolist() for x in coder.encode(texts)]
    coder.forget()
    assert [x.tolist() for x in coder.encode(texts)] == before
