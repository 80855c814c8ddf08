import random

import corpus_pipeline as cp
from outflow.llm import toxicity as tx
from outflow.llm.shared import staged
from tests.llm.test_toxicity import corpus


def test_stages(spark, tmp_path):
    texts, y = corpus(3, 400)
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    clean = [t for t, v in zip(texts, y) if not v and len(t) > 300]
    rng = random.Random(8)
    item = " ".join(rng.sample(clean[0].split() + clean[1].split() + clean[2].split(), 40))
    more = [(1300, clean[5], "en", "s", 0), (1301, f"{clean[6][:200]} {item} {clean[7][:200]}", "en", "s", 0), (1302, "write to a.b@example.com " + clean[8][:150], "en", "s", 0), (1303, None, "en", "s", 0)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows + more, names).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(v)) for i, v in enumerate(y)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    judged = tx.score_toxicity(docs, tx.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))).collect()
    rejected = {r["doc_id"] for r in judged if r["predicted"]}
    assert len(rejected ^ {i for i, v in enumerate(y) if v}) <= 20
    left = []
    for name, stage in cp.STAGES:
        out = staged(stage(spark, docs, str(tmp_path)), name)
        if name != "encoding":
            assert out.columns == docs.columns
        if name == "personal_data":
            assert out.where("text like 'write to <email> %' and n_chars = length(text)").count() == (1302 not in rejected)
        docs = out
        left.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    everything = {r[0] for r in rows + more}
    assert everything - left[0] == rejected
    assert left[0] - left[1] == {1300} - rejected and left[1] - left[2] == {1301} - rejected and left[2] == left[3] == left[4]
    assert docs.where("not lossless").count() == 0
    assert cp.run(spark, str(tmp_path)).count() == len(left[4])


def test_repeated_rows_clashing_columns_and_empty_tables(spark, tmp_path):
    names = "doc_id long, text string, lang string, source string, n_chars long, row int, node string"
    rows = [(1, "one two three four five six", "en", "s", 27, 1, "x")] * 3 + [(None, None, None, None, None, None, None), (2, "", "en", "s", 0, 2, "y")]
    for name, docs in (("some", rows), ("none", [])):
        base = f"{tmp_path}/{name}"
        spark.createDataFrame(docs, names).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
        left = sorted((str(r["doc_id"]), r["n_chars"], r["lossless"]) for r in cp.run(spark, base).collect())
        # Copies are one row, and so are the texts without words.
        assert left == ([("1", 27, True), ("None", 0, True)] if docs else [])
