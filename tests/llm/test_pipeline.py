"""The pipeline's stages on a small table with planted cases."""

import random

import corpus_pipeline
from loopweave.llm import queries
from loopweave.scratch import settle


def test_stages(spark, tmp_path):
    rng = random.Random(4)
    parts = ["tha", "ing", "ou", "er", "ble", "re", "an", "ti"]

    def words(n):
        return ["".join(rng.choice(parts) for _ in range(rng.choice([2, 3]))) for _ in range(n)]

    def insult(ws):
        return [rng.choice(["vermin", "wretched", "loathsome"]) if i % 10 == 0 else w for i, w in enumerate(ws)]

    texts = [" ".join(insult(words(80)) if i % 4 == 0 else words(80)) for i in range(200)]
    base = words(120)
    near = base[:]
    near[60] = "changed"
    extra = [" ".join(base), " ".join(near), texts[1].upper(), "mail me at some.one12@mail.example.com now", None, ""]
    rows = [(i, t, "en", "s", len(t or ""), "kept") for i, t in enumerate(texts + extra)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 1, int(i % 4 == 0)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)

    at = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, at, sf))
        if name != "packing":
            assert after.columns == at.columns
            assert after.where("_row = 'kept'").count() == after.count()
        seen[name], at = {r["doc_id"]: r for r in after.collect()}, after
    assert sum(i % 4 == 0 for i in seen["toxicity"] if i < 200) <= 3
    assert all(i in seen["toxicity"] for i in range(200, 206)) and sum(i % 4 != 0 for i in seen["toxicity"] if i < 200) >= 148
    assert 1 not in seen["exact_dedup"] and 202 in seen["exact_dedup"] and 204 not in seen["exact_dedup"] and 205 in seen["exact_dedup"]
    assert 200 in seen["jaccard_join"] and 201 not in seen["jaccard_join"]
    assert len(seen["jaccard_join"]) == len(seen["exact_dedup"]) - 1
    assert "some.one12" not in seen["pii"][203]["text"] and seen["pii"][203]["n_chars"] == len(seen["pii"][203]["text"])
    assert set(seen["packing"]) == set(seen["pii"])
    assert corpus_pipeline.run(spark, sf).count() == at.count()


def test_every_operator_has_its_query():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES}
    assert numbers == set(range(1, 14)) and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_stages_pass_texts_to_python_in_small_batches(spark, monkeypatch):
    """What an executor's Python workers and their JVM hold of a batch is bounded by its rows."""
    from loopweave import scratch
    from loopweave.llm import common, jaccard_join

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    write = scratch.settle

    def settle(df):
        if "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString():
            seen.append(int(spark.conf.get(name)))
        return write(df)

    for module in (common, jaccard_join, scratch):
        monkeypatch.setattr(module, "settle", settle)
    monkeypatch.setattr(common.settle_in_small_batches, "__defaults__", (settle,))
    before = spark.conf.get(name)
    docs = spark.createDataFrame([(i, f"{i % 3} " + "one two three four five six seven " * 3) for i in range(40)], "doc_id long, text string")
    assert jaccard_join.jaccard_components(docs).select("component_id").distinct().count() == 3
    assert len(seen) > 4 and max(seen) <= 1024
    assert spark.conf.get(name) == before
