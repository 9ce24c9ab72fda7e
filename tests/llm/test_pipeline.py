"""The pipeline's stages, and the entry points."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.cut(stage(spark, docs, folder))
        seen[name] = (docs, out)
        docs = out
    for name, (before, after) in seen.items():
        if name != "encoding":
            assert after.columns == before.columns
    before, after = seen["near duplicates"]
    ids = [r.doc_id for r in after.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {
        r.doc_id for r in corpus_pipeline.near_duplicates(before).where("kept").collect()}
    before, after = seen["secrets"]
    assert after.count() == before.count()
    assert after.where(r"text rlike '(?i)token *= *\"?[0-9a-f]{32}'").count() == 0
    before, after = seen["toxicity"]
    assert 0 < after.count() <= before.count()
    before, after = seen["encoding"]
    assert after.count() == before.count() and after.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


ODD = "doc_id long, text string, lang string, source string, n_chars long, rate double, copy_number int, shuffle_key string, assign int, hex string, score double, kept boolean"


def test_stages_on_odd_tables(spark, tmp_path):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    more = (0.5, 7, "k", 3, "h", 0.1, False)
    long = "a long text of plain words " * 50_000
    rows = [(1, "some words that are written once, token = 0123456789abcdef0123456789abcdef"), (1, "some words that are written once, token = 0123456789abcdef0123456789abcdef"),
            (2, None), (None, "a row without an id"), (3, ""), (4, long), (5, long), (6, " \n"), (None, None), (7, "été 漢字 ☕")]
    table = spark.createDataFrame([(i, t, None, None if i == 6 else "s", None if t is None else len(t), *more) for i, t in rows], ODD).repartition(3)
    for docs in (table, table.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)))
            if name == "encoding":
                assert out.count() == docs.count()
                break
            assert out.schema.simpleString() == docs.schema.simpleString()
            others = [c for c in docs.columns if c not in ("text", "n_chars")]
            assert out.select(others).distinct().exceptAll(docs.select(others).distinct()).count() == 0
            if name == "near duplicates" and docs.count():
                assert sorted(r.doc_id for r in out.where("doc_id IS NOT NULL").select("doc_id").distinct().collect()) == [1, 2, 3, 4, 6, 7]
            if name == "secrets":
                assert out.count() == docs.count() and out.where("text LIKE '%0123456789abcdef%'").count() == 0
                assert out.where("doc_id = 4 AND n_chars > 1000000").count() == docs.where("doc_id = 4").count()
            docs = out


def test_entry_points():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 14)}
