"""The pipeline's stages on a small corpus with planted cases."""

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline

EN = "the house of the old man was near the river and the trees grew by water "


def test_stages(spark, tmp_path):
    words = " ".join(f"b{i}" for i in range(14))
    rows = [(i, EN + " ".join(f"w{i}x{j}" for j in range(40)) + (". you idiot. " if i % 5 == 0 else ". ") + EN, "en", "s", 0) for i in range(200)]
    rows += [(300, rows[1][1], "en", "s", 0), (301, "12 34", "en", "s", 0), (302, None, "en", "s", 0), (303, "Some start " + words + " some end of it", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, words)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    clean = {i for i in range(200) if i % 5}
    assert set(kept["language_id"]) == set(range(200)) | {300, 303}
    assert set(kept["toxicity"]) == clean | {300, 303}
    assert set(kept["jaccard_join"]) == clean | {303} == set(kept["decontamination"]) == set(kept["byte_bpe"])
    assert kept["decontamination"][303].text == "Some start some end of it" and kept["decontamination"][303].n_chars == 25
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(clean) + 1


def test_language_stage_decides(spark):
    de = "das haus von dem alten mann war bei dem fluss und den baeumen "
    rows = [(i, (EN if i % 2 else de) * (1 + i % 5), "en" if i % 2 else "de", "s", 0) for i in range(80)]
    rows += [(100, EN * 3, "de", "s", 0), (101, de * 3, None, "s", 0), (102, "12", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert got == {i: "en" if i % 2 else "de" for i in range(80)} | {100: "en", 101: "de"}
