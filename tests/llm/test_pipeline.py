"""The pipeline's stages one by one, on a small table with planted cases."""

import random

from lightfold.llm.scratch import written


def test_stages(spark, tmp_path):
    import corpus_pipeline as c

    rng = random.Random(1)
    words = [f"{a}{b}{d}" for a in "bdfgk" for b in "aeiou" for d in "lmnrst"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(70)
    texts = [text(60) for _ in range(150)] + [text(30) + " moronic " + text(30) for _ in range(50)]
    texts += [texts[3], texts[4] + " more", f"{text(50)} {passage} {text(20)}", f"{text(40)} {passage} {text(20)}"]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t)) for i, t in enumerate(texts)] + [(900, None, None, None, 0), (901, "", "en", "s1", 0), (None, "no id here", "en", "s1", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(150 <= i < 200)) for i in range(200)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = docs
    after = {}
    for name, stage in c.STAGES:
        kept = written(stage(spark, kept, str(tmp_path)), "stage")
        after[name] = {r["doc_id"]: r for r in kept.collect()} if name != "packing" else kept.collect()
        if name != "packing":
            assert kept.columns == docs.columns
    clean = set(range(150)) | {200, 201, 202, 203, 900, 901, None}
    assert set(after["toxicity"]) == clean
    assert set(after["near duplicates"]) == clean - {200, 201}
    last = after["repeated passages"]
    assert passage in last[202]["text"] and passage not in last[203]["text"] and last[203]["n_chars"] == len(last[203]["text"])
    assert all(last[i]["text"] == texts[i] for i in range(150))
    assert 0.4 * len(last) < len(after["target weights"]) <= len(last)
    assert {r["doc_id"] for r in after["packing"]} == set(after["target weights"])


def test_run_on_nothing(spark, tmp_path):
    import corpus_pipeline as c

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert c.run(spark, str(tmp_path)).count() == 0
