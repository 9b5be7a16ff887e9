"""Each stage on what the stage before it kept."""

import corpus_pipeline
from quartermark.llm import quality_mil
from tests.llm import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/{name}")
        kept[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = kept[name][1]
    assert all(out.columns == COLUMNS for name, (_, out) in kept.items() if name != "packing")

    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in kept["quality"])
    network = quality_mil.train(kept["quality"][0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality_mil.score(kept["quality"][0], network).collect()}
    assert sorted(k for k, _ in after) == sorted(k for k, _ in before if scores[k] >= quality_mil.THRESHOLD)

    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in kept["near_duplicates"])
    component = {k: c for k, _, c in brute.groups(before, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)}
    assert sorted(after) == sorted((k, t) for k, t in before if component[k] == k)

    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in kept["substring_dedup"])
    expected = {k: (gone, sha) for k, _, gone, sha in brute.word_dedup(before)}
    texts = dict(before)
    for key, text in after:
        gone, sha = expected[key]
        assert brute.sha(" ".join(brute.blank_words(text)).encode()) == sha
        assert gone or text == texts[key]
    assert all(r.n_chars == len(r.text) for r in kept["substring_dedup"][1].collect())

    before, after = ([(r.doc_id, r.text) for r in df.collect()] for df in kept["decontamination"])
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    dirty = {r[0] for r in brute.decontamination(before, items) if r[5]}
    assert sorted(after) == sorted((k, t) for k, t in before if k not in dirty)
    assert kept["packing"][1].select("doc_id").distinct().count() == len(after)


def test_stages_on_odd_and_empty_tables(spark, odd, nothing, tmp_path):
    for number, (folder, docs) in enumerate((odd, nothing)):
        rows = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, folder)
            assert name == "packing" or out.columns == rows.columns
            out.write.parquet(f"{tmp_path}/{number}-{name}")
            rows = spark.read.parquet(f"{tmp_path}/{number}-{name}")
        assert docs or rows.count() == 0
