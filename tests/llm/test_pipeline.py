"""The pipeline's stages against plain restatements, each on its own input."""

import corpus_pipeline
from streamtally.llm import language
from tests.llm import brute
from tests.llm.conftest import SF


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs, out)
        docs = out
    for name, (_, out) in list(seen.items())[:-1]:
        assert out.columns == columns, name

    before, after = map(rows, seen["language_id"])
    model = language.learn(seen["language_id"][0].where("crc32(cast(doc_id as string)) % 4 != 2"))
    told = rows(language.predict(seen["language_id"][0], model))
    for i, r in before.items():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (i in after) == (letters and (not told[i]["ambiguous"] or r["lang"] in model.languages))
        assert i not in after or after[i]["lang"] == (r["lang"] if told[i]["ambiguous"] else told[i]["lang_pred"])
    before, after = map(rows, seen["quality_rules"])
    for i, r in before.items():
        counts = brute.word_counts(r["text"])
        assert i not in after or (counts["n_words"] >= 50 and 2 * counts["n_repeat_words"] <= counts["n_words"])
    before, after = map(rows, seen["near_dedup"])
    groups = brute.components([(i, r["text"]) for i, r in before.items()], corpus_pipeline.SIMILARITY)
    assert set(after) == {i for i, (_, c) in groups.items() if c == i}
    before, after = map(rows, seen["suffix_array_dedup"])
    want = brute.repeats([(i, r["text"]) for i, r in before.items()])
    assert set(before) == set(after)
    for i, r in after.items():
        assert len(r["text"]) == r["n_chars"] and len(r["text"].encode()) >= want[i][0] - want[i][1]
        assert (r["text"] == before[i]["text"]) == (want[i][1] == 0)
    before, out = seen["best_fit_packing"]
    assert {r["doc_id"] for r in out.collect()} == set(rows(before))


def test_language_stage_settles_labels(spark, docs):
    """Labels that are missing, unknown or wrong change; ambiguous texts keep a learned label or go."""
    clear = [r for r in docs.where("n_chars > 2000").collect()]
    english = next(r for r in clear if r["lang"] == "en")
    french = next(r for r in clear if r["lang"] == "fr")
    given = [
        (10_002, english["text"], None), (10_003, english["text"], "xx"), (10_004, english["text"], "fr"), (10_005, french["text"], "fr"),
        (10_006, "q", "fr"), (10_007, "q", None), (10_008, "q", "xx"), (10_009, "12 34", "en"), (10_010, None, "en"),
    ]
    added = spark.createDataFrame([(i, t, x, None, None) for i, t, x in given], docs.schema)
    model = language.learn(docs)
    assert language.judge(model, ["q"])[2][0]
    got = {i: r["lang"] for i, r in rows(language.identified(added, model)).items()}
    assert got == {10_002: "en", 10_003: "en", 10_004: "en", 10_005: "fr", 10_006: "fr"}


def test_run_is_the_stages_in_turn(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_pipeline_of_odd_rows(spark, odd, empty):
    for df in (odd, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == df.columns
        docs.count()
