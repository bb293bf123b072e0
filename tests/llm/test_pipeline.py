import corpus_pipeline
from newsflow.llm import decontaminate, language_id, mixing, pii, queries, simhash_dedup
from pyspark.sql import functions as F
from tests.llm.data import AWKWARD, SF, docs, table
from tests.llm.test_pii import plain as base_spans
from tests.llm.test_simhash import components
from tests.llm.test_simhash import plain as fingerprint


def stages(spark, frame, tmp_path):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frame, SF).write.parquet(f"{tmp_path}/{k}")
        frame = spark.read.parquet(f"{tmp_path}/{k}")
        yield name, frame


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontaminate", "pii", "mix"]


def test_every_stage_against_plain_rules(spark, tmp_path):
    source = table(spark, "documents")
    before = {r.doc_id: r for r in source.collect()}
    columns = source.columns
    bad = {r.doc_id for r in decontaminate.contaminated(source, table(spark, "benchmark")).collect()}
    for name, frame in stages(spark, source, tmp_path):
        rows = frame.collect()
        if name != "mix":
            assert frame.columns == columns
        if name == "language_id":
            assert {r.doc_id for r in rows} == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "simhash_dedup":
            comp = components({i: fingerprint(r.text) for i, r in before.items()})
            assert sorted(r.doc_id for r in rows) == sorted(set(comp.values()))
        elif name == "decontaminate":
            assert bad and {r.doc_id for r in rows} == set(before) - bad
        elif name == "pii":
            assert {r.doc_id for r in rows} == set(before)
            for r in rows:
                assert base_spans(r.text) == "" and r.n_chars == len(r.text)
                if "@" not in before[r.doc_id].text and not any(c.isdigit() for c in before[r.doc_id].text):
                    assert r.text == before[r.doc_id].text
        else:
            assert {r.doc_id for r in rows} == set(before) and frame.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
        before = {r.doc_id: r for r in rows}


def test_awkward_rows_through_all_stages(spark, tmp_path):
    rows = docs(spark, AWKWARD).select("doc_id", "text", "lang", "source", "n_chars")
    sizes = {n: f.count() for n, f in stages(spark, rows, tmp_path)}
    assert sizes["language_id"] == 7 and sizes["mix"] == sizes["pii"] == sizes["simhash_dedup"]


def test_empty_documents(spark, tmp_path):
    rows = docs(spark, AWKWARD).select("doc_id", "text", "lang", "source", "n_chars").where("false")
    assert all(f.count() == 0 for _, f in stages(spark, rows, tmp_path))


def test_run_gives_the_mix(spark):
    got = queries.pipeline(spark, SF)
    assert got.count() > 100 and "taken" in got.columns


def test_language_stage_without_any_label(spark):
    rows = docs(spark, [(*r, None) for r in AWKWARD]).select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.identify_language(spark, rows, SF).collect()
    assert sorted((r.text or "")[:20] for r in kept) == sorted(t[:20] for _, t in AWKWARD if any(c.isalpha() for c in t or ""))


def test_decontamination_stage_bears_a_long_document_full_of_passages(spark, tmp_path):
    """The stage ran out of memory where one text held many passages: each hit took the whole text along."""
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = docs(spark, [(1, f"{passage} " * 3_000), (2, "a b " * 20_000), (3, f"so {passage} it is"), (4, "clean")])
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["decontaminate"](spark, rows, str(tmp_path)).collect()) == [2, 4]
