import corpus_pipeline
from cellwatch.llm.nbsvm import learn, scored
from cellwatch.session import scratch_path
from tests.llm.data import documents
from tests.llm.test_decontaminate import brute as contained
from tests.llm.test_lines import brute as without_lines
from tests.llm.test_packing import check_places
from tests.llm.test_near import brute as classed

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r["doc_id"] for r in scored(docs, model).filter("predicted = 1").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        rows = docs.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == set(before)
            check_places(rows, 1024)
            continue
        assert docs.columns == columns
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows)
        if name == "quality":
            assert after == {i: before[i] for i in good}
        elif name == "line_dedup":
            want = without_lines(list(before.items()), 10)
            assert after == {i: kept for i, _, _, _, kept in want}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        elif name == "near_duplicates":
            pairs = list(before.items())
            assert after == {i: before[i] for i in classed(pairs)}
        else:
            bad = {i for i, *_ in contained(list(before.items()), items)}
            assert bad and after == {i: t for i, t in before.items() if i not in bad}
        before = after


def test_stages_take_awkward_rows_and_empty_tables(spark):
    for frame in (documents(spark), documents(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            path = scratch_path(spark, "stage")
            stage(spark, frame, SF).write.parquet(path)
            spark.read.parquet(path).count()


def test_run_equals_its_stages_in_count(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and check_places(rows, 1024) <= len(rows)
