"""The queries of the subpackage against their SQL, and the pipeline stage by stage."""

import os
import sys

import pytest

pytest.importorskip("tessera.llm")
sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))
import check_oracle  # noqa: E402

import corpus_pipeline  # noqa: E402
from tessera.llm import ngram_join, quality  # noqa: E402
from tessera.llm.common import stored, table  # noqa: E402
from tessera.llm.queries import QUERIES  # noqa: E402
from tessera.llm.sql import SQL  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.execute(SQL[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    ours = check_oracle.digest([tuple(r) for r in df.collect()], df.columns)
    assert ours[0] == check_oracle.digest(rel.fetchall(), cols)[0]


def test_stages_follow_each_other(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), "stage")
        sizes.append(docs.count())
        if name == "quality classifier":
            scored = quality.score_documents(before, table(spark, SF, "labels"))
            assert sizes[-1] == scored.where("predicted = 1").count() < sizes[-2]
        if name == "line dedup":
            assert 0.5 * sizes[-2] < sizes[-1] <= sizes[-2]  # scraps of copies go
            assert docs.selectExpr("sum(length(text))").first()[0] < before.selectExpr("sum(length(text))").first()[0]
        if name == "n-gram Jaccard join":
            groups = ngram_join.similar_documents(before).select("component_id").distinct().count()
            assert sizes[-1] == groups
        if name != "packing":
            assert docs.columns == columns
    tokens = docs.groupBy("sequence_id").sum("length")
    assert tokens.where("`sum(length)` > 1024").count() == 0


def test_stages_take_odd_rows_and_nothing(spark):
    schema = table(spark, SF, "documents").schema.simpleString()[7:-1] + ",row:string,key:int"
    rows = [(1, None, None, None, None, "r", 1), (None, "some words here", "en", "a", 15, None, 2),
            (2, "", "en", "a", 0, "r", 3), (3, "one two three four five six", "en", "a", 27, "r", 4),
            (3, "one two three four five six", "en", "a", 27, "r", 4), (4, "w " * 50_000, "en", None, 100_000, "r", 5)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF), "odd")
            if name != "packing":
                assert out.columns == docs.columns
            if not data:
                assert out.count() == 0
    kept = corpus_pipeline.one_of_each_group(spark, spark.createDataFrame(rows, schema), SF)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_rows_sharing_an_id_lose_only_near_duplicates(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 40), ("b", 60), ("c", 30)))
    rows = [(1, a), (1, b), (2, a), (2, c), (2, c), (3, b + " more"), (4, " "), (4, " "), (4, ""), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (2, c), (4, " "), (4, ""), (None, a)], key=str)


def test_near_copies_leave_no_scraps(spark):
    """Texts that differ from another in one of twelve lines: one whole text of
    each group stays, and nothing of the others."""
    def lines(k):
        return [f"group {k} line {i} has several words of its own" for i in range(12)]

    rows = []
    for k in range(4):
        for copy in range(3):
            text = lines(k)
            if copy:
                text[3 * copy] = f"changed {k} {copy} to other words that stand nowhere else"
            rows.append((10 * k + copy, "\n".join(text), "en", "s", 0))
    rows += [(90, "some text\nwithout any copy", "en", "s", 0), (91, None, "en", "s", 0), (92, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = stored(stage(spark, docs, SF), "scraps")
    # Texts without words are no near duplicates of anything; of several under one id one stays.
    assert {r.doc_id: r.text for r in docs.collect()} == {
        **{10 * k: "\n".join(lines(k)) for k in range(4)}, 90: "some text\nwithout any copy", 91: None, 92: ""}
