"""The pipeline: each stage against what it should keep, and the queries' registration."""

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import pytest

from emporia.llm.common import staged
from emporia.llm.op2_quality import ledger, passes

SF = "/root/testdata/sf0.001"


def test_stages_and_queries_are_registered():
    names = list(entry.queries())
    assert len(corpus_pipeline.STAGES) == 5 and "pipeline" in names
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_quality_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(entry.oracle_sql()["op2_quality_ledger"]).fetchall()
    assert sorted(map(tuple, entry.queries()["op2_quality_ledger"](spark, SF).collect())) == sorted(want)


@pytest.fixture(scope="module")
def docs(spark, words):
    prose = lambda a, n=150: ". ".join(" ".join(words[(a + i) % 700 : (a + i) % 700 + 8]) for i in range(0, n, 8)) + "."
    texts = [prose(0), prose(0), prose(0) + " tail", prose(200), "too short", None, "1 " * 90, prose(400) + ' token = "abcdef123456"', prose(500) + " idiot moron"]
    rows = [(i, t, "aa" if i < 6 else None, "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[3]], "doc_id bigint, text string, lang string, source string, n_chars bigint")


def test_stages_keep_what_they_should(spark, docs):
    kept = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = staged(spark, stage(spark, kept, SF), name)
        assert kept.columns == docs.columns, name
        seen.append(sorted(r.doc_id for r in kept.select("doc_id").collect()))
    assert seen == [[0, 1, 2, 3, 3, 7], [0, 1, 2, 3, 3, 7], [0, 3, 7], [0, 3, 7]]
    last = {r.doc_id: r for r in kept.collect()}
    assert last[7].text.endswith("[secret]\"") and last[7].n_chars == len(last[7].text)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert sorted(r.doc_id for r in packed) == [0, 3, 7] and len({r.sequence_id for r in packed}) == 1


def test_near_duplicates_with_null_and_repeated_ids(spark, words):
    prose = lambda a: " ".join(words[a : a + 90])
    rows = [(None, prose(0)), (None, prose(0) + " tail"), (5, prose(150)), (5, prose(300)), (5, prose(300)), (4, prose(300) + " tail"),
            (None, prose(450)), (9, prose(450)), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert len(kept) == 5 and sum(t in (prose(0), prose(0) + " tail") and k is None for k, t in kept) == 1
    assert {(5, prose(150)), (4, prose(300) + " tail"), (9, prose(450)), (None, None)} < set(kept)


def test_stages_on_an_empty_table(spark, docs):
    none = docs.filter("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_run_on_the_small_table(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_a_filter_on_the_ledger_reads_its_bits(spark):
    """The optimizer must not copy the window work into the filter: then it would run per array element."""
    rows = ledger(spark.read.parquet(f"{SF}/documents.parquet")).filter(passes("v3")).select("doc_id")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 1 and plan.count("sort_array") <= 2
    assert rows.count() > 100
