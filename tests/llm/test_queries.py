"""The registered queries of the operators beside their SQL, and the pipeline's stages on odd documents."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import rows_of
from vicinal.llm.queries import QUERIES, SHARDS
from vicinal.llm.queries_sql import SQL
from vicinal.llm.url_filters import judge_urls

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    answer = duck.execute(SQL[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, answer.fetchall())


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert SHARDS == 16 and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]


RULES = [("com", "/", "allow"), ("bad.org", "/", "block"), ("good.bad.org", "/a/", "allow")]


def test_trust_and_distrust_follow_links(spark):
    link = '<a href="{}">x</a>'.format
    pages = [
        (1, "https://Site.COM/x", link("https://friend.net/") + link("/own")), (2, "https://bad.org/y", None),
        (3, "https://feeder.net/", link("//bad.org/z")), (4, "https://friend.net/p?q#r", ""), (5, "https://alone.net/", ""),
        (6, None, None), (7, "no scheme", "x"), (8, "http://good.bad.org/a/b", ""), (9, "http://sub.bad.org", ""), (4, "https://friend.net/p?q#r", ""),
    ]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id bigint, url string, html string, verdict string")
    rows = judge_urls(frame, "page_id", "url", "html", RULES).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == 10 and got == {
        1: ("site.com", "/x", "com/", "allow"), 2: ("bad.org", "/y", "bad.org/", "block"), 3: ("feeder.net", "/", None, "block"),
        4: ("friend.net", "/p", None, "allow"), 5: ("alone.net", "/", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("good.bad.org", "/a/b", "good.bad.org/a/", "allow"), 9: ("sub.bad.org", "", None, "allow"),
    }
    scores = {r["host"]: (r["trust"], r["distrust"]) for r in rows}
    assert scores["friend.net"][0] > 0 and scores["feeder.net"][1] > 0 and scores["alone.net"] == (0.0, 0.0)
    assert judge_urls(frame.limit(0), "page_id", "url", "html", RULES).collect() == []


def test_stages_of_odd_documents(spark, sf_dir):
    """Each stage keeps the columns, drops what it must and leaves clean documents alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    clean = docs.filter("lang = 'en'").orderBy("doc_id").select("text").first()["text"]
    rows = [
        (9001, clean, "en", "x", 1), (9002, clean, "en", "x", 1), (9003, None, "en", "x", None), (9004, "", None, None, 0),
        (9005, "123 456", "en", "x", 7), (None, clean + " and more of it", None, "x", 1), (9001, clean, "en", "x", 1), (9006, f"{clean} {item}", "en", "x", 1),
    ]
    odd = spark.createDataFrame(rows, DOCUMENTS).unionByName(docs.limit(60))
    stages = dict(corpus_pipeline.STAGES)
    known = stages["language_id"](spark, odd, sf_dir)
    ids = [r["doc_id"] for r in known.collect()]
    assert known.columns == docs.columns and not {9003, 9004, 9005} & set(ids) and ids.count(9001) == 2 and None in ids
    fewer = {(r["doc_id"], r["text"]) for r in stages["line_dedup"](spark, odd, sf_dir).collect()}
    assert all(i not in (9002,) for i, _ in fewer) and (9003, None) in fewer
    single = stages["jaccard_join"](spark, odd, sf_dir).collect()
    assert [r["doc_id"] for r in single if r["text"] == clean].__len__() == 1 and {r["doc_id"] for r in single} >= {9003, 9004, 9005}
    left = {r["doc_id"] for r in stages["decontamination"](spark, odd, sf_dir).collect()}
    assert 9006 not in left and {9001, 9002, 9003, None} <= left
    packed = stages["packing"](spark, odd, sf_dir)
    assert packed.groupBy("sequence_id").sum("length").selectExpr("max(`sum(length)`)").first()[0] <= corpus_pipeline.CAPACITY
    none = docs.limit(0)
    assert all(stage(spark, none, sf_dir).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_stages_pass_columns_of_any_names_on(spark, sf_dir):
    names = ["score", "n_lines", "_hash", "_th", "component_id", "held_out", "_rest"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).select("*", *[F.lit(n).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns and all(r[n] == n for r in kept.collect() for n in names), name
