"""Every query of the curation pipeline against its SQL, on the smallest tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

from loomcurate.plans.reference_queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, db, name):
    got = QUERIES[name](spark, DATA)
    want = db.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 200
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_coverage_counts_all_pairs(spark, db):
    n, names = db.sql("select (select count(*) from lineitem), (select count(distinct p_brand || '/' || p_size) from part)").fetchall()[0]
    got = QUERIES["coverage_report"](spark, DATA).first()
    assert got["total_examples"] == n and got["unique_primitives"] == names
    assert "l_orderkey" not in ORACLE_SQL["coverage_report"]


def test_coverage_rules_find_what_is_short(spark):
    """The rules decide something: all pairs of the tables are dense at the larger sizes."""
    from loomcurate.operators import coverage
    from loomcurate.settings import Settings

    pairs = spark.createDataFrame([("p", "a")] * 5 + [("p", "b")] + [("q", "a")] * 2, "primitive string, domain string")
    names = spark.createDataFrame([("p",), ("q",), ("r",)], "name string")
    domains = spark.createDataFrame([(0, "a"), (1, "b")], "position int, name string")
    got = coverage.report(pairs, names, domains, names, Settings(min_domains=2, min_priority_examples=3, max_domain_share=0.5)).first()
    assert [tuple(r) for r in got["undercovered_primitives"]] == [("q", 1, 2, ["b"]), ("r", 0, 2, ["a", "b"])]
    assert [tuple(r) for r in got["top10_gaps"]] == [("q", 2, 3, 1), ("r", 0, 3, 3)]
    assert [tuple(r) for r in got["domain_imbalances"]] == [("a", 7, 0.875)]
    assert got["coverage_matrix"] == {"p": {"a": 5, "b": 1}, "q": {"a": 2}} and (got["total_examples"], got["unique_primitives"], got["passed"]) == (8, 2, False)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_pivot_has_every_nation(spark, db):
    names = [r[0] for r in db.sql("select n_name from nation order by n_nationkey").fetchall()]
    got = QUERIES["coverage_pivot"](spark, DATA).toPandas()
    assert list(got.columns) == ["primitive", *names, "Total"]
    assert (got[names].sum(axis=1) == got["Total"]).all() and got["Total"].sum() == db.sql("select count(*) from lineitem").fetchall()[0][0]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
def test_chats_and_prompts_hold_whole_texts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    said = {}
    for r in QUERIES["single_turn_chat"](spark, DATA).orderBy("doc_id", "position").collect():
        said.setdefault(r["doc_id"], []).append(r["content"])
    assert {d: "".join(parts[1:]) for d, parts in said.items()} == texts
    assert all(parts[3] in r["text"] for r in QUERIES["chat_template"](spark, DATA).collect() for parts in [said[r["doc_id"]]])
    assert all(texts[r["doc_id"]].split("{")[0] in r["prompt"] for r in QUERIES["prompt_fill"](spark, DATA).collect())
