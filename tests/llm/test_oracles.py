"""The queries of the training-data operators against their SQL, on small tables of their own."""

import random

import duckdb
import pytest

from loomcurate.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    rng = random.Random(31)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for d in range(160):
        lines = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 7))]
        lines += rng.choices(["shared line of all sites", "", "  another shared line ", "### $$$ |||"], k=rng.randrange(3))
        rows.append((d, "\n".join(lines), rng.choice(["en", "de", None]), rng.choice([f"site{d % 14}", "hot", None])))
    rows += [(200 + i, rows[i][1] + rng.choice(["", " one more"]), "en", "site3") for i in range(40)]
    rows += [(300, None, "en", "site1"), (301, "", "de", None), (302, " \t\n", None, "hot"), (303, "x " * 3000, "en", "hot"), (304, "é Ünï a b", "en", "site2"), (305, "É Ünï A B", "en", "site2")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], rng.choice([0, 1, 1, 1]), 0) for r in rows[:150]] + [(3, 1, 0), (None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet/*.parquet'")
    got, want = queries.QUERIES[name](spark, folder), con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda columns, rows: sorted((tuple(round(v[i], 6) if isinstance(v[i], float) else v[i] for i in sorted(range(len(columns)), key=columns.__getitem__)) for v in rows), key=repr)
    assert plain(got.columns, got.collect()) == plain(want.columns, want.fetchall())
