import random

from pyspark.sql import functions as F

from loomcurate.llm import line_dedup as ld


def brute(rows, least):
    at = {}
    for d, s, t in rows:
        for i, line in enumerate((t if t is not None else "").split("\n")):
            bare = line.strip(" \t\n\x0b\x0c\r")
            if t is not None and bare:
                at.setdefault(bare, []).append((d, i, s))
    gone = {}
    for places in at.values():
        if len({s for _, _, s in places}) >= least:
            first = min((d, i) for d, i, _ in places)
            for d, i, _ in places:
                if (d, i) != first:
                    gone.setdefault(d, set()).add(i)
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get(d, ())) for d, s, t in rows}


def test_equals_brute_force(spark):
    rng = random.Random(5)
    common = [f"common line {i}" for i in range(30)]
    rows = []
    for d in range(300):
        lines = [rng.choice(common[: 5 + d % 25]) + " " * (d % 3) if rng.random() < 0.4 else f"own {d} {i}" for i in range(rng.randrange(1, 12))]
        rows.append((d, None if d % 17 == 0 else f"site{rng.randrange(1 + d % 14)}", "\n".join(lines)))
    rows += [(1000, "a", None), (1001, "a", ""), (1002, "a", "\n\n"), (1003, "b", "common line 0\n" * 500)]
    docs = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id long, source string, text string, line int, gone string, doc double")
    for least in (2, 5, 10):
        out = ld.clean(docs, min_sites=least)
        assert out.columns == docs.columns
        assert {r["doc_id"]: r["text"] for r in out.collect()} == brute(rows, least)


def test_near_threshold_is_exact(spark):
    rows = [(100 * n + i, f"s{i}", f"on {n} sites") for n in range(80, 121) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = ld.report(docs, min_sites=100, lg_k=5)  # coarse sketches: the band of doubt is wide
    lost = {r["n"] for r in out.where("n_removed > 0").select((F.col("doc_id") / 100).cast("int").alias("n")).distinct().collect()}
    assert {n for n in lost if n < 100} == set() and set(range(100, 116)) <= lost


def test_repeated_rows_and_nothing(spark):
    rows = [(1, f"s{i}", "same\nown") for i in range(12)]
    got = ld.report(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert {(r["n_lines"], r["n_removed"], r["text"]) for r in got} == {(2, 0, "same\nown")}  # one document, whose places are first
    assert ld.report(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
