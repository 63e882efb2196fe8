import pytest
from pyspark.sql import functions as F

from loomcurate.llm import source_mix as sm


def water(totals):
    """Targets by repeated resharing."""
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: sm.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(totals.values())), set(order)
    while left > 1e-9 and open_:
        share = sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + left * weight[s] / share >= 3 * totals[s]}
        if not full:
            for s in open_:
                target[s] += left * weight[s] / share
            break
        for s in full:
            left -= 3 * totals[s] - target[s]
            target[s] = 3.0 * totals[s]
        open_ -= full
    return target


def rows():
    out = [(i, f"s{i % 7}" if i % 5 else "hot", "w " * (i * 37 % 400)) for i in range(300)]
    out += [(1000, None, "null source " * 300), (1001, "s1", None), (1002, "s1", ""), (1003, "only empty", " \n"), (None, "s2", "no id " * 20), (5, "s2", "same " * 40), (5, "s2", "same " * 40), (1004, "é", "x " * 2000), (1005, "zz", "y " * 9000)]
    return out


@pytest.mark.parametrize("shard_words", [1 << 18, 500])
def test_targets_and_taken(spark, shard_words):
    data = rows()
    docs = spark.createDataFrame([(*r, 1, "c") for r in data], "doc_id long, source string, text string, size int, target string")
    got = sm.report(docs, shard_words=shard_words).collect()
    assert len(got) == len(data)
    size = {s: sum(len((t or "").split()) for _, x, t in data if x == s) for s in {r[1] for r in data}}
    want, source = water(size), {}
    for d, s, t in data:
        source.setdefault((d, len((t or "").split())), s)
    taken = dict.fromkeys(size, 0)
    for r in got:
        s = source[r["doc_id"], r["size"]]
        assert r["source_size"] == size[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    for s, t in taken.items():
        shards = max(1, -(-size[s] // shard_words))
        assert abs(t - want[s]) <= sm.BLOCK_WORDS * (shards + 2)
    again = sm.report(docs.repartition(7), shard_words=shard_words).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_apportion_is_by_highest_quotients(spark):
    weights = [("a", 53.0), ("b", 24.0), ("c", 23.0), ("d", 0.0), ("e", 24.0)]
    for seats in (1, 2, 7, 10, 101):
        quotients = sorted(((-w / (2 * k + 1), m) for m, w in weights if w for k in range(seats)))[:seats]
        df = spark.createDataFrame([(0, m, w, seats) for m, w in weights], "g int, m string, w double, n long")
        got = {r["m"]: r["quota"] for r in sm.apportion(df, ["g"], "m", "w", "n").collect()}
        assert got == {m: sum(q[1] == m for q in quotients) for m, _ in weights}


def test_apply_repeats_and_drops(spark):
    docs = spark.createDataFrame([(i, "a" if i < 5 else "b", "word " * 100, i) for i in range(60)], "doc_id long, source string, text string, mix int")
    out = sm.apply(docs)
    assert out.columns == docs.columns
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert n["a"] == 15 and abs(n["b"] - 45) <= 1  # a is capped at three times its size


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert sm.report(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert [(r["size"], r["target"], r["taken"]) for r in sm.report(blank).select(F.col("size"), "target", "taken").collect()] == [(0, 0.0, 0)] * 2
