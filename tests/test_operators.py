import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomcurate import taxonomy
from loomcurate.functions import text as tx
from loomcurate.operators import balance, coverage, gates, keyed, similarity, stats
from loomcurate.settings import Settings, load


def test_keep_first_and_last_wins(spark):
    rows = spark.createDataFrame([("a", 1, 2, "x"), ("a", 1, 1, "y"), ("b", 2, 1, "z"), (None, 3, 1, "n")], "k string, i int, j int, v string")
    assert {r["v"] for r in keyed.keep_first(rows, F.col("k"), "i", "j").collect()} == {"y", "z", "n"}
    assert {r["v"] for r in keyed.last_wins(rows, F.col("k"), "i", "j").collect()} == {"x", "z", "n"}


def test_duplicate_flags_by_id(spark):
    rows = spark.createDataFrame([(1, "A "), (2, "a"), (3, "b"), (4, None), (5, None)], "id int, t string")
    got = {r["id"]: r["is_duplicate"] for r in keyed.duplicate_flags(rows, "id", tx.normalized_hash(F.col("t")), "id").collect()}
    assert got[1] is False and got[2] is True and got[3] is False


def test_resume_and_since(spark):
    rows = spark.createDataFrame([("a", "2020-01-01"), ("b", None), ("c", "2019-01-01")], "id string, d string")
    done = spark.createDataFrame([("a",), (None,)], "done string")
    assert {r["id"] for r in keyed.remaining(rows, "id", done, "done").collect()} == {"b", "c"}
    assert {r["id"] for r in keyed.since(rows, F.to_timestamp("d"), F.to_timestamp(F.lit("2020-01-01"))).collect()} == {"a", "b"}
    assert keyed.first_rows(rows, 0, "id").count() == 3 and keyed.first_rows(rows, 2, "id").count() == 2


def test_seeded_sample_is_stable_and_distinct(spark):
    got = keyed.seeded_sample(spark.range(20).select(F.col("id").cast("string").alias("id")), "id", taxonomy.DOMAINS, 5, 1, "d").collect()
    assert all(len(set(r["d"])) == 5 for r in got) and len({tuple(r["d"]) for r in got}) > 10


def test_taxonomy_sizes():
    assert len(taxonomy.primitive_names()) == 43 and len(taxonomy.DOMAINS) == 15 and len(taxonomy.BRANDS) == 25 and len(taxonomy.priority_names()) == 9
    assert list(Settings().targets().values()) == [1500, 1250, 1000, 500, 500, 250]
    with pytest.raises(ValueError):
        load(None, nothing=1)


@pytest.mark.parametrize("block", [1000, 7])
def test_max_similarity_excludes_self_by_place(spark, block):
    rng = random.Random(1)
    vectors = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(30)]
    data = [(i, v) for i, v in enumerate(vectors)] + [(30, vectors[0]), (31, [-x for x in vectors[1]]), (32, None)]
    got = {r["id"]: r["max_sim"] for r in similarity.max_similarity(spark.createDataFrame(data, "id int, v array<double>"), "id", "v", block).collect()}

    def cos(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) ** 0.5 * sum(x * x for x in b) ** 0.5)

    for i, v in data[:-1]:
        want = max([0.0, *(cos(v, w) for j, w in data[:-1] if j != i)])
        assert abs(got[i] - want) < 2e-6
    assert got[0] == got[30] == 1.0 and got[32] == 0.0


def test_single_and_opposite_vectors(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "id int, v array<double>")
    two = spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0])], "id int, v array<double>")
    assert similarity.max_similarity(one, "id", "v").first()["max_sim"] == 0.0
    assert {r["max_sim"] for r in similarity.max_similarity(two, "id", "v").collect()} == {0.0}


def test_gates_look_at_all_pairs_first(spark):
    long = "word " * 60
    rows = spark.createDataFrame([(1, "Q", "short"), (2, "q ", long), (3, "other", long), (4, "meta", "google " + long), (5, "p", long)], "id int, q string, a string")
    near = spark.createDataFrame([(3, 0.95), (5, 0.93)], "id int, max_sim double")
    flagged = gates.flags(rows, "id", "q", "a", near, Settings())
    assert {r["id"] for r in flagged.where(gates.passes()).collect()} == {5}  # 2 falls though its twin fails by length
    c = gates.reject_counters(flagged).first()
    assert (c["total"], c["passed"], c["rejected_brand"], c["rejected_length"], c["rejected_duplicate"], c["rejected_near_duplicate"]) == (5, 1, 1, 1, 1, 1)


def test_blank_pairs_and_threshold(spark):
    rows = spark.createDataFrame([(1, " ", " "), (2, "x", ""), (3, None, None)], "id int, a string, b string")
    assert [r["id"] for r in gates.drop_blank_pairs(rows, "a", "b").collect()] == [2]
    scores = spark.createDataFrame([(3.49,), (3.5,)], "s double").select(gates.accepted(F.col("s"), Settings()).alias("x")).collect()
    assert [r["x"] for r in scores] == [False, True]


def test_coverage_rules(spark):
    pairs = spark.createDataFrame([("p", "d1")] * 3 + [("p", "zzz"), ("u", "d2")], "primitive string, domain string")
    names = spark.createDataFrame([("p",), ("q",)], "name string")
    domains = spark.createDataFrame([(0, "d2"), (1, "d1")], "position int, name string")
    counts = coverage.matrix(pairs)
    got = {r["primitive"]: (r["domains_covered"], r["missing"]) for r in coverage.undercovered(counts, names, domains, 2).collect()}
    assert got == {"p": (1, ["d2"]), "q": (0, ["d2", "d1"])}
    assert {r["primitive"]: r["deficit"] for r in coverage.priority_gaps(counts, names, 4).collect()} == {"q": 4}  # unknown domains count
    assert {r["domain"] for r in coverage.domain_imbalance(counts, 0.2).collect()} == {"d1"}  # exactly the limit is fine
    r = coverage.report(pairs, names, domains, names, Settings()).first()
    assert r["total_examples"] == 5 and r["unique_primitives"] == 2 and r["passed"] is False


def greedy(pool, n, seed, complexity):
    """The sequential choice: primitives in turn, of each the least used domain, then the best."""
    import hashlib

    by = {}
    for x in pool:
        by.setdefault(x[1], []).append(x)
    order = sorted(by, key=lambda p: hashlib.sha256(f"{seed}:{complexity}:{p}".encode()).hexdigest())
    used, out = {}, []
    while len(out) < n and any(by.values()):
        for p in order:
            if by[p] and len(out) < n:
                best = min(by[p], key=lambda x: (used.get((p, x[2]), 0), -x[3], x[0]))
                by[p].remove(best)
                used[p, best[2]] = used.get((p, best[2]), 0) + 1
                out.append(best[0])
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("pqr"), st.sampled_from("xyz")), min_size=1, max_size=25), st.integers(1, 20))
def test_balance_equals_the_greedy_choice(spark, kinds, n):
    pool = [(i, p, d, float((i * 7919) % 1009)) for i, (p, d) in enumerate(kinds)]
    rows = spark.createDataFrame([(*x, "c") for x in pool] + [(1000, "p", "x", 1.0, "other")], "id int, primitive string, domain string, quality_score double, complexity string")
    got = balance.balanced(rows, balance.targets(spark, {"c": n}), n, 42).orderBy("place").collect()
    assert [r["id"] for r in got] == greedy(pool, n, 42, "c")


def test_sidecar_of_nothing(spark):
    empty = spark.createDataFrame([], "complexity string, primitive string, domain string, quality_score double")
    r = stats.sidecar(empty).first()
    assert r["total_examples"] == 0 and r["avg_quality_score"] == 0.0
