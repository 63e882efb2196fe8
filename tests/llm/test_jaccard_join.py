import random
import re

import numpy as np
import pytest

from loomcurate.llm import graphs
from loomcurate.llm import jaccard_join as jj


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {g: min((d for d in ds if d is not None), default=None) for g, ds in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr)


def corpus(seed, groups=25):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=60)
    rows = []
    for _ in range(groups):
        base = rng.choices(words, k=rng.choice([3, 5, 8, 20, 60, 200]))
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                at = rng.randrange(len(copy)) if copy else 0
                copy[at : at + 1] = rng.choice([[], [rng.choice(words)], [*copy[at : at + 1], "Extra"]])
            if rng.random() < 0.4:
                copy += passage
            rows.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in copy) + rng.choice(["", "\n"]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("options", [{}, {"tile": 4}, {"tile": 2}])
def test_equals_brute_force(spark, options):
    rows = corpus(1 + len(options)) + [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "É a b c d"), (907, "é a b c d"), (None, "one"), (908, "lonely text of some words here"), (908, "lonely text of some words here"), (909, "z " * 30_000)]
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], "doc_id long, text string, n int, cls string, component string")
    got = sorted((tuple(r) for r in jj.report(docs, **options).collect()), key=repr)
    assert got == brute(rows)


def test_apply_keeps_one_of_each(spark):
    rows = corpus(9) + [(900, None), (901, ""), (902, ""), (5000, "a b c d e f g"), (5000, "a b c d e f g"), (5001, "a b c d e f g")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, text_digest string")
    out = jj.apply(docs)
    assert out.columns == docs.columns
    want = sorted(d for d, n, c in set(brute(rows)) if d == c)
    assert sorted(r["doc_id"] for r in out.collect()) == want
    assert jj.apply(docs.limit(0)).count() == 0 and jj.report(docs.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1 << 26, 1])
def test_second_scan_finds_the_named_rows(spark, monkeypatch, most):
    monkeypatch.setattr(jj, "NAME_BITS", most)
    rows = [(i if i % 50 else None, f"text number {i} of a few") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = docs.where("hash(text) % 2 = 0").selectExpr("doc_id as wanted_id", "xxhash64(text) as wanted_digest")
    want = {jj.class_of(jj.Shingler()(r["text"])) for r in docs.where("hash(text) % 2 = 0").collect()}
    got = {r["cls"] for r in jj._sets(docs, "doc_id", "text", named).collect()}
    assert want <= got and len(got) < len(want) * 1.2


def test_prefix_length_is_enough():
    for n in range(1, 400):
        assert jj.prefix_length(n) == n - (-(-80 * n // 100)) + 1


def test_tile_links_span_the_components():
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(12):
        base = rng.integers(0, 2**63, size=rng.integers(5, 200), dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            keep = base[rng.random(len(base)) > 0.08]
            sets.append(np.unique(np.concatenate([keep, rng.integers(0, 2**63, size=2, dtype=np.uint64)])))
    want = {(i, j) for i in range(len(sets)) for j in range(i) if jj.linked(sets[i], sets[j])}
    for band in (np.zeros(len(sets), dtype=int), rng.integers(0, 2, size=len(sets))):
        across = {(i, j) for i, j in want if not band.any() or band[i] != band[j]}
        found = jj.tile_links(sets, band)
        assert all((max(p), min(p)) in across for p in found)
        assert parts(len(sets), found) == parts(len(sets), across)


def parts(n, links):
    root = list(range(n))
    for a, b in links:
        ra, rb = root[a], root[b]
        root = [rb if r == ra else r for r in root]
    return {frozenset(i for i in range(n) if root[i] == r) for r in root}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in graphs.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    for part in parts(600, edges):
        if len(part) > 1:
            assert {got[i] for i in part} == {min(part)}
    assert graphs.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_hot_shingles_are_not_dealt_out(spark, monkeypatch):
    """A passage in a third of the documents: no code of it is in a prefix, and no key has more than its bound of rows."""
    monkeypatch.setattr(jj, "HOT_LEAST", 200)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5000)]
    passage = " ".join(rng.choices(words, k=15))
    rows = []
    for d in range(20_000):
        own = " ".join(rng.choices(words, k=40))
        rows.append((d, own + (f" {passage}" if d % 3 == 0 else "")))
    rows += [(20_000, rows[0][1] + " extra"), (20_001, passage), (20_002, passage + " a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sketch = jj.stored(jj._sketch(docs, "doc_id", "text"))
    often = sketch.where("often is not null").selectExpr("explode(often) o").select("o.*")
    prefixes = jj.stored(jj._prefixes(sketch.where("codes is not null"), often, []))
    assert prefixes.where("not hot").groupBy("code").count().agg({"count": "max"}).first()[0] < 200
    stars = jj._stars(prefixes)
    assert stars.groupBy("hub").count().agg({"count": "max"}).first()[0] <= 200  # of 6,667: those with hardly a counted shingle of their own
    found = {r["doc_id"]: r["component_id"] for r in jj.report(docs).collect()}
    assert found[20_000] == 0 and found[20_002] == 20_001 and sum(d != c for d, c in found.items()) == 2


def test_large_stars_meet_across_cells(spark):
    """Near copies of one text, more than a tile holds, some linked only across cells, and others that only share a passage."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for d in range(150):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            copy[rng.randrange(len(copy))] = f"x{d}"
        rows.append((d, " ".join(copy)))
    rows += [(1000 + d, " ".join(base[:8] + [f"y{d}_{i}" for i in range(3 + d % 5)])) for d in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (7, 40):
        assert sorted((tuple(r) for r in jj.report(docs, tile=tile).collect()), key=repr) == brute(rows)
