import math

import pytest
from pyspark.sql import functions as F

from loomcurate.llm import quality_rules as qr


def brute(text):
    words = (text or "").split()
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {p for at in windows.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in qr.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t", "one", "a b c a b c", "a a a a a", "x y\nx y\n \nz", "é# $ <b> 中文 *", "the cat sat on the cat sat on the mat", "w " * 20_000, "\n".join(f"line {i % 9} of many" for i in range(3000))]


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "en", 9, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, counts int, tokens string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for r in qr.report(docs, labels).collect():
        n, chars, symbols, dup, rep = brute(TEXTS[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n) and r["kept"] == (not r["base_failed"])


@pytest.mark.parametrize("n,k,p", [(100, 0, 0.02), (500, 3, 0.02), (3000, 40, 0.02), (200_000, 3800, 0.02), (10, 1, 0.3), (7, 0, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, p):
    want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))
    got = spark.createDataFrame([(n, k)], "n long, k long").select(qr.binomial_tail(F.col("n"), F.col("k"), p).alias("x")).first()["x"]
    assert got == pytest.approx(want, rel=1e-8)


def test_thresholds_bound_false_rejections(spark):
    # of 3,000 good documents in "a", 10 have a first score above 0.1; "b" has too few labels; null is a stratum
    scored = [(i, "a", [0.2 if i < 10 else 0.0, 0.0, 0.03]) for i in range(3000)] + [(5000 + i, "b", [0.0] * 3) for i in range(20)] + [(9000 + i, None, [0.0] * 3) for i in range(2000)]
    labels = [(i, 1) for i, _, _ in scored] + [(0, 0), (None, 1), (1, None), (77_777, 1)]
    s, held = spark.createDataFrame(scored, "doc_id long, stratum string, scores array<double>"), spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r["stratum"]: r["cutoffs"] for r in qr.thresholds(s, held, limit=0.06).collect()}
    first = qr.CUTOFFS[0]
    assert "b" not in got and got[None] == [first] * 3 and got["a"] == [first, first, 0.04]  # the third rule spares 0.03
    strict = {r["stratum"]: r["cutoffs"] for r in qr.thresholds(s, held, limit=0.015).collect()}
    assert strict["a"][:2] == [0.2, first]  # ten in three thousand are too many at any lower cutoff


def test_apply_keeps_columns_and_rejects_junk(spark):
    good, junk = " ".join(f"word{i}" for i in range(80)), " ".join(f"w{i}###" for i in range(80))
    rows = [(i, good, "en", "a") for i in range(1500)] + [(10_000, junk, "en", "a"), (10_001, good, None, "a"), (10_001, good, None, "a"), (10_002, "short", "en", "a"), (10_003, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, counts_of_rules string")
    labels = spark.createDataFrame([(i, 1) for i in range(1500)] + [(10_000, 0)], "doc_id long, quality int")
    out = qr.apply(docs, labels)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert 10_000 not in kept and 10_002 not in kept and 10_003 not in kept and kept.count(10_001) == 2 and len(kept) == 1502
    assert qr.apply(docs.limit(0), labels).count() == 0
