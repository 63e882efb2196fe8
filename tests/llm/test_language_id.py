import math
import os
import random
import zlib

import numpy as np
import pytest

from loomcurate.llm import language_id as li

WORDS = {"en": ["the", "house", "with", "they", "going", "which"], "fr": ["être", "maison", "quelle", "avec", "où", "jeune"], "de": ["straße", "haus", "nicht", "über", "schön", "welche"]}


def text(rng, lang, n=60):
    return " ".join(rng.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang), lang) for i in range(400) for lang in [rng.choice(list(WORDS))]]
    rows += [(1000, None, "en"), (1001, "", "fr"), (1002, "123 $$ --", "de"), (1005, "½ ²", "de"), (1006, "Ⅷ", "fr"), (1003, "x", None), (None, text(rng, "fr"), "fr"), (5, text(rng, "en"), "en"), (5, text(rng, "en"), "en"), (1004, text(rng, "de", 60_000), None)]
    return spark.createDataFrame([(*r, 1.0, "c") for r in rows], "doc_id long, text string, lang string, score double, languages string")


def test_predictions_and_edges(spark, docs):
    got = {}
    for r in li.report(docs).collect():
        got.setdefault(r["doc_id"], r)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    for d in range(400):
        assert got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
    held = [d for d in range(400) if got[d]["held_out"] and d != 5]
    assert len(held) > 50 and np.mean([got[d]["lang_pred"] == truth[d] for d in held]) >= 0.99
    assert all(got[d]["lang_pred"] == "und" and got[d]["score"] == 0 for d in (1000, 1001, 1002, 1005, 1006))
    assert got[None]["lang_pred"] == "fr" and got[None]["held_out"] is False and got[1004]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert li.report(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in li.report(docs.where("lang is null")).collect()} == {"und"}  # nothing to learn from


def test_mixtures(spark, docs):
    names, model = li.train(docs)
    rng = random.Random(9)
    for a, b in (("en", "fr"), ("de", "en"), ("fr", "de")):
        found = dict(li.proportions(text(rng, a, 300) + " " + text(rng, b, 100), names, model))
        assert set(found) == {a, b} and 0.65 < found[a] < 0.85
    assert li.proportions(text(rng, "en", 300), names, model) == [("en", 1.0)]


def test_mixture_is_the_likelihood_maximum():
    rng = np.random.default_rng(0)
    runs = rng.normal(size=(200, 2))
    part, fit = li.mixture(runs, np.arange(2), steps=500)
    grid = [np.logaddexp(np.log(p) + runs[:, 0], np.log1p(-p) + runs[:, 1]).sum() for p in np.linspace(0.001, 0.999, 999)]
    assert fit == pytest.approx(max(grid), abs=1e-2)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_held_out_accuracy_on_the_tables(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = li.report(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97


def test_rare_languages_are_learned_at_every_size(spark):
    rng = random.Random(3)
    rows = [(i, text(rng, "en", 5), "en") for i in range(4000)] + [(9000 + i, text(rng, "fr"), "fr") for i in range(8)]
    rows += [(j, text(rng, "de"), "de") for j in [next(i for i in range(20_000, 30_000) if zlib.crc32(str(i).encode()) % 5)] * 300]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    names, model = li.train(docs, sample=100)
    assert names == ["de", "en", "fr"]
    for lang in names:
        assert li.proportions(text(rng, lang, 100), names, model)[0][0] == lang


def test_water_level():
    assert li.water_level([5, 10, 4000], 100) == 85 and li.water_level([5, 10], 100) == 10 and li.water_level([], 100) == 0
    assert li.water_level([50, 50, 50, 50], 100) == 25


def plain_features(text):
    """Hashed trigrams by whole numbers."""
    low = text.lower()
    chars = " " + "".join(c if c.isalpha() else " " for i, c in enumerate(low) if c.isalpha() or (i and low[i - 1].isalpha())) + " "
    out = []
    for i in range(len(chars) - 2):
        m = sum(ord(c) * k for c, k in zip(chars[i : i + 3], (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), strict=True)) % 2**64
        m ^= m >> 29
        out.append((m * 0xBF58476D1CE4E5B9 % 2**64) >> 49)
    return out


def plain_mixture(runs, use):
    part = {u: 1 / len(use) for u in use}
    for _ in range(30):
        share = dict.fromkeys(use, 0.0)
        for run in runs:
            joint = {u: part[u] * math.exp(run[u] - max(run[x] for x in use)) for u in use}
            for u in use:
                share[u] += joint[u] / sum(joint.values()) / len(runs)
        done = max(abs(share[u] - part[u]) for u in use) < 1e-4
        part = share
        if done:
            break
    fit = sum(max(r[u] for u in use) + math.log(sum(part[u] * math.exp(r[u] - max(r[x] for x in use)) for u in use)) for r in runs)
    return part, fit


def plain_report(rows):
    """Training and every prediction, in plain loops; all labelled rows outside fold 0 are taken (they fit the sample)."""
    counts = {}
    for d, t, lang in rows:
        if d is not None and zlib.crc32(str(d).encode()) % 5 and lang is not None and any(c.isalpha() for c in t or ""):
            for f in plain_features(t):
                counts.setdefault(lang, {}).setdefault(f, 0)
                counts[lang][f] += 1
    names = sorted(counts)
    totals = {n: sum(counts[n].values()) + li.SMOOTHING * li.FEATURES for n in names}
    out = []
    for d, t, _ in rows:
        if not any(c.isalpha() for c in t or ""):
            out.append((d, "und", 0.0))
            continue
        found = plain_features(t)
        runs = [{n: sum(math.log((counts[n].get(f, 0) + li.SMOOTHING) / totals[n]) for f in found[i : i + 8]) for n in names} for i in range(0, len(found), 8)]
        use = list(names)
        part, fit = plain_mixture(runs, use)
        while len(use) > 1:
            weakest = min(reversed(use), key=lambda u: part[u])
            fewer = [u for u in use if u != weakest]
            new, new_fit = plain_mixture(runs, fewer)
            if fit - new_fit > 0.5 * math.log(max(2, len(runs))):
                break
            use, part, fit = fewer, new, new_fit
        best = max(use, key=lambda u: (part[u], [-ord(c) for c in u]))
        out.append((d, best, part[best]))
    return out


def test_equals_plain_loops(spark):
    rng = random.Random(12)
    rows = [(i, text(rng, lang, rng.randrange(1, 12)) + " " + text(rng, rng.choice(list(WORDS)), rng.choice([0, 0, 6])), lang) for i in range(60) for lang in [rng.choice(list(WORDS))]]
    rows += [(100, "½ ²", "en"), (101, None, "de"), (102, "Ünïté 3 x!", None), (None, text(rng, "de", 4), "de")]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in li.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for d, lang, score in plain_report(rows):
        assert got[d][0] == lang and got[d][1] == pytest.approx(score, abs=2e-3)


def test_long_texts_are_read_whole_in_bounded_memory(spark, docs):
    names, model = li.train(docs)
    rng = random.Random(2)
    whole = (text(rng, "en", 1000) + " ") * 2600 + (text(rng, "fr", 1000) + " ") * 1000  # 20 MB, French at the end
    assert len(whole) > 18_000_000
    runs = li.likelihoods(li.features(whole), model)
    assert len(runs) <= li.MOST_RUNS
    found = dict(li.proportions(whole, names, model))
    assert set(found) == {"en", "fr"} and 0.6 < found["en"] < 0.85
