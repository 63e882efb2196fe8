import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from loomcurate.llm import license_scan as ls


def full_alignment(template, region):
    """Local alignment score by the whole table."""
    best, row = 0, [0] * (len(region) + 1)
    for x in template:
        new = [0]
        for j, y in enumerate(region):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
            best = max(best, new[-1])
        row = new
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=9), st.lists(st.integers(0, 3), max_size=12))
def test_alignment_score(a, b):
    assert ls.align(np.array(a, dtype=int), np.array(b, dtype=int))[0] == full_alignment(a, b)


def test_every_template_is_found_whole_and_edited():
    rng = random.Random(2)
    for name, text in ls.TEMPLATES.items():
        padded = "éé intro text " + text.upper() + " and the end"
        hit = [m for m in ls.matches(padded) if m[0] == name]
        assert len(hit) == 1 and hit[0][1] == 1.0
        assert padded[hit[0][3] : hit[0][4]].upper() == text.upper().strip('."')[: hit[0][4] - hit[0][3]]
        words = text.split()
        if len(words) > 40:
            edited = [w if rng.random() > 0.08 else "changed" for w in words]
            found = [m for m in ls.matches(" ".join(edited)) if m[0] == name]
            want = full_alignment(ls.split(text)[1], ls.split(" ".join(edited))[1])
            assert found and found[0][1] > 0.8 and found[0][2] >= want


def test_brute_force_candidates():
    """Whatever a full alignment of template and text finds above the limits, the index finds."""
    rng = random.Random(7)
    index = ls._index()
    vocabulary = sorted(index.number)
    for _ in range(40):
        name = rng.choice([n for n in index.names if "notice" in n])
        words = [w.decode() for w in ls.split(ls.TEMPLATES[name])[1]]
        filler = [rng.choice(vocabulary).decode() for _ in range(30)]
        at = rng.randrange(30)
        text = " ".join(filler[:at] + words + filler[at:])
        assert any(m[0] == name and m[1] == 1.0 for m in ls.matches(text))


def test_rows_and_edges(spark):
    mit = ls.TEMPLATES["MIT"]
    rows = [(1, mit), (1, mit), (2, None), (3, ""), (4, "no license here"), (None, "Released under the MIT License."), (5, "filler words " * 30_000 + mit), (6, mit + "\n\n" + mit)]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, license string, start int")
    got = [tuple(r) for r in ls.scan(docs).collect()]
    by = {}
    for r in got:
        by.setdefault(r[0], []).append(r)
    assert set(by) == {1, 5, 6, None} and len(by[1]) == 2 and len(by[6]) == 2
    assert by[5][0][4] == len("filler words " * 30_000) and by[1][0][1:4] == ("MIT", 1.0, len(ls.split(mit)[1]))
    assert ls.scan(docs.limit(0)).count() == 0


def names(text):
    return [m[0] for m in ls.matches(text)]


def test_notices_in_other_words():
    assert names("our code is licensed under the MIT License, as usual") == ["MIT-notice"]
    assert names("SPDX-License-Identifier: MIT") == ["MIT-notice"]
    assert names("This library is released under the Apache License 2.0") == ["Apache-2.0-notice"]
    assert names("Licensed under the GNU Lesser General Public License, version 3") == ["LGPL-3.0-notice"]
    assert names("This work is licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0-notice"]
    assert names("This work is licensed under the GNU Affero General Public License, version 3.") == ["AGPL-3.0-notice"]
    assert names("Made available under the Eclipse Public License 2.0") == ["EPL-2.0-notice"]
    assert names("Licensed under the Some Other License, Version 2.0") == []


def test_family_members_keep_their_names():
    for name, text in (ls.WHOLE | ls.HEADERS).items():
        words = text.split()
        edited = " ".join(w for i, w in enumerate(words) if len(words) < 400 or i % 50)
        found = names(edited)
        assert name in found and {ls._license(n) for n in found} == {ls._license(name)}, (name, found)


def plain_alignment(template, words):
    """(matched, start, end) of the best local alignment (match 1, mismatch and gap -1) at any place, cell by cell."""
    best, row = (0, 0, 0, 0), [(0, 0, j) for j in range(len(words) + 1)]
    for x in template:
        new = [(0, 0, 0)]
        for j, w in enumerate(words, 1):
            fresh = row[j - 1] if row[j - 1][0] > 0 else (0, 0, j - 1)
            cell = (fresh[0] + 1, fresh[1] + 1, fresh[2]) if x == w else (fresh[0] - 1, fresh[1], fresh[2])
            cell = max(cell, (row[j][0] - 1, *row[j][1:]), (new[j - 1][0] - 1, *new[j - 1][1:]))
            new.append(cell if cell[0] > 0 else (0, 0, 0))
            if cell[0] > 0 and cell[:2] > best[:2]:
                best = (*cell, j)
        row = new
    return best[1:]


def plain_rows(text, templates):
    """Every template aligned with the whole text; of overlapping matches of different names the one with most words."""
    words = ls.split(text)[1]
    found = []
    for name, body in templates.items():
        size = len(ls.split(body)[1])
        matched, start, end = plain_alignment(ls.split(body)[1], words)
        if matched >= ls.LEAST_COVERAGE * size and matched >= min(ls.LEAST_WORDS, size):
            found.append((matched, matched / size, name, start, end))
    kept = []
    for m in sorted(found, key=lambda m: (-m[0], -m[1], m[3], m[2])):
        if all(2 * (min(m[4], k[4]) - max(m[3], k[3])) <= min(m[4] - m[3], k[4] - k[3]) for k in kept):
            kept.append(m)
    return sorted((m[2], m[0], m[3], m[4]) for m in kept)


def test_equals_full_alignment_at_every_place():
    templates = {n: ls.WHOLE[n] for n in ("MIT", "ISC", "Zlib", "BSD-2-Clause")} | {n: ls.HEADERS[n] for n in ("Apache-2.0-header", "MPL-2.0-header")}
    small = ls.Index([(n, t, "") for n, t in templates.items()])
    rng = random.Random(21)
    filler = [f"w{i}" for i in range(50)]
    texts = []
    for _ in range(24):
        parts = [" ".join(rng.choices(filler, k=rng.randrange(20)))]
        for name in rng.sample(sorted(templates), rng.choice([0, 1, 1, 2])):
            words = templates[name].split()
            rate = rng.choice([0, 0.03, 0.1])
            words = [x for w in words for x in ([w] if rng.random() >= rate else rng.choice([[], ["changed"], [w, "added"]]))]
            parts += [" ".join(words), " ".join(rng.choices(filler, k=rng.randrange(1, 20)))]
        texts.append(" ".join(parts))
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {}
    for i, t in rows:
        for name, _, matched, start, end in ls.matches(t, small):
            words_before = len(ls.split(t[:start])[1])
            got.setdefault(i, []).append((name, matched, words_before, words_before + len(ls.split(t[start:end])[1])))
    want = {i: r for i, t in rows if (r := plain_rows(t, templates))}
    assert {i: sorted(r) for i, r in got.items()} == want and len(want) > 10
