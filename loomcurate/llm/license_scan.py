"""License scans: winnowed fingerprints find candidates, banded alignment confirms them.

Templates (whole texts, headers and notices of common licenses, ``license_texts``) are split into lower-case ASCII words; every four-word gram gets
a code, and of each window of grams the one with the least hash is kept with its place: the inverted index. A document
looks all its grams up, so any match of WINDOW + GRAM - 1 words or more in a row is found. Hits of a template that lie
close together make a candidate region; a local alignment of template and region, limited to a band round the hits'
diagonals, gives the matched words, the share of the template they cover, and the span in the text. A notice must hold
the license's name word for word. Of overlapping matches of different licenses (GPL, LGPL and AGPL share most words) only
the one with most matched words is reported, of equals the one that covers more of its template.

One pass inside each document, no shuffle; the index is a constant and travels with the code.

Defined cases: null and empty texts match nothing; a document has a row for every match, so none at all without one;
repeated rows match each; overlapping matches of one name are reported once, the best first; spans are code points
of the whole text, end exclusive; case, punctuation and line breaks do not matter; texts of any length are searched whole; an
empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ready
from .license_texts import HEADERS, WHOLE, notices

GRAM, WINDOW = 4, 2
#: Least share of a template that a reported match covers, and least words (all of a template with fewer).
LEAST_COVERAGE, LEAST_WORDS = 0.6, 5
#: One text of each name, for the table of the README; notices have more wordings.
TEMPLATES = WHOLE | HEADERS | {name: text for name, text, _ in reversed(notices())}

_WORD = re.compile(rb"[a-z0-9]+")
_SPACED = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789" else 32 for c in range(256))


def split(text: str) -> tuple[bytes, list[bytes]]:
    """The lower-cased bytes of a text, and its words."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    return raw, raw.translate(_SPACED).split()


class Index:
    """Winnowed grams of the templates: sorted codes, and for each the templates and places that have it."""

    def __init__(self, templates: list[tuple[str, str, str]]):
        """``templates``: name, text, and what a match must hold word for word ("" for nothing)."""
        templates = sorted(templates)
        self.names = [n for n, _, _ in templates]
        self.held = [b" " + b" ".join(split(h)[1]) + b" " for _, _, h in templates]
        words = [split(text)[1] for _, text, _ in templates]
        self.number = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.words = [np.array([self.number[w] for w in ws], dtype=np.int64) for ws in words]
        self.counts = [np.unique(ids, return_counts=True) for ids in self.words]
        at: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.words):
            codes = self.codes(ids)
            rank = codes * 0x9E3779B1 % 2**31
            kept = {min(range(i, min(i + WINDOW, len(codes))), key=lambda j: (rank[j], -j)) for i in range(max(1, len(codes) - WINDOW + 1))} if len(codes) else set()
            for i in sorted(kept):
                at.setdefault(int(codes[i]), []).append((t, i))
        self.sorted = np.array(sorted(at), dtype=np.int64)
        self.at = at

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """A code for each gram, -1 where a word is unknown."""
        if len(ids) < GRAM:
            return np.zeros(0, dtype=np.int64)
        views = [ids[i : len(ids) - GRAM + 1 + i] for i in range(GRAM)]
        out, known = np.zeros(len(views[0]), dtype=np.int64), np.ones(len(views[0]), dtype=bool)
        for v in views:
            out, known = out * len(self.number) + v, known & (v >= 0)
        return np.where(known, out, -1)

    def hits(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, place in the document, place in the template)."""
        codes = self.codes(ids)
        places = np.flatnonzero(codes >= 0)
        if not len(places):
            return []
        near = np.minimum(np.searchsorted(self.sorted, codes[places]), len(self.sorted) - 1)
        places = places[self.sorted[near] == codes[places]]
        return [(t, int(p), q) for p in places for t, q in self.at[int(codes[p])]]


@lru_cache(maxsize=1)
def _index() -> Index:
    return Index([(name, text, "") for name, text in (WHOLE | HEADERS).items()] + notices())


def align(template: np.ndarray, region: np.ndarray, low: int | None = None, high: int | None = None) -> tuple[int, int, int, int]:
    """Best local alignment (match 1, mismatch and gap -1): score, matched words, start and end in the region.

    Only cells with low <= place in region - place in template <= high are filled; without limits, all of them.
    """
    n = len(region)
    low, high = -len(template) if low is None else low, n if high is None else high
    # a cell is one number: score, matched words, start; the larger is the better alignment that ends there, 0 is none
    word, point = 1 << 20, 1 << 40
    at = np.arange(n, dtype=np.int64)
    best, end, row = 0, 0, np.zeros(n + 1, dtype=np.int64)
    for i, x in enumerate(template.tolist()):
        new = np.zeros(n + 1, dtype=np.int64)
        a, b = max(0, i + low), min(n, i + high + 1)
        if a < b:
            js, before = at[a:b], row[a:b]
            cell = np.where(before > 0, before, js) + np.where(region[a:b] == x, point + word, -point)
            cell = np.maximum(cell, row[a + 1 : b + 1] - point)
            steps = at[: b - a] * point
            cell = np.maximum.accumulate(cell + steps) - steps  # gaps in the template
            cell[cell < point] = 0
            new[a + 1 : b + 1] = cell
            if (top := int(cell.max())) // word > best // word:
                best, end = top, a + int(cell.argmax()) + 1
        row = new
    return best // point, best // word % word, best % word, end


def _could(index: Index, t: int, region: np.ndarray) -> bool:
    """Whether the words of a region, in any order, suffice for a match of the template."""
    known, counts = index.counts[t]
    there = np.bincount(region[region >= 0], minlength=len(index.number))
    return _enough(int(np.minimum(there[known], counts).sum()), len(index.words[t]))


def _enough(matched: int, size: int) -> bool:
    return matched >= min(LEAST_WORDS, size) and matched >= LEAST_COVERAGE * size


def _groups(hits: list[tuple[int, int]], size: int, slack: int) -> list[list[tuple[int, int]]]:
    """Hits of one template by copies: diagonals of one copy lie within the slack of each other. Largest first."""
    out: list[list[tuple[int, int]]] = []
    current: list[list[tuple[int, int]]] = []
    for p, q in hits:
        current = [g for g in current if p - g[0][0] <= 2 * size]
        fit = [g for g in current if abs((p - q) - (g[-1][0] - g[-1][1])) <= slack]
        if fit:
            min(fit, key=lambda g: abs((p - q) - (g[-1][0] - g[-1][1]))).append((p, q))
        else:
            current.append([(p, q)])
            out.append(current[-1])
    return sorted(out, key=lambda g: (-len(g), g[0]))


def _license(name: str) -> str:
    return name.removesuffix("-notice").removesuffix("-header")


def matches(text: str | None, index: Index | None = None) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, matched words, start, end), by start, then license."""
    index = index or _index()
    if not text:
        return []
    raw, words = split(text)
    get = index.number.get
    ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
    hits = index.hits(ids)
    if not hits:
        return []
    found: list[tuple[int, int, int, int]] = []
    line = b" " + b" ".join(words) + b" "
    by: dict[int, list[tuple[int, int]]] = {}
    for t, p, q in hits:
        by.setdefault(t, []).append((p, q))
    holds = {h: h.strip() == b"" or h in line for h in {index.held[t] for t in by}}
    for t in sorted(by):
        if not holds[index.held[t]]:
            continue
        size = len(index.words[t])
        slack = 4 + size // 8
        spans: list[tuple[int, int]] = []
        for group in _groups(sorted(by[t]), size, slack):
            if all(any(a <= p < b for a, b in spans) for p, _ in group):
                continue  # grams that occur more than once in a copy already found
            diagonals = [p - q for p, q in group]
            first = max(0, min(diagonals) - slack)
            region = ids[first : max(diagonals) + size + slack]
            if not _could(index, t, region):
                continue
            _, matched, start, end = align(index.words[t], region, min(diagonals) - first - slack, max(diagonals) - first + slack)
            start, end = first + start, first + end
            if _enough(matched, size) and (not index.held[t].strip() or index.held[t] in b" " + b" ".join(words[start:end]) + b" "):
                spans.append((start, end))
                found.append((matched, t, start, end))
    share = lambda m: m[0] / len(index.words[m[1]])
    one: dict[str, list[tuple[int, int, int, int]]] = {}  # of a name's overlapping matches the one that covers most
    for m in sorted(found, key=lambda m: (-share(m), -m[0], m[2], m[1])):
        mine = one.setdefault(index.names[m[1]], [])
        if all(m[3] <= k[2] or m[2] >= k[3] for k in mine):
            mine.append(m)
    kept: list[tuple[int, int, int, int]] = []
    for m in sorted((m for mine in one.values() for m in mine), key=lambda m: (-m[0], -share(m), m[2], m[1])):
        rivals = [k for k in kept if _license(index.names[k[1]]) != _license(index.names[m[1]])]
        if all(2 * (min(m[3], k[3]) - max(m[2], k[2])) <= min(m[3] - m[2], k[3] - k[2]) for k in rivals):
            kept.append(m)
    if not kept:
        return []
    edges = [(w.start(), w.end()) for w in _WORD.finditer(raw)]
    point = (lambda b: b) if len(raw) == len(text) else (lambda b: len(raw[:b].decode("utf-8", "surrogatepass")))
    out = [(index.names[t], m / len(index.words[t]), m, point(edges[a][0]), point(edges[b - 1][1])) for m, t, a, b in kept]
    return sorted(out, key=lambda m: (m[3], m[0], m[4]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, license, coverage, matched_words, start, end: a row per match."""
    ready(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index()
        for batch in batches:
            rows = [(doc, *m) for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in matches(whole.as_py(), index)]
            types = [batch.schema.types[0], pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "license", "coverage", "matched_words", "start", "end"])

    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, license string, coverage double, matched_words long, start long, end long")
