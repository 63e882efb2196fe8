import time
from contextlib import suppress
from pathlib import Path
from threading import Event, Thread

import numpy as np
import pytest

from loomcurate.llm import vector_search as vs

SCHEMA = "vec_id long, embedding array<float>, label int, vid string, rank int"


def frame(spark, items):
    plain = [(i, v if v is None else [x if x is None else float(x) for x in v], 0, "x", 1) for i, v in items]
    return spark.createDataFrame(plain, SCHEMA)


def brute(items, nearest=20, every=20):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in items]
    rows = list({(i, v.tobytes()): (i, v) for i, v in rows}.values())
    out = {}
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-float((x * v).sum()), i) for i, v in rows if i != q)
            out[q] = scored[:nearest]
    return out


def results(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(x) for q, x in out.items()}


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 8))
    y = vs.hadamard(x)
    assert np.allclose((x**2).sum(1), (y**2).sum(1)) and np.allclose(vs.hadamard(y), x)


def test_small_tables_are_exact_with_edges(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=6).tolist()) for i in range(90)]
    good += [(200 + i, good[0][1]) for i in range(40)]  # equal vectors: ties to the smaller id
    good += [(300, [float(5 * x) for x in good[3][1]]), (7, good[7][1])]  # a longer vector, a repeated row
    bad = [(401, None), (402, [0.0] * 6), (403, [1.0, None, 0, 0, 0, 0]), (404, [float("nan")] + [1.0] * 5), (405, [float("inf")] + [1.0] * 5), (406, []), (407, [1.0, 2.0]), (None, good[1][1])]
    got, want = results(vs.search(frame(spark, good + bad), exact=True)), brute(good)
    assert set(got) == set(want)
    for q in want:
        assert [r[0] for r in got[q]] == list(range(1, 21))
        assert np.allclose([r[2] for r in got[q]], [-s for s, _ in want[q]], atol=1e-9)
        assert [r[1] for r in got[q]] == [i for _, i in want[q]]


def test_fewer_candidates_than_asked(spark):
    items = [(i, [1.0 * i + 1, 2.0]) for i in range(0, 60, 20)]
    got = results(vs.search(frame(spark, items)))
    assert {q: len(r) for q, r in got.items()} == {0: 2, 20: 2, 40: 2}
    assert vs.search(frame(spark, [])).count() == 0
    assert vs.search(frame(spark, [(20, [1.0])])).count() == 0


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def recall(got, want):
    return sum(len({r[1] for r in got[q]} & {i for _, i in want[q]}) for q in want) / sum(len(w) for w in want.values())


@pytest.mark.parametrize("block_rows", [4096, 300])
def test_recall(spark, monkeypatch, block_rows):
    monkeypatch.setattr(vs, "BLOCK_ROWS", block_rows)
    x = unit(np.random.default_rng(2).normal(size=(3000, 32)))
    items = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = results(vs.search(frame(spark, items))), brute(items)
    assert set(got) == set(want) and all(len(r) == 20 for r in got.values())
    assert recall(got, want) >= 0.9


@pytest.mark.parametrize("n", [30, 100, 250, 600])
def test_recall_on_small_tables(spark, n):
    x = unit(np.random.default_rng(n).normal(size=(n, 64)))
    items = [(i, v.tolist()) for i, v in enumerate(x)]
    assert recall(results(vs.search(frame(spark, items), every=2)), brute(items, every=2)) >= 0.9


def test_share_scored_falls(spark):
    rng = np.random.default_rng(6)
    shares = [vs.share_scored(frame(spark, [(i, v.tolist()) for i, v in enumerate(unit(rng.normal(size=(n, 32))))])) for n in (500, 5_000)]
    assert shares[1] < 0.6 * shares[0] <= 0.9


def test_codes_follow_rows_and_probes_are_the_greatest_margins():
    for n in (1, 7, 100, 3_000, 10**6, 10**9):
        hashes = vs.hash_axes(n, 128)
        size = int(np.prod([2 * h for h in hashes])) if hashes else 1
        assert size <= max(1, n // vs.BUCKET_ROWS) < 4 * size
    x = np.random.default_rng(3).normal(size=(5, 10))
    hashes = [16, 4]
    got = vs.probes(x, 16, hashes, 2, 9)
    for t in range(2):
        a, b = vs.margins(x, 16, t, hashes)
        for i in range(5):
            sums = sorted(((-(a[i, j] + b[i, k]), j * 8 + k) for j in range(32) for k in range(8)))[:9]
            assert {c | t << 56 for _, c in sums} == set(got[i, t * 9 : t * 9 + 9].tolist())
    assert all(vs.codes(x, 16, hashes, 2)[i, t] in got[i] for i in range(5) for t in range(2))


def test_turns_and_parts_find_the_same(spark, monkeypatch):
    x = unit(np.random.default_rng(4).normal(size=(800, 16)))
    rows = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]).cache()
    want = results(vs.search(rows, tables=3))
    for name, value in (("BLOCK_ROWS", 100), ("TURN_BYTES", 1), ("COPIES", 0.1)):
        monkeypatch.setattr(vs, name, value, raising=False)
    assert results(vs.search(rows, tables=3)) == want


def test_disk_grows_with_the_table(spark, monkeypatch):
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    folders = [*local, spark.conf.get("spark.checkpoint.dir").removeprefix("file:")]
    for name, value in (("BLOCK_ROWS", 50), ("TURN_BYTES", 1)):  # a table a turn, in at most BLOCKS blocks
        monkeypatch.setattr(vs, name, value, raising=False)

    def used():
        return sum(p.stat().st_size for f in folders for p in Path(f).rglob("*") if p.is_file())

    def most(n):
        x = unit(np.random.default_rng(5).normal(size=(n, 32)))
        rows, peak, ended = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), [], Event()

        def watch():
            while not ended.wait(0.03):
                with suppress(OSError):
                    peak.append(used())

        spark._jvm.System.gc()
        time.sleep(1)
        floor, thread = used(), Thread(target=watch)
        thread.start()
        vs.search(rows, tables=2)
        ended.set()
        thread.join()
        return max(peak) - floor

    most(500)  # code is compiled, files of the session exist
    assert most(12_000) < 6 * most(3_000)
