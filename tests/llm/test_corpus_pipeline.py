"""The pipeline against the brute-force versions of its stages."""

import random

import corpus_pipeline as cp
from test_jaccard_join import brute as near_groups
from test_line_dedup import brute as without_boilerplate
from test_packing import check
from test_quality_rules import brute as counts_of


def write(spark, path):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for d in range(240):
        lines = [" ".join(rng.choices(words, k=rng.randrange(20, 50))) for _ in range(rng.randrange(1, 9))]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(len(lines) + 1), f"boilerplate line number {rng.randrange(3)} for all of the sites")
        rows.append([d, "\n".join(lines), rng.choice(["en", "de", None]), f"site{d % 13}"])
    for d in range(240, 300):  # copies and near copies
        of = rows[rng.randrange(240)]
        rows.append([d, of[1] + rng.choice(["", " extra"]), of[2], f"site{d % 13}"])
    rows += [[300, None, "en", None], [301, "", "en", "site1"], [302, "x " * 400, "en", "site1"], [303, " ".join(f"j{i}###" for i in range(90)), "en", "site2"]]
    rows = [(d, t, lang, s, len(t or "")) for d, t, lang, s in rows]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, 0) for d in range(0, 240)] + [(303, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    rows = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, texts = docs.columns, {}
    out = {}
    for i, (name, stage) in enumerate(cp.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns or i == len(cp.STAGES) - 1
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        out[i] = docs.collect()
    kept = {r["doc_id"] for r in out[0]}
    sound = set()
    for d, t, *_ in rows:
        n, _, _, _, rep = counts_of(t)
        if n >= 50 and 100 * rep <= 50 * n:
            sound.add(d)
    assert kept <= sound and sound - kept <= {303}
    texts = without_boilerplate([(r["doc_id"], r["source"], r["text"]) for r in out[0]], 10)
    assert {r["doc_id"]: r["text"] for r in out[1]} == {d: t for d, t in texts.items() if t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in out[1])
    groups = near_groups([(r["doc_id"], r["text"]) for r in out[1]])
    assert {r["doc_id"] for r in out[2]} == {d for d, _, c in groups if c == d}
    assert {(r["doc_id"], r["text"]) for r in out[3]} <= {(r["doc_id"], r["text"]) for r in out[2]}
    total = [sum(len(r["text"].split()) for r in out[i]) for i in (2, 3)]
    assert abs(total[1] - total[0]) < 0.1 * total[0]
    check([(r["doc_id"], r["text"]) for r in out[3]], out[4], 1024)
    assert cp.run(spark, str(tmp_path)).count() == len(out[4])


def test_results_of_two_runs_stay(spark, tmp_path):
    """What a later run stores and deletes does not touch an earlier run's result."""
    write(spark, tmp_path)
    a = cp.run(spark, str(tmp_path))
    b = cp.run(spark, str(tmp_path))
    first = a.count()
    assert first == b.count() > 0 and a.count() == first
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    lines = cp.lines(spark, docs, str(tmp_path))
    copies = cp.near_duplicates(spark, docs, str(tmp_path))
    assert lines.count() > 0 and copies.count() > 0


def test_stages_of_an_empty_table(spark, tmp_path):
    write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0


def test_stages_with_clashing_columns_and_repeated_rows(spark, tmp_path):
    """Extra columns named like the stages' own stay; repeated rows are one document."""
    rows = write(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = ["counts", "kept", "digest", "text_digest", "gone", "cls", "component", "n", "ref", "size", "number", "target", "sequence_id"]
    wide = docs.union(docs.where("doc_id < 5")).selectExpr("*", *[f"doc_id * 2 as {c}" for c in names])
    for i, (_, stage) in enumerate(cp.STAGES[:-1]):
        out = stage(spark, wide, str(tmp_path))
        assert out.columns == wide.columns, i
        found = out.collect()
        assert found and all(r[c] == (r["doc_id"] * 2) for r in found for c in names)
        wide = cp.stored(out)
    ids = [r["doc_id"] for r in cp.near_duplicates(spark, wide, str(tmp_path)).collect()]
    assert len(ids) == len(set(ids)) <= len(rows)
