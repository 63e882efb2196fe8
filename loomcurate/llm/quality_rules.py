"""Quality rules with risk-controlled thresholds.

Every text gets simple counts (words, symbols, repeated lines, repeated three-word windows), and each rule a score, a
share between two of them. A labelled holdout then picks, for each stratum and rule, the smallest cutoff of a fixed grid
whose false rejection rate is certified: with k of n good documents above the cutoff, the exact binomial tail
P(Bin(n, limit / rules) <= k) must not exceed confidence_error / (strata * rules * cutoffs), the Bonferroni share of one
test. So with probability 1 - confidence_error, the rules together lose no stratum more than ``limit`` of its good
documents. Scores are not fitted, so all labelled rows are holdout. Where no cutoff is certified, a rule rejects nothing.

Only DataFrame expressions are used; the counts are computed inside each row, without a shuffle.

Defined cases: null text has no words and fails the base; a null stratum is a stratum of its own; a document with several
labels counts as good if any label says so; labels with null ids or values are ignored; repeated rows are judged alike; texts
of any length are counted whole; an empty table gives no rows, and without labels no cutoff is certified; further columns of
``docs`` are carried along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, bound, fresh, stored, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
#: The rules: symbols per character, repeated share of lines, repeated share of words.
RULES = (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"))
#: Candidate cutoffs of each rule's score, set before seeing data.
CUTOFFS = tuple(round(0.02 * i, 2) for i in range(1, 26))
LIMIT, CONFIDENCE_ERROR = 0.02, 0.05
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a three-word window found at least twice (windows compared by 64-bit hash).

    Hashes sorted with their positions put equal windows side by side, so the cost is n log n for any text.
    """
    n = F.size(tokens)
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        bound(tokens, lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    )

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))

        def positions(a: Column) -> Column:
            last = F.size(a) - 1
            same = F.filter(
                F.sequence(F.lit(0), last),
                lambda i: ((i > 0) & (a[F.greatest(i - 1, F.lit(0))]["h"] == a[i]["h"]))
                | ((i < last) & (a[F.least(i + 1, last)]["h"] == a[i]["h"])),
            )
            return F.sort_array(F.transform(same, lambda i: a[i]["p"]))

        return F.aggregate(
            bound(pairs, positions),
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda s, p: F.struct((s["total"] + p + 3 - F.greatest(p, s["end"])).alias("total"), (p + 3).alias("end")),
            lambda s: s["total"],
        )

    return bound(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))).cast("long")


def counts(text: Column, tokens: Column) -> Column:
    """Struct of the counts; ``tokens`` is the (already computed) word array of ``text``."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return F.struct(
        F.size(tokens).cast("long").alias("n_words"),
        F.char_length(F.translate(whole, BLANKS, "")).cast("long").alias("word_chars"),
        (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(tokens).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    )


def scores(c: Column) -> Column:
    """The rules' scores, in order."""
    return F.array(*[c[a].cast("double") / F.greatest(c[b], F.lit(1)).cast("double") for a, b in RULES])


def base_failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series at n + 9, exact to double precision."""
    z = n.cast("double") + 9.0
    shift = sum((F.log(n.cast("double") + float(i)) for i in range(2, 9)), F.log(n.cast("double") + 1.0))
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k < n p; 1 for larger k, which can never be certified.

    Terms fall from j = k downwards; those beyond 24 standard deviations vanish in double precision.
    """
    nd, kd = n.cast("double"), k.cast("double")
    top = F.exp(_log_factorial(n) - _log_factorial(k) - _log_factorial(n - k) + kd * math.log(p) + (nd - kd) * math.log1p(-p))
    low = F.greatest(F.lit(0).cast("long"), k - F.ceil(F.sqrt(nd) * 12 + 50))
    down = F.when(k > 0, F.sequence(k, low + 1, F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    down = F.when(low + 1 > k, F.array().cast("array<bigint>")).otherwise(down)
    total = F.aggregate(
        down,
        F.struct(top.alias("term"), top.alias("sum")),
        lambda s, j: bound(
            s["term"] * j.cast("double") / (nd - j.cast("double") + 1.0) * ((1 - p) / p),
            lambda t: F.struct(t.alias("term"), (s["sum"] + t).alias("sum")),
        ),
        lambda s: s["sum"],
    )
    return F.when((n == 0) | (kd >= nd * p), F.lit(1.0)).otherwise(total)


def thresholds(scored: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = CONFIDENCE_ERROR, cutoffs=CUTOFFS) -> DataFrame:
    """(stratum, n_good, cutoffs): the smallest certified cutoff of each rule, null where there is none.

    ``scored``: doc_id, stratum, scores (an array, one for each rule); ``labels``: doc_id, quality (1 is good).
    """
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    held = scored.where("scores is not null").join(good.select("doc_id"), "doc_id")
    cells = [(r, i, c) for r in range(len(RULES)) for i, c in enumerate(cutoffs)]
    above = [F.count_if(F.col("scores")[r] > c).alias(f"k{r}_{i}") for r, i, c in cells]
    found = stored(held.groupBy("stratum").agg(F.count("*").alias("n_good"), *above))
    tests = max(1, found.count()) * len(cells)
    trial = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"k{r}_{i}").alias("k")) for r, i, c in cells]))
    trials = found.select("stratum", "n_good", trial.alias("trial")).select("stratum", "n_good", "trial.*")
    passed = trials.where(binomial_tail(F.col("n_good"), F.col("k"), limit / len(RULES)) <= error / tests)
    least = [F.min(F.when(F.col("rule") == r, F.col("cutoff"))) for r in range(len(RULES))]
    return passed.groupBy("stratum", "n_good").agg(F.array(*least).alias("cutoffs"))


def measure(docs: DataFrame, text: str = "text", stratum: str = "lang", keep_columns: list[str] | None = None, into: str = "counts") -> DataFrame:
    """The columns ``keep_columns`` of ``docs`` with a struct ``into``: counts, stratum, scores, base_failed."""
    kept = docs.columns if keep_columns is None else keep_columns
    (tokens, c) = fresh(docs, "tokens", "measured")
    rows = docs.withColumn(tokens, words(docs[text])).withColumn(c, counts(F.col(text), F.col(tokens)))
    return rows.select(
        *kept,
        F.struct(F.col(f"{c}.*"), F.col(stratum).alias("stratum"), scores(F.col(c)).alias("scores"), base_failed(F.col(c)).alias("base_failed")).alias(into),
    )


def judge(measured: DataFrame, labels: DataFrame, into: str = "counts", verdict: str = "kept", **options) -> DataFrame:
    """``measured`` (stored, as it is read twice) with a boolean ``verdict``."""
    scored = measured.select("doc_id", F.col(f"{into}.stratum").alias("stratum"), F.col(f"{into}.scores").alias("scores"))
    at, cut = fresh(measured, "limit_stratum", "limit_cutoffs")
    limits = thresholds(scored, labels, **options).select(F.col("stratum").alias(at), F.col("cutoffs").alias(cut))
    joined = measured.join(limits, F.col(f"{into}.stratum").eqNullSafe(F.col(at)), "left")
    kept = ~F.col(f"{into}.base_failed")
    for r in range(len(RULES)):
        kept = kept & ~F.coalesce(F.col(f"{into}.scores")[r] > F.col(cut)[r], F.lit(False))
    return joined.select(*measured.columns, kept.alias(verdict))


def apply(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that pass, with the same columns."""
    into, verdict = fresh(docs, "counts_of_rules", "kept_by_rules")
    judged = judge(stored(measure(docs, into=into)), labels, into=into, verdict=verdict, **options)
    return judged.where(verdict).select(*docs.columns)


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """A row per document: doc_id, the counts, base_failed, kept."""
    measured = stored(measure(docs.select("doc_id", "text", "lang"), keep_columns=["doc_id"]))
    judged = judge(measured, labels, **options)
    return judged.select("doc_id", *[F.col(f"counts.{c}").alias(c) for c in COUNTS[:5]], F.col("counts.base_failed").alias("base_failed"), "kept")


def oracle(limit: float = LIMIT, error: float = CONFIDENCE_ERROR, cutoffs=CUTOFFS) -> str:
    """DuckDB SQL for ``report`` over the tables documents and labels."""
    grid, share = ", ".join(f"({c})" for c in cutoffs), limit / len(RULES)
    return f"""
with d as (select row_number() over () rid, doc_id, lang, coalesce(text, '') t from documents),
w as (select *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) ls from d),
tri as (select rid, unnest(range(1, len(ws) - 1)) i, ws from w where len(ws) >= 3),
g as (select rid, i, count(*) over (partition by rid, ws[i], ws[i + 1], ws[i + 2]) n from tri),
hit as (select rid, count(distinct p) n from (select rid, unnest([i, i + 1, i + 2]) p from g where n > 1) group by rid),
c as (select doc_id, lang, len(ws)::bigint n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, (len(ls) - len(list_distinct(ls)))::bigint n_dup_lines,
  coalesce(hit.n, 0)::bigint n_repeat_words, len(ls) n_lines from w left join hit using (rid)),
s as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words base_failed,
  [n_symbols::double / greatest(word_chars, 1), n_dup_lines::double / greatest(n_lines, 1), n_repeat_words::double / greatest(n_words, 1)] scores from c),
good as (select doc_id from labels where doc_id is not null and quality is not null group by 1 having max(quality) = 1),
held as (select lang, unnest(scores) score, unnest(range(1, 4)) r from s join good using (doc_id)),
grid(cut) as (values {grid}),
k as (select lang, r, cut, count(*) n, count(*) filter (score > cut) k from held, grid group by 1, 2, 3),
p as (select *, case when k >= n * {share} then 1 else list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({share}) + (n - j) * ln(1 - {share})))) end tail, count(*) over () tests from k),
cutoff as (select lang, min(cut) filter (r = 1) c1, min(cut) filter (r = 2) c2, min(cut) filter (r = 3) c3 from p where tail <= {error} / tests group by 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(scores[1] > c1, false) and not coalesce(scores[2] > c2, false) and not coalesce(scores[3] > c3, false) kept
from s left join cutoff on s.lang is not distinct from cutoff.lang"""
