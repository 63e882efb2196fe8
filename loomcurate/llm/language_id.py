"""Language identification by multilingual mixture inference.

Training counts hashed character trigrams per language over a bounded, seeded sample of labelled documents (whole texts)
and smooths them to log likelihoods. ``SAMPLE_DOCUMENTS``, the expected size, is dealt out to the languages by a water
level, so no language is left out at any size: those below the level are taken in full, the others share the rest alike. A document is cut into
short runs of trigrams; expectation-maximisation over the runs' likelihoods gives the proportion of each language in it.
The set of languages is chosen by penalised likelihood: the weakest language goes as long as the loss in log likelihood
stays below half the log of the number of runs for its parameter (BIC). The prediction is the language with the
largest proportion, and that proportion is the score.

Training collects a count per language and at most languages x features sums, a size that does not grow with the corpus; documents are then
scored in one pass without a shuffle. Language, source and id are never inputs of a prediction.

Defined cases: null text, and text without any letter, is ``und`` with score 0 (letters are what Unicode calls letters, not
numbers such as one half); with nothing to learn from, every document is ``und``; a null id is neither held out nor trained on;
ties go to the language first in code point order; repeated rows get the same prediction; of very long texts all trigrams
count, in longer runs (``MOST_RUNS``); more than ``MOST_LANGUAGES`` labels are an error; an empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready

FEATURES = 1 << 15
SAMPLE_DOCUMENTS = 6_000
FOLDS = 5
#: Trigrams of a run; a text of more than RUN * MOST_RUNS trigrams is cut into longer runs, so memory is bounded.
RUN, MOST_RUNS = 8, 1 << 16
#: Trigrams whose likelihoods are held at once.
CHUNK = 1 << 16
#: More languages than this are a fault in the labels: the model would not fit a worker.
MOST_LANGUAGES = 2_000
SEEDS = 1 << 40
SMOOTHING = 0.1
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def has_letter(text: str | None) -> bool:
    """Whether any character is a letter: number forms such as one half or a Roman numeral's sign are none."""
    return text is not None and any(map(str.isalpha, text))


def features(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text in order, all that is not a letter read as one space."""
    low = text.lower().encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(low, dtype="<u4")
    letter = _letters()[codes]
    codes = np.where(letter, codes, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate(([32], codes[keep], [32])).astype(np.uint64)
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(49)).astype(np.int64)


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS


def water_level(sizes: list[int], total: int) -> float:
    """The most rows a group may give so that all groups together give ``total``; the largest size if all rows fit."""
    left = float(total)
    for i, n in enumerate(sorted(sizes)):
        share = left / (len(sizes) - i)
        if n > share:
            return share
        left -= n
    return float(max(sizes, default=0))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_DOCUMENTS) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix of their log likelihoods (features x languages)."""
    ready(docs.sparkSession)
    seed = F.pmod(F.xxhash64(F.lit("train"), F.col(key)), F.lit(SEEDS))
    usable = docs.where((fold(F.col(key)) != 0) & F.col(lang).isNotNull())
    usable = usable.where(F.col(text).rlike("\\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"), seed.alias("seed"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n"), F.min("seed").alias("least")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"{len(sizes)} different labels in {lang}; at most {MOST_LANGUAGES} languages can be learned")
    level = water_level([r["n"] for r in sizes], sample)
    # the least seed is always taken, so that repeated ids or a low level leave no language out
    limits = [(r["lang"], SEEDS if r["n"] <= level else max(int(level / r["n"] * SEEDS), r["least"] + 1)) for r in sizes]
    limit = docs.sparkSession.createDataFrame(limits, "lang string, below long")
    taken = usable.join(F.broadcast(limit), "lang").where("seed < below").select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if has_letter(whole := whole.as_py()):
                    found = sums.setdefault(name, np.zeros(FEATURES, dtype=np.int64))
                    found += np.bincount(features(whole), minlength=FEATURES)
        for name, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(found[at])], names=["lang", "feature", "n"])

    summed = taken.mapInArrow(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    found = summed.collect()  # at most languages x FEATURES
    names = sorted({r["lang"] for r in found})
    counts = np.full((FEATURES, len(names)), SMOOTHING)
    column = {name: i for i, name in enumerate(names)}
    for r in found:
        counts[r["feature"], column[r["lang"]]] += r["n"]
    return names, np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)


def likelihoods(found: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Log likelihoods of the runs (runs x languages): runs of ``RUN`` trigrams, or of as many more as keep to ``MOST_RUNS`` runs."""
    length = RUN * -(-len(found) // (RUN * MOST_RUNS))
    step = max(1, CHUNK // length) * length  # whole runs at a time
    parts = [np.add.reduceat(model[found[at : at + step]], np.arange(0, len(found[at : at + step]), length), axis=0, dtype=np.float64) for at in range(0, len(found), step)]
    return np.concatenate(parts)


def mixture(runs: np.ndarray, use: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Proportions of the languages ``use`` for log likelihoods ``runs`` (runs x languages), and the log likelihood."""
    own = runs[:, use]
    top = own.max(axis=1, keepdims=True)
    weight = np.exp(own - top)
    part = np.full(len(use), 1 / len(use))
    for _ in range(steps):
        joint = weight * part
        new = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
        done = np.abs(new - part).max() < 1e-4
        part = new
        if done:
            break
    return part, float(np.log(weight @ part).sum() + top.sum())


def proportions(text: str | None, names: list[str], model: np.ndarray) -> list[tuple[str, float]]:
    """The languages chosen for a text with their proportions, largest first."""
    if not names or not has_letter(text):
        return []
    runs = likelihoods(features(text), model)
    single = runs.sum(axis=0)
    use = np.arange(len(names))
    part, fit = mixture(runs, use)
    price = 0.5 * np.log(max(2, len(runs)))
    while len(use) > 1:
        weakest = len(use) - 1 - int(part[::-1].argmin())  # of equals the last goes
        fewer = np.delete(use, weakest)
        if len(fewer) == 1:
            new_part, new_fit = np.ones(1), float(single[fewer[0]])
        else:
            new_part, new_fit = mixture(runs, fewer)
        if fit - new_fit > price:
            break
        use, part, fit = fewer, new_part, new_fit
    return sorted(((names[u], float(p)) for u, p in zip(use, part, strict=True)), key=lambda x: (-x[1], x[0]))


def predict(docs: DataFrame, names: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, languages (the chosen set with proportions): a row per document."""
    ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES x languages numbers
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [proportions(whole.as_py(), names, sent.value) for whole in batch.column(1)]
            best = [f[0] if f else (UNKNOWN, 0.0) for f in found]
            columns = [batch.column(0), pa.array([b[0] for b in best], pa.string()), pa.array([min(1.0, b[1]) for b in best], pa.float64())]
            columns.append(pa.array([[{"lang": a, "share": b} for a, b in f] for f in found], pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "languages"])

    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row per document."""
    names, model = train(docs, **options)
    predicted = predict(docs, names, model)
    return predicted.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
