"""Quality scores by Bradley-Terry pairwise ranking."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import each_text, held_out, stored
from fieldcast.llm.textstats import figures
from fieldcast.llm.training import labelled_sample, learnable, logistic
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

UPPER = bytes(range(ord("A"), ord("Z") + 1))
LETTERS = UPPER + UPPER.lower()
DIGITS = b"0123456789"
STOPS = b".!?,;:"
N_SHAPE = 16
LIMIT = 6.0  # standard deviations at which a feature is cut off


def features(text: str | None) -> list[float]:
    """Shape of a text: lengths, shares of kinds of characters, repetition.  Zeros where there is no word."""
    f = figures(text)
    n = len(f.words)
    if not n:
        return [0.0] * N_SHAPE
    data = (text or "").encode("utf-8", "surrogatepass")
    size = len(data)

    def share(kinds: bytes) -> float:
        return (size - len(data.translate(None, kinds))) / size

    times = np.bincount(f.codes)
    letters = share(LETTERS)
    lengths = np.fromiter(map(len, f.distinct), np.int64, len(f.distinct))
    spread = lengths[f.codes]
    chance = times / n
    return [
        math.log1p(n),
        f.n_symbols / max(1, f.word_chars),
        f.n_dup_lines / max(1, f.n_lines),
        f.n_repeat_words / n,
        len(f.distinct) / n,
        float(-(chance * np.log(chance)).sum()) / math.log(n + 1),
        f.word_chars / n,
        float(np.log(spread.max())),
        float((spread <= 3).mean()),
        share(UPPER) / max(letters, 1e-3),
        letters,
        share(DIGITS),
        share(STOPS),
        share(b"!"),
        float((f.codes[1:] == f.codes[:-1]).mean()) if n > 1 else 0.0,
        f.n_lines / n,
    ]


def _expand(raw: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    x = np.clip((raw - mean) / spread, -LIMIT, LIMIT)
    return np.concatenate([x, x * x, np.abs(x)], axis=1)


class Ranking:
    """Feature scale and weights: a document's score is that of a contest against the cut."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray) -> None:
        self.mean, self.spread, self.weights = mean, spread, weights

    def strength(self, raw: np.ndarray) -> np.ndarray:
        return _expand(raw, self.mean, self.spread) @ self.weights


def fit(raw: np.ndarray, label: np.ndarray, pairs: int = 60_000, penalty: float = 10.0, seed: int = 42) -> Ranking:
    """Learn strengths from preference pairs (a document of label 1 over one of label 0).

    The logistic loss acts on differences of features, so no constant is learnt.  Pairs are drawn by ``seed``,
    ``pairs`` of them at most.  The cut is set afterwards (:func:`cut_of`).
    Without documents of both labels all strengths are 0.
    """
    good, bad = raw[label == 1], raw[label == 0]
    if not len(good) or not len(bad):
        return Ranking(np.zeros(raw.shape[1]), np.ones(raw.shape[1]), np.zeros(3 * raw.shape[1]))
    middle = (good.mean(0) + bad.mean(0)) / 2
    spread = np.sqrt((good.var(0) + bad.var(0)) / 2) + 1e-3
    draw = np.random.default_rng(seed)
    n = min(pairs, len(good) * len(bad))
    x_good, x_bad = _expand(good, middle, spread), _expand(bad, middle, spread)
    difference = x_good[draw.integers(len(good), size=n)] - x_bad[draw.integers(len(bad), size=n)]
    # each pair stands for both orders: a preference and its mirror image have the same loss
    weights = logistic(difference, np.ones(n), np.ones(n), penalty)
    return Ranking(middle, spread, weights)


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_class: int = 10_000,
    threshold: float = 0.3,
) -> DataFrame:
    """``docs`` without the text, with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if ``score`` >= ``threshold``).

    The ranking is learnt from about ``per_class`` labelled documents of each class at most, never from held-out ones; the cut
    is that of all of them, however many.
    ``score`` is ``threshold`` where a document's strength lies at the cut.  A null text scores like an empty
    one; a null ``doc_id`` is not held out and never learnt from; repeated rows score alike.  Without labels of both
    classes every score is ``threshold``.  Columns named like a result are replaced; an empty table gives no rows.
    """
    fields = [T.StructField("shape", T.ArrayType(T.DoubleType(), False), False)]
    sample = labelled_sample(docs.select(doc_id, text), labels, label, per_class, doc_id)
    shaped = each_text(sample.select("label", text), F.col(text), lambda: lambda ts: [[features(t) for t in ts]], fields)
    rows = shaped.select("label", "shape").toPandas()
    raw = np.array(rows["shape"].tolist()).reshape(-1, N_SHAPE)
    ranking = fit(raw, rows["label"].to_numpy())
    offset = math.log(threshold / (1 - threshold))

    def make():
        return lambda texts: [ranking.strength(np.array([features(t) for t in texts]).reshape(-1, N_SHAPE))]

    # strengths are worked out once and kept without the texts: the cut needs them all
    kept = [c for c in docs.columns if c != text and c.lower() not in ("held_out", "score", "predicted")]
    strong = each_text(docs.select(*{doc_id: None, **dict.fromkeys(kept)}, text), F.col(text), make, [T.StructField("lm strength", T.DoubleType(), False)])
    strong = stored(strong.drop(text), "quality-strengths")
    cut = cut_of(strong.select(F.col(doc_id).alias("id"), F.col("lm strength").alias("strength")), labels, label, doc_id)
    contest = F.greatest(F.least(F.col("lm strength") - F.lit(cut) + F.lit(offset), F.lit(700.0)), F.lit(-700.0))
    scored = strong.withColumn("score", 1.0 / (1.0 + F.exp(-contest)))
    # a score within rounding of the threshold counts as reaching it
    exact = F.when(F.abs(F.col("score") - threshold) < 1e-12, F.lit(threshold)).otherwise(F.col("score"))
    scored = scored.withColumn("score", exact)
    return scored.select(
        *kept, held_out(F.col(doc_id)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


#: bins of a round, and values that are sorted on the driver, when a quantile is looked for
BINS, FEW = 1024, 1000


def quantile(values: DataFrame, weights: dict[int, float], share: float) -> float:
    """Mean of the first ``strength`` at which the weight of all up to it reaches ``share`` of the whole, and of the next one.

    ``values`` has ``strength`` and ``label``, and a row weighs what its label does.  Rows are counted in bins, round by round, within the
    bin that holds the place, until few are left.
    """
    weigh = lambda row: weights[0] * row["n0"] + weights[1] * (row["n"] - row["n0"])
    sums = [F.count("*").alias("n"), F.count_if(F.col("label") == 0).alias("n0"), F.min("strength").alias("low"), F.max("strength").alias("high")]
    found = values.agg(*sums).first()
    whole, base, above = weigh(found), 0.0, None
    while found["low"] < found["high"] and found["n"] > FEW:
        low, high = found["low"], found["high"]
        bin_of = F.least(F.floor((F.col("strength") - F.lit(low)) / F.lit(high - low) * BINS), F.lit(BINS - 1)).alias("bin")
        bins = values.where(F.col("strength").between(low, high)).groupBy(bin_of).agg(*sums).orderBy("bin").collect()
        at = 0
        while at < len(bins) - 1 and (base + weigh(bins[at])) / whole < share:
            base += weigh(bins[at])
            at += 1
        found, above = bins[at], bins[at + 1]["low"] if at + 1 < len(bins) else above
    if found["low"] == found["high"]:  # equal values, however many
        last = (base + weigh(found) - min(weights.values())) / whole < share
        return (found["low"] + (above if last and above is not None else found["low"])) / 2
    few = values.where(F.col("strength").between(found["low"], found["high"])).select("strength", "label").collect()
    strength, weight = np.array([r[0] for r in few]), np.array([weights[r[1]] for r in few])
    order = np.argsort(strength, kind="stable")
    below = (base + np.cumsum(weight[order])) / (whole if base or above is not None else weight.sum())
    ordered = [*strength[order], *([] if above is None else [above])]
    at = int(np.searchsorted(below, share))
    return float(np.mean([ordered[min(at, len(ordered) - 1)], ordered[min(at + 1, len(ordered) - 1)]]))


def cut_of(strengths: DataFrame, labels: DataFrame, column: str, doc_id: str) -> float:
    """The strength at the quantile that equals the share of label 0 among all labels that may be learnt from, over all their documents."""
    counts = labels.where(F.col(column).isin(0, 1) & ~held_out(F.col(doc_id))).groupBy(column).count().collect()
    share = {r[column]: r["count"] for r in counts}
    values = stored(strengths.join(learnable(labels, column, doc_id), "id").select("label", "strength"), "quality-labelled")
    rows = {r["label"]: r["count"] for r in values.groupBy("label").count().collect()}
    if not share.get(0) or not share.get(1) or not rows.get(0) or not rows.get(1):
        return 0.0
    # documents may come more or less often than their labels; weigh them as the labels have them
    return quantile(values, {k: share[k] / rows[k] for k in (0, 1)}, share[0] / (share[0] + share[1]))
