"""Toxicity by a weighted finite-state grammar over clauses, with insults learnt from labels."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcast.llm.common import each_text, held_out, stored
from fieldcast.llm.grammar import NEGATIONS, REPORTS, TARGETS, THREATS, clause_grammar, clause_weight
from fieldcast.llm.training import labelled_sample, logistic
from fieldcast.session import send_with_tasks

send_with_tasks(__name__)

TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n]|[\"“”«»„]")
ENDS, QUOTES = set(".!?;\n"), set("\"“”«»„")
PREFIXES = range(3, 8)
N_FEATURES = 6
FLUSH = 200_000
MOST = 4  # times that a term counts in a text when weights are learnt


def terms(text: str | None) -> set[str]:
    """Words of a text in lower case, and beginnings of its words as ``stem*``."""
    words = {t for t in TOKEN.findall((text or "").lower()) if t[0].isalpha()}
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


class Lexicon:
    """Classes of words: learnt insults with their weights, and the closed classes of the grammar."""

    def __init__(self, insults: dict[str, float]) -> None:
        self.insults = insults
        self.table = clause_grammar()
        self.closed = {}
        for symbol, listed in (("r", REPORTS), ("t", THREATS), ("n", NEGATIONS), ("y", TARGETS)):
            self.closed.update(dict.fromkeys(listed.split(), symbol))
        self.seen: dict[str, tuple[str, float]] = {}

    def classify(self, token: str) -> tuple[str, float]:
        known = self.seen.get(token)
        if known is None:
            if len(self.seen) > FLUSH:
                self.seen.clear()
            known = self.seen[token] = self._class(token)
        return known

    def _class(self, token: str) -> tuple[str, float]:
        if token in ENDS:
            return ".", 0.0
        if token in QUOTES:
            return "q", 0.0
        term = self.term(token)
        return ("i", self.insults[term]) if term else (self.closed.get(token, "o"), 0.0)

    def term(self, token: str) -> str | None:
        """The entry that a word matches: itself, or else its longest stem."""
        stems = (token[:k] + "*" for k in reversed(PREFIXES) if len(token) > k)
        return next((t for t in (token, *stems) if t in self.insults), None)

    def features(self, text: str | None) -> list[float]:
        """What the grammar finds in a whole text: weights of its clauses, matches, the heaviest clause."""
        classes = [self.classify(t) for t in TOKEN.findall((text or "").lower())]
        kinds = {c for c, _ in classes}
        total = heaviest = 0.0
        matches = clauses = 0
        if kinds & {"i", "t"}:
            clause: list[tuple[str, float]] = []
            for item in [*classes, (".", 0.0)]:
                if item[0] != ".":
                    clause.append(item)
                    continue
                if clause:
                    weight, found = clause_weight(self.table, clause)
                    total, matches, clauses = total + weight, matches + found, clauses + (found > 0)
                    heaviest = max(heaviest, weight)
                clause = []
        return [1.0, math.log1p(total), math.log1p(heaviest), math.log1p(matches), math.log1p(clauses), float(matches > 0)]


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, pos, neg): in how many texts of each label a term is, summed within the task."""
    pos: Counter = Counter()
    neg: Counter = Counter()

    def flush() -> pa.RecordBatch:
        names = list(pos.keys() | neg.keys())
        columns = [pa.array(names, pa.string()), *(pa.array([c[t] for t in names], pa.int64()) for c in (pos, neg))]
        pos.clear()
        neg.clear()
        return pa.RecordBatch.from_arrays(columns, names=["term", "pos", "neg"])

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (pos if label else neg).update(terms(text))
            if len(pos) + len(neg) > FLUSH:
                yield flush()
    yield flush()


def learn_insults(sample: DataFrame, least: int = 3, purity: float = 0.8, depth: int = 3) -> dict[str, float]:
    """Terms that mark toxic texts, with their weights.

    Candidates are words and stems in ``least`` toxic texts and 0.2 % of them at least, whose share among toxic
    texts outweighs that among clean ones as ``purity`` says; the sample bounds their number.  Then the cover is
    greedy: again and again the term that covers most toxic texts, until every text has ``depth`` terms or no
    term reaches ``least`` more texts (or 0.1 % of them).  Terms that only happen to stand beside insults don't get in.
    Weights are those of a logistic fit on how often each chosen term stands in a text, negative ones left out.
    """
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n_pos, n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not n_pos or not n_neg:
        return {}
    counted = sample.select("text", "label").mapInArrow(_count_terms, "term string, pos long, neg long")
    counted = counted.groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    p, n = (F.col("pos") + 0.5) / (n_pos + 1), (F.col("neg") + 0.5) / (n_neg + 1)
    pure = counted.where((F.col("pos") >= max(least, 0.002 * n_pos)) & (p >= purity * (p + n)))
    heavy = pure.select("term", F.log(p / n).alias("weight"), "pos")
    found = {r["term"]: (r["weight"], r["pos"]) for r in heavy.collect()}
    if not found:
        return {}

    def make():
        return lambda batch: [[sorted(found.keys() & terms(t)) for t in batch]]

    fields = [T.StructField("hits", T.ArrayType(T.StringType(), False), False)]
    toxic = each_text(sample.where("label = 1").select("text"), F.col("text"), make, fields)
    texts = [r["hits"] for r in toxic.select("hits").collect()]
    holding: dict[str, set[int]] = {}
    for k, names in enumerate(texts):
        for name in names:
            holding.setdefault(name, set()).add(k)
    covered = np.zeros(len(texts), int)
    chosen: list[str] = []
    gain = {t: len(ks) for t, ks in holding.items()}
    need = max(least, 0.001 * n_pos)
    while gain:
        best = max(gain, key=lambda t: (gain[t], found[t][0], len(t), t))
        if gain.pop(best) < need:
            break
        chosen.append(best)
        for k in holding[best]:
            covered[k] += 1
            if covered[k] == depth:
                for other in texts[k]:
                    if other in gain:
                        gain[other] -= 1
    return _weigh(sample, chosen)


def _weigh(sample: DataFrame, chosen: list[str]) -> dict[str, float]:
    place = {t: k for k, t in enumerate(chosen)}
    lexicon = Lexicon(dict.fromkeys(chosen, 1.0))

    def make():
        def matches(text: str | None) -> list[int]:
            found = (lexicon.term(t) for t in TOKEN.findall((text or "").lower()))
            return [place[t] for t in found if t]

        return lambda batch: [[matches(t) for t in batch]]

    fields = [T.StructField("matches", T.ArrayType(T.IntegerType(), False), False)]
    rows = each_text(sample, F.col("text"), make, fields).select("label", "matches").collect()
    y = np.array([r["label"] for r in rows], float)
    x = np.zeros((len(rows), len(chosen) + 1))
    for k, r in enumerate(rows):
        x[k, :-1] = np.minimum(np.bincount(r["matches"], minlength=len(chosen)), MOST)
    x[:, -1] = 10.0
    stay = np.arange(len(chosen))
    while len(stay):
        beta = logistic(x[:, [*stay, len(chosen)]], y, np.ones(len(y)), penalty=0.1)[:-1]
        if (beta > 0).all():
            return {chosen[k]: float(b) for k, b in zip(stay, beta, strict=True)}
        stay = stay[beta > 0]
    return {}


def score(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = 5_000,
    threshold: float = 0.5,
) -> DataFrame:
    """``docs`` without the text, with ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 if ``score`` >= ``threshold``).

    Insults and the weights of what the grammar finds are learnt from about ``per_class`` labelled documents of
    each class at most, never from held-out ones.  A null text scores like an empty one; a null ``doc_id`` is not held
    out and never learnt from; repeated rows score alike.  Without labels of both classes nothing is known to be an
    insult and scores are the share of label 1.  Columns named like a result are replaced; an empty table gives no rows.
    """
    source = docs.select(F.col(doc_id).alias("id0"), F.col(text).alias("text"))
    sample = stored(labelled_sample(source, labels.withColumnRenamed(doc_id, "id0"), label, per_class, "id0").select("text", "label"), "toxicity-sample")
    insults = learn_insults(sample)
    lexicon = Lexicon(insults)
    fields = [T.StructField("found", T.ArrayType(T.DoubleType(), False), False)]
    rows = each_text(sample, F.col("text"), lambda: lambda ts: [[lexicon.features(t) for t in ts]], fields)
    rows = rows.select("label", "found").toPandas()
    x, y = np.array(rows["found"].tolist()).reshape(-1, N_FEATURES), rows["label"].to_numpy()
    beta = weights_of(x, y, labels, label, doc_id)

    def make():
        def job(texts):
            got = np.array([lexicon.features(t) for t in texts]).reshape(-1, N_FEATURES)
            return [1.0 / (1.0 + np.exp(-np.clip(got @ beta, -700, 700)))]

        return job

    kept = [c for c in docs.columns if c != text and c.lower() not in ("held_out", "score", "predicted")]
    scored = each_text(docs, F.col(text), make, [T.StructField("score", T.DoubleType(), False)])
    return scored.select(
        *kept, held_out(F.col(doc_id)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def weights_of(x: np.ndarray, y: np.ndarray, labels: DataFrame, column: str, doc_id: str) -> np.ndarray:
    """Logistic weights of the features; classes count as often as the labels that may be learnt from have them."""
    counts = labels.where(F.col(column).isin(0, 1) & ~held_out(F.col(doc_id))).groupBy(column).count().collect()
    share = {r[column]: r["count"] for r in counts}
    total = sum(share.values())
    if not share.get(0) or not share.get(1) or not (y == 0).any() or not (y == 1).any():
        rate = (share.get(1, 0) + 0.5) / (total + 1)
        return np.array([math.log(rate / (1 - rate)), *[0.0] * (N_FEATURES - 1)])
    weight = np.where(y == 1, share[1] / (y == 1).sum(), share[0] / (y == 0).sum()) * len(y) / total
    return logistic(x, y.astype(float), weight, penalty=0.05)
