"""Toxicity from maximum-scoring segments.

A token's score is its log-odds in toxic against other documents with an informative Dirichlet
prior (the prior is ``strength`` of the token's count in both classes), kept where it is
significant, less a small drift. One linear scan per text finds all maximal
scoring segments: stretches whose sum can't be raised by growing or shrinking. A
segment score is compared with what chance gives in a clean text of that length
by extreme-value statistics: lambda solves sum p(w) exp(lambda s(w)) = 1 over clean text,
K is fit on clean documents, and lambda * S - ln(K n) is the normalised score. Segments
above ``significant`` are passages. The document's score is a logistic calibration of its
best normalised score and of the sum over its passages.

The model is fit on at most about ``per_class`` labelled documents of each class, chosen by a hash of the id, each distinct
text once. Token weights come from three quarters of these texts, in which a token counts once per text, so that
neither a word's repetitions nor copies of a text make it significant; all tokens that pass the test are kept, their number being
bounded by the sample. Extreme-value statistics and calibration come from the last quarter. Every text is scored whole.

Null, empty or blank text scores as a text without segments. With only one class
among learned labels, the score is that class's share. Repeated label rows count as toxic if
one is; null labels don't count. Each row gives one row, also repeated rows and
null ids; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import learning_row, stored, texts

SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_passages int, passages array<struct<start:int,end:int,score:double>>"
TOKEN = re.compile(r"\w+")
# Of these hash folds of the labelled sample, the first calibrates.
FOLDS = 4


@dataclass(frozen=True)
class ToxicModel:
    weights: dict[str, float]
    drift: float
    rate: float  # lambda
    log_k: float
    bias: float
    slopes: tuple[float, float]
    significant: float = 3.0


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), by one scan over positive scores."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    # Stack of candidates: start, end, sum before, sum after, place of the nearest one below with a smaller sum before.
    stack: list[tuple[int, int, float, float, int]] = []
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, float(total[i]), float(total[i + 1])
        at = len(stack) - 1
        while True:
            while at >= 0 and stack[at][2] >= left:
                at = stack[at][4]
            if at < 0 or stack[at][3] >= right:
                stack.append((start, end, left, right, at))
                break
            start, left = stack[at][0], stack[at][2]
            below = stack[at][4]
            del stack[at:]
            at = below
    return [(a, b, r - x) for a, b, x, r, _ in stack]


def token_scores(text: str, weights: dict[str, float], drift: float) -> np.ndarray:
    get = weights.get
    return np.array([get(w, 0.0) for w in TOKEN.findall(text.lower())]) - drift


def features(text: str, m: ToxicModel) -> tuple[float, float, list[tuple[int, int, float]]]:
    """Best normalised score, sum over passages, passages."""
    scores = token_scores(text, m.weights, m.drift)
    if not len(scores):
        return 0.0, 0.0, []
    base = m.log_k + np.log(len(scores))
    found = [(a, b, m.rate * s - base) for a, b, s in maximal_segments(scores)]
    best = max((s for _, _, s in found), default=0.0)
    passages = [x for x in found if x[2] >= m.significant]
    return max(best, 0.0), sum((s for _, _, s in passages), 0.0), passages


def karlin_rate(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive solution of sum(shares * exp(rate * scores)) = 1, for a negative mean."""
    low, high = 1e-6, 1.0
    value = lambda r: float((shares * np.exp(np.minimum(r * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return (low + high) / 2


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method for a logistic regression with a constant."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int, text: str, id_column: str) -> DataFrame:
    """``text, toxic, fold`` of learned rows, at most about ``per_class`` of each class, each distinct text once."""
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(learning_row(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    counts = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    draw = F.lit(False)
    for c, n in counts.items():
        draw = draw | ((F.col("toxic") == c) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, per_class / n) * (1 << 30))))
    # About 2 * per_class ids, whatever the tables' size.
    chosen = marked.where(draw).select(F.col("doc_id").alias("id"), "toxic")
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    read = source.join(F.broadcast(chosen), "id").select(F.coalesce("text", F.lit("")).alias("text"), "toxic")
    single = read.groupBy(F.sha2("text", 256).alias("digest")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return stored(single.select("text", "toxic", F.pmod(F.xxhash64("digest"), F.lit(FOLDS)).alias("fold")), "toxic")


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 10_000, strength: float = 0.1, z: float = 3.0, drift: float = 0.05, text: str = "text", id_column: str = "doc_id",
) -> ToxicModel:
    """Learn from labelled rows outside the held-out fifth."""
    sample = labelled_sample(docs, labels, per_class, text, id_column)
    learning, calibrating = sample.where("fold != 0").drop("fold"), sample.where("fold = 0").drop("fold")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, list[int]] = {}
            for t, y in zip(texts(batch["text"]), batch["toxic"].to_pylist()):
                for w in set(TOKEN.findall(t.lower())):
                    seen.setdefault(w, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), *[pa.array([c[i] for c in seen.values()], pa.int64()) for i in (0, 1)]],
                ["token", "clean", "toxic"])

    counted = stored(learning.mapInArrow(count, "token string, clean long, toxic long").groupBy("token").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "tokens")
    n0, n1 = counted.agg(F.sum("clean"), F.sum("toxic")).first()
    share = calibrating.agg(F.avg("toxic")).first()[0]
    if not n0 or not n1:
        p = min(max(share or 0.0, 1e-6), 1 - 1e-6)
        return ToxicModel({}, drift, 1.0, 0.0, float(np.log(p / (1 - p))), (0.0, 0.0))
    prior = strength * (F.col("clean") + F.col("toxic"))
    odds = lambda y, n: F.log((y + prior) / (n + strength * (n0 + n1) - y - prior))
    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    score = delta / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    # Tokens of a bounded sample of texts.
    kept = counted.select("token", "clean", delta.alias("delta"), score.alias("z")).where(F.abs("z") >= z).orderBy("token").collect()
    weights = {r["token"]: float(r["delta"]) for r in kept}
    shares = np.array([r["clean"] / n0 for r in kept] + [0.0])
    shares[-1] = max(0.0, 1 - shares.sum())
    values = np.array([*weights.values(), 0.0]) - drift
    rate = karlin_rate(values, shares)
    plain = ToxicModel(weights, drift, rate, 0.0, 0.0, (0.0, 0.0))

    def measure(m: ToxicModel):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [features(t, m)[:2] for t in texts(batch["text"])]
                yield pa.RecordBatch.from_arrays(
                    [batch["toxic"], *[pa.array([float(r[i]) for r in rows], pa.float64()) for i in (0, 1)]], ["toxic", "best", "total"])

        # At most about 2 * per_class rows of three numbers.
        rows = calibrating.mapInArrow(run, "toxic int, best double, total double").collect()
        return np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 3)

    # K from the mean of the largest normalised scores of clean texts: ln K + Euler's constant. Zeros are texts without a segment.
    table = measure(plain)
    clean = table[(table[:, 0] == 0) & (table[:, 1] > 0), 1]
    log_k = float(np.median(clean) + np.log(np.log(2))) if len(clean) else 0.0
    fitted = ToxicModel(weights, drift, rate, log_k, 0.0, (0.0, 0.0))
    table = measure(fitted)
    # Classes drawn at different rates are weighed back by the labels' own shares.
    w = logistic(np.log1p(table[:, 1:]), table[:, 0])
    truth = labels.where("toxic is not null").where(learning_row(F.col("doc_id"))).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    truth, share = min(max(truth, 1e-6), 1 - 1e-6), min(max(share, 1e-6), 1 - 1e-6)
    bias = w[0] + np.log(truth / (1 - truth)) - np.log(share / (1 - share))
    return ToxicModel(weights, drift, rate, log_k, float(bias), (float(w[1]), float(w[2])))


def score(docs: DataFrame, model: ToxicModel, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, passages`` (token positions) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for t in texts(batch["text"]):
                best, total, found = features(t, model)
                x = model.bias + model.slopes[0] * np.log1p(best) + model.slopes[1] * np.log1p(total)
                scores.append(float(1 / (1 + np.exp(-np.clip(x, -50, 50)))))
                passages.append([{"start": a, "end": b, "score": s} for a, b, s in found])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array([len(p) for p in passages], pa.int32()), pa.array(passages, kind)],
                ["doc_id", "held_out", "score", "predicted", "n_passages", "passages"])

    source = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), (~learning_row(F.col(id_column))).alias("held_out"), F.col(text).alias("text"))
    return source.mapInArrow(run, SCHEMA)
