"""Toxicity by non-negative positive-unlabelled learning.

Positives are rows labelled toxic; all other rows to learn from, labelled or not, are
unlabelled text.  With the class prior p and the losses l(+), l(-) of a linear classifier
the risk is

    p * mean(l(+) on positives) + max(0, mean(l(-) on unlabelled) - p * mean(l(-) on positives)),

so that a negative estimate of the negatives' risk is pushed back up instead of followed.

Features are words and beginnings of words, present or not.  Spark counts all of them over the
positive and the unlabelled rows to learn from and keeps those whose shares differ most, of any
frequency from `least_documents` on; numpy trains on their presence.  Bounds, all on the fit
only: `most_positive` and `most_unlabelled` documents by hash, and `most_features` weights of the model.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import crc_mod, short_batches, slices
from lenstrail.sources.tables import cut_lineage

_WORD = re.compile(r"[^\W\d_]+")
STARTS = (4, 5, 6)


def features(text: str) -> set[str]:
    """Words, and with a leading ^ the beginnings of longer words."""
    words = set(_WORD.findall(text.lower()))
    found = set(words)
    for n in STARTS:
        found.update("^" + w[:n] for w in words if len(w) > n)
    return found


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        whole = {f: w for f, w in self.weights.items() if f[0] != "^"}
        starts = {n: {f[1:]: w for f, w in self.weights.items() if f[0] == "^" and len(f) == n + 1} for n in STARTS}
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            words = set(_WORD.findall(text.lower()))
            z = self.bias + sum(whole[w] for w in sorted(words & whole.keys()))
            for n, kept in starts.items():
                hit = {w[:n] for w in words if len(w) > n} & kept.keys()
                z += sum(kept[w] for w in sorted(hit))
            out[i] = z
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, steps: int = 400, rate: float = 0.05, ridge: float = 2e-4):
    """Weights and bias of the logistic classifier by Adam on the non-negative risk.

    Where the estimated risk of negatives falls below 0, the step goes up on that part alone.
    """
    n = positive.shape[1]
    w = np.zeros(n + 1)
    first, second = np.zeros(n + 1), np.zeros(n + 1)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    kind = positive.dtype
    for step in range(1, steps + 1):
        v = w[:n].astype(kind)
        zp, zu = (positive @ v).astype(float) + w[n], (unlabelled @ v).astype(float) + w[n]
        loss_negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = sigmoid(zp) / len(zp)
        uu = sigmoid(zu) / len(zu)
        if loss_negative >= 0:
            gp = -prior * sigmoid(-zp) / len(zp) - prior * up
            gu = uu
        else:
            gp, gu = prior * up, -uu
        grad = np.append(gp.astype(kind) @ positive + gu.astype(kind) @ unlabelled, gp.sum() + gu.sum())
        grad[:n] += ridge * w[:n]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        pace = rate / (1 + step / steps * 4)
        w = w - pace * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:n], float(w[n])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: int = 1,
    prior: float | None = None,
    most_positive: int = 6_000,
    most_unlabelled: int = 18_000,
    most_features: int = 512,
    least_documents: int = 4,
) -> ToxicityModel:
    """`prior` defaults to the share of positives among the labelled rows to learn from.

    A doc_id that several rows share counts once, with the text of the least hash.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(crc_mod("doc_id", 3) != held_out)
    )
    n_known, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return ToxicityModel({}, -2.0)
    prior = prior or min(max(n_toxic / n_known, 1e-3), 0.9)
    by_hash = F.xxhash64(F.lit(3), "doc_id")
    positive = known.where("toxic = 1").orderBy(by_hash, "doc_id").limit(most_positive).select("doc_id", F.lit(1).alias("p"))
    ids = docs.where(F.col("doc_id").isNotNull() & (crc_mod("doc_id", 3) != held_out)).select("doc_id").distinct()
    unlabelled = ids.orderBy(by_hash, "doc_id").limit(most_unlabelled).select("doc_id", F.lit(1).alias("u"))
    chosen = positive.join(unlabelled, "doc_id", "full").select("doc_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("p", "u")])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(chosen), "doc_id")  # most_positive + most_unlabelled ids at most
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    rows = cut_lineage(rows.groupBy("doc_id", "p", "u").agg(one.alias("row")).select(F.col("row.text").alias("text"), "p", "u"))
    n_p, n_u = rows.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("u"), F.lit(0))).first()
    if not n_p or not n_u:
        return ToxicityModel({}, -2.0)

    def count(batches):
        for part in slices(batches):
            total: dict[str, Counter[str]] = {"p": Counter(), "u": Counter()}
            for text, *kinds in zip(*(part.column(c).to_pylist() for c in ("text", "p", "u")), strict=True):
                found = features(text)
                for counter, counts in zip(total.values(), kinds, strict=True):
                    if counts:
                        counter.update(found)
            names = sorted(total["p"].keys() | total["u"].keys())
            counts = {k: pa.array([c[f] for f in names], pa.int64()) for k, c in total.items()}
            yield pa.RecordBatch.from_pydict({"f": pa.array(names, pa.string()), **counts})

    counted = short_batches(rows).mapInArrow(count, "f string, p long, u long").groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    rate_p, rate_u = F.col("p") / n_p, F.col("u") / n_u
    difference = F.abs(rate_p - rate_u) / F.sqrt((rate_p + 1e-6) / n_p + (rate_u + 1e-6) / n_u)
    best = counted.where(F.col("p") >= least_documents).orderBy(F.desc(F.round(difference, 9)), "f").limit(most_features)
    names = sorted(r.f for r in best.collect())
    if not names:
        return ToxicityModel({}, -2.0)
    place = {f: k for k, f in enumerate(names)}

    def index(batches):
        for part in slices(batches):
            found = [sorted(place[f] for f in features(t) & place.keys()) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "p": part.column("p").combine_chunks(),
                    "u": part.column("u").combine_chunks(),
                    "at": pa.array(found, pa.list_(pa.int32())),
                }
            )

    # Bounded rows and features; packed, since the driver holds it.
    parts = rows.mapInArrow(index, "p int, u int, at array<int>").toArrow().combine_chunks()
    p, u = (parts.column(c).to_numpy().astype(bool) for c in ("p", "u"))
    lists = parts.column("at").combine_chunks()
    length, at = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()

    def presence(chosen: np.ndarray) -> np.ndarray:
        x = np.zeros((int(chosen.sum()), len(names)), np.float32)
        row = np.repeat(np.where(chosen, np.cumsum(chosen, dtype=np.int32) - 1, -1), length)
        x[row[row >= 0], at[row >= 0]] = 1
        return x

    w, b = train(presence(p), presence(u), prior)
    return ToxicityModel(dict(zip(names, w.astype(float).tolist(), strict=True)), b)


def score(docs: DataFrame, model: ToxicityModel, *, held_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, whole texts, no shuffle.

    NULL text counts as empty, NULL doc_id stays with the remainder of an empty text, equal
    texts score alike, other columns are ignored.
    """
    doc_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for part in slices(batches):
            value = model.score([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").combine_chunks(),
                    "held_out": part.column("held_out").combine_chunks(),
                    "score": pa.array(value, pa.float64()),
                    "predicted": pa.array((value >= threshold).astype(np.int32), pa.int32()),
                }
            )

    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), (crc_mod("doc_id", 3) == held_out).alias("held_out")
    )
    return short_batches(rows).mapInArrow(run, f"doc_id {doc_type}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on `labels` and score every row of `docs`.  Without toxic labels all scores are low."""
    return score(docs, fit(docs, labels, **options))


def clean_documents(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs` that score below `threshold`, all columns, order within tasks kept."""
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                value = model.score([t or "" for t in part.column(at).to_pylist()])
                yield part.filter(pa.array(value < threshold))

    return short_batches(docs).mapInArrow(run, docs.schema)
