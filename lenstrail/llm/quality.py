"""Quality scores from compressed sizes under two dictionaries.

A zstandard dictionary is built from good and one from bad labelled text.  A text is cut
into pieces of equal size, each is compressed with either dictionary, and the difference of
the compressed sizes, divided by the text's bytes, is mapped to a score by a logistic curve
fitted on other labelled rows.

Fitting reads a bounded sample: at most `most_rows` labelled rows, and of them at most
`most_pieces` pieces per class and use, all chosen by hash.  Scoring reads every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import crc_mod, short_batches, slices

PIECE = 1024


def pieces_of(data: bytes, size: int = PIECE) -> list[bytes]:
    return [data[k : k + size] for k in range(0, len(data), size)]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, most_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most `most_rows` labelled rows that may be learned from.

    Rows are chosen by a hash of doc_id, half of each class where there are enough.  A
    doc_id with several labels has the largest; NULL ids and labels are left out.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
        .where(may_learn)
    )
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64(F.lit(7), "doc_id"), "doc_id").limit(most_rows // 2)
        chosen = part if chosen is None else chosen.union(part)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    shift: float
    level: int = 3
    piece: int = PIECE

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """(bytes under the bad dictionary - bytes under the good one) per byte of text."""
        import zstandard as zstd

        sizes = []
        for raw in (self.good, self.bad):
            use = zstd.ZstdCompressionDict(raw)
            use.precompute_compress(level=self.level)
            packer = zstd.ZstdCompressor(
                level=self.level, dict_data=use, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            sizes.append([sum(len(packer.compress(p)) for p in pieces_of(t, self.piece)) for t in texts])
        good, bad = np.array(sizes, float).reshape(2, -1)
        return (bad - good) / np.maximum([len(t) for t in texts], 1)

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift for the original x by damped Newton steps; one class gives slope 0."""
    if not len(x):
        return 0.0, 0.0
    scale = x.std() or 1.0
    z = np.column_stack(((x - x.mean()) / scale, np.ones(len(x))))
    w = np.zeros(2)
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(hessian, z.T @ (target - p) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    held_out: int = 2,
    label: str = "quality",
    most_rows: int = 16_000,
    most_pieces: int = 6_000,
    dictionary_bytes: int = 112_640,
) -> CompressionModel:
    """Dictionaries from rows with crc32 remainder (mod 4) other than `held_out` and the one
    after it; the curve from rows with that next remainder."""
    import zstandard as zstd

    curve = (held_out + 1) % 4
    rows = labelled_sample(docs, labels, label, crc_mod("doc_id", 4) != held_out, most_rows)

    def cut(batches):
        for part in slices(batches):
            ids, of, out = [], [], []
            for doc_id, value, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "label", "text")), strict=True):
                for p in pieces_of((text or "").encode()):
                    ids.append(doc_id)
                    of.append(value)
                    out.append(p)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": pa.array(ids, pa.int64()), "label": pa.array(of, pa.int32()), "piece": pa.array(out, pa.binary())}
            )

    rows = rows.select(F.col("doc_id").cast("long"), F.col("label").cast("int"), "text")
    pieces = short_batches(rows).where(crc_mod("doc_id", 4) != curve).mapInArrow(cut, "doc_id long, label int, piece binary")
    sample = None
    for value in (0, 1):
        part = pieces.where(F.col("label") == value).orderBy(F.xxhash64("piece"), "piece").limit(most_pieces)
        sample = part if sample is None else sample.union(part)
    found: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sample.collect():  # at most 2 * most_pieces pieces of PIECE bytes
        found[row.label].append(bytes(row.piece))
    raw = {k: _dictionary(zstd, v, dictionary_bytes) for k, v in found.items()}
    model = CompressionModel(raw[1], raw[0], 0.0, 0.0)

    def measure(batches):
        for part in slices(batches):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"margin": pa.array(model.margins(texts), pa.float64()), "label": part.column("label").combine_chunks()}
            )

    got = rows.where(crc_mod("doc_id", 4) == curve).mapInArrow(measure, "margin double, label int").toPandas()
    slope, shift = logistic_fit(got.margin.to_numpy(float), got.label.to_numpy(float))
    return CompressionModel(raw[1], raw[0], slope, shift)


def _dictionary(zstd, samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the last samples themselves where there is little text."""
    if sum(map(len, samples)) > 8 * size:
        try:
            return zstd.train_dictionary(size, samples, level=3).as_bytes()
        except zstd.ZstdError:
            pass
    return b"".join(samples)[-size:]


def score(docs: DataFrame, model: CompressionModel, *, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_bytes, margin for every row, whole texts, no shuffle.

    NULL text counts as empty; its margin is 0.  NULL doc_id stays, with the remainder of
    an empty text.  Equal rows score alike; other columns are ignored.
    """
    doc_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for part in slices(batches):
            texts = [(t or "").encode() for t in part.column("text").to_pylist()]
            margin = model.margins(texts)
            value = model.score(margin)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").combine_chunks(),
                    "held_out": part.column("held_out").combine_chunks(),
                    "score": pa.array(value, pa.float64()),
                    "predicted": pa.array((value >= threshold).astype(np.int32), pa.int32()),
                    "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                    "margin": pa.array(margin, pa.float64()),
                }
            )

    rows = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), (crc_mod("doc_id", 4) == held_out).alias("held_out")
    )
    return short_batches(rows).mapInArrow(
        run, f"doc_id {doc_type}, held_out boolean, score double, predicted int, n_bytes long, margin double"
    )


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on `labels` and score every row of `docs`.  Without labels every score is 0.5."""
    return score(docs, fit(docs, labels, **options))
