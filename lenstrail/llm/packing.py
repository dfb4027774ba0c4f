"""Packs tokenised documents into fixed windows without reordering them.

Documents stay in the order in which a task reads them.  Cuts may fall after a document,
after a sentence, or, where a sentence is very long, inside it.  For a block of documents
the cheapest set of cuts is found by dynamic programming over these boundaries: a window
from boundary i to j costs its padding plus a penalty for what the cut at j breaks, so

    best[j] = window - P[j] + penalty[j] + min(best[i] + P[i]),  P[j] - P[i] <= window,

and the minimum over the sliding range of i is kept in a monotone queue.  Sequences whose
length is a power of two need no padding; these windows are extra transitions.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import short_batches, slices

WINDOW = 2048
DOC_END = 1
BLOCK_TOKENS = 1 << 19

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def best_cuts(ends: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> list[int]:
    """Indices into `ends` (rising token positions, the last one is the total) to cut at.

    Neighbouring ends must be at most `window` apart.  Total cost is minimal: padding, which
    is none for the larger powers of two, plus `penalty` of each cut but the last.
    """
    n = len(ends)
    at = np.concatenate(([0], ends)).astype(np.int64)
    exact: dict[int, list[int]] = {}
    size = window >> 1
    while size >= max(1, window >> 3):  # shorter sequences would be many and nearly empty
        want = at[1:] - size
        i = np.searchsorted(at, want)
        for j in np.flatnonzero((want >= 0) & (at[np.minimum(i, n)] == want)):
            exact.setdefault(int(j) + 1, []).append(int(i[j]))
        size >>= 1
    p = at.tolist()
    cost_of = penalty.tolist()
    cost_of[-1] = 0
    best = [0.0] * (n + 1)
    back = [0] * (n + 1)
    queue = deque([(0.0, 0)])
    for j in range(1, n + 1):
        low = p[j] - window
        while p[queue[0][1]] < low:
            queue.popleft()
        value, i = queue[0]
        value += window - p[j]
        for k in exact.get(j, ()):
            if best[k] < value:
                value, i = best[k], k
        value += cost_of[j - 1]
        best[j], back[j] = value, i
        key = value + p[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts = []
    j = n
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, stops: np.ndarray, costs, longest: int):
    """Places where a window may end, with the penalty of each.

    `stops[id]` tells the tokens that end a sentence; `costs` are the penalties (sentence,
    inside).  Gaps above `longest` get extra places inside.
    """
    total = len(ids)
    cost = np.full(total + 1, np.inf)
    cost[np.flatnonzero(stops[ids]) + 1] = costs[0]
    cost[doc_ends] = 0
    ends = np.flatnonzero(cost < np.inf)
    gaps = np.diff(np.concatenate(([0], ends)))
    wide = np.flatnonzero(gaps > longest)
    for k in wide:
        cost[ends[k] - gaps[k] + longest : ends[k] : longest] = costs[1]
    ends = np.flatnonzero(cost < np.inf)
    ends = ends[ends > 0]
    return ends, cost[ends]


def pack_block(docs: list[tuple[int, np.ndarray]], stops, window, costs, longest, first_sequence):
    """Piece rows of one block, and the next free sequence number."""
    lengths = np.array([len(ids) for _, ids in docs], dtype=np.int64)
    doc_ends = np.cumsum(lengths)
    ids = np.concatenate([ids for _, ids in docs])
    ends, penalty = boundaries(ids, doc_ends, stops, costs, longest)
    cut_at = ends[best_cuts(ends, penalty, window)]
    edges = np.union1d(cut_at, doc_ends)  # every piece ends at a cut or at a document's end
    starts = np.concatenate(([0], edges[:-1]))
    sequence = np.searchsorted(cut_at, starts, side="right")
    doc = np.searchsorted(doc_ends, starts, side="right")
    sequence_start = np.concatenate(([0], cut_at))[sequence]
    doc_start = (doc_ends - lengths)[doc]
    raw = ids.astype("<u4")
    crc = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), edges.tolist(), strict=True)]
    rows = {
        "doc_id": pa.array([docs[k][0] for k in doc.tolist()], pa.int64()),
        "start": pa.array(starts - doc_start, pa.int64()),
        "length": pa.array(edges - starts, pa.int64()),
        "ids_crc32": pa.array(crc, pa.int64()),
        "doc_tokens": pa.array(lengths[doc], pa.int64()),
        "sequence_id": pa.array(first_sequence + sequence, pa.int64()),
        "offset": pa.array(starts - sequence_start, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(rows), first_sequence + len(cut_at)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    window: int = WINDOW,
    doc_end: int = DOC_END,
    sentence_cost: float = 1.0,
    inside_cost: float = 24.0,
    longest_gap: int = 128,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece of `docs` (doc_id, text), see PIECES.

    No shuffle: each task packs the rows it reads, in that order, in blocks of about
    `block_tokens`; a document is never split over blocks, so memory holds one block or
    one document.  Sequence numbers start at the task's partition number times 2^33; a
    repeated task gives the same rows.

    NULL text is empty: one piece with the end token.  NULL doc_id stays NULL, equal rows
    are packed as often as they occur, other columns are ignored; no rows give no rows.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches):
        from pyspark import TaskContext

        from lenstrail.llm.tokens import word_tokenizer

        tokenizer = word_tokenizer(tokenizer_path)
        stops = tokenizer.sentence_ends()
        sequence = TaskContext.get().partitionId() << 33
        held, n = [], 0
        for part in slices(batches, 1 << 20):
            texts = ["" if t is None else t for t in part.column("text").to_pylist()]
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                held.append((doc_id, np.append(ids, np.uint32(doc_end))))
                n += len(held[-1][1])
                if n >= block_tokens:
                    rows, sequence = pack_block(
                        held, stops, window, (sentence_cost, inside_cost), longest_gap, sequence
                    )
                    yield rows
                    held, n = [], 0
        if held:
            yield pack_block(held, stops, window, (sentence_cost, inside_cost), longest_gap, sequence)[0]

    return short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)
