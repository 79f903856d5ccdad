"""Text quality by a factorisation machine.

Inputs are a text's hashed words and binned statistics of its structure,
its length among them. Of a document's metadata only the recorded length
could be an input, and it is the text's. Beside a weight every input has
a short vector, and every two inputs interact by the product of their
vectors; the sum over all pairs is half the square of the summed vectors
less the summed squares, so scoring takes linear time.

Fitting reads a bounded sample: at most ``SAMPLE`` rows of each label.
Scoring covers all rows and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexispan.llm.common import labelled_sample, scored, scored_from
from lexispan.llm.features import STATISTICS, structure, word_counts
from lexispan.llm.words import row_slices, word_hashes

#: Labelled rows of each label that the model is fitted on.
SAMPLE = 3000
#: Buckets of hashed words, length of the vectors, bins of a statistic.
BUCKETS, RANK, BINS = 1 << 14, 8, 20
#: Score from which a text is predicted good.
CUT = 0.7

#: Passes over the sample, steps at least, step size, rows of a step.
EPOCHS, LEAST_STEPS, STEP, ROWS = 12, 600, 0.02, 128


@dataclass
class Model:
    """Fixed size: (BUCKETS + statistics * BINS) * (RANK + 1) numbers."""

    edges: np.ndarray  # statistics x BINS - 1
    bias: float
    weights: np.ndarray
    vectors: np.ndarray


def _inputs(texts: pa.Array, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (input, value, begins): statistics, then words of
    values whose squares sum to one."""
    words, rows = word_hashes(texts)
    return _encode(structure(texts, words, rows), words, rows, edges)


def _encode(stats: np.ndarray, words: np.ndarray, rows: np.ndarray,
            edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    bucket, times, begins = word_counts(words, rows, BUCKETS)
    n, m = stats.shape
    binned = np.column_stack([BUCKETS + j * BINS + np.searchsorted(edges[j], stats[:, j], "right")
                              for j in range(m)])
    value = np.log1p(times)
    owner = np.repeat(np.arange(n), np.diff(begins))
    value = value / np.sqrt(np.maximum(np.bincount(owner, value**2, minlength=n), 1e-9))[owner]
    index = np.r_[binned.reshape(-1), bucket]
    row = np.r_[np.repeat(np.arange(n), m), owner]
    order = np.argsort(row, kind="stable")
    return (index[order], np.r_[np.full(n * m, 1 / np.sqrt(m)), value][order],
            np.r_[0, np.cumsum(np.bincount(row, minlength=n))])


def _margins(index: np.ndarray, value: np.ndarray, begins: np.ndarray, model: Model) -> np.ndarray:
    """Linear part plus half the square of sums less the sum of squares.
    Every row has inputs: its statistics."""
    if len(begins) == 1:
        return np.zeros(0)
    linear = np.add.reduceat(model.weights[index] * value, begins[:-1])
    parts = model.vectors[index] * value[:, None]
    sums = np.add.reduceat(parts, begins[:-1], axis=0)
    squares = np.add.reduceat((parts**2).sum(axis=1), begins[:-1])
    return model.bias + linear + ((sums**2).sum(axis=1) - squares) / 2


def fit(texts: pa.Array, good: np.ndarray, weight: np.ndarray) -> Model:
    """Fit on a bounded sample of labelled texts; one class alone gives
    a constant score."""
    inputs = BUCKETS + len(STATISTICS) * BINS
    share = float(np.clip((weight * good).sum() / weight.sum(), 0.001, 0.999)) if len(good) else 0.5
    model = Model(np.zeros((len(STATISTICS), BINS - 1)), float(np.log(share / (1 - share))),
                  np.zeros(inputs, np.float32), np.zeros((inputs, RANK), np.float32))
    if not 0 < good.sum() < len(good):
        return model
    slices = [texts.slice(at, end - at) for at, end in row_slices(texts)]
    stats = np.concatenate([structure(part, *word_hashes(part)) for part in slices])
    model.edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    encoded = [_inputs(part, model.edges) for part in slices]
    index = np.concatenate([i.astype(np.int32) for i, _, _ in encoded])
    value = np.concatenate([x.astype(np.float32) for _, x, _ in encoded])
    begins = np.r_[0, np.cumsum(np.concatenate([np.diff(b) for _, _, b in encoded]))]
    rng = np.random.default_rng(7)
    model.vectors = (rng.standard_normal((inputs, RANK)) * 0.05).astype(np.float32)
    moments = [[np.zeros_like(model.weights), np.zeros_like(model.weights)],
               [np.zeros_like(model.vectors), np.zeros_like(model.vectors)]]
    step = 0
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * ROWS // len(good)))):
        order = rng.permutation(len(good))
        for at in range(0, len(order), ROWS):
            step += 1
            own = order[at:at + ROWS]
            sizes = begins[own + 1] - begins[own]
            starts = np.r_[0, np.cumsum(sizes)]
            place = np.arange(starts[-1]) + np.repeat(begins[own] - starts[:-1], sizes)
            i, x = index[place], value[place]
            margin = _margins(i, x, starts, model)
            error = weight[own] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - good[own]) / len(own)
            pull = np.repeat(error, sizes) * x
            parts = model.vectors[i] * x[:, None]
            sums = np.repeat(np.add.reduceat(parts, starts[:-1], axis=0), sizes, axis=0)
            slope = pull[:, None] * (sums - parts)
            grads = [np.bincount(i, pull, minlength=inputs) + 1e-6 * model.weights,
                     np.column_stack([np.bincount(i, slope[:, f], minlength=inputs) for f in range(RANK)])
                     + 1e-5 * model.vectors]
            model.bias -= STEP * float(error.sum())
            for theta, grad, (first, second) in zip((model.weights, model.vectors), grads, moments, strict=True):
                first += 0.1 * (grad - first)
                second += 0.01 * (grad**2 - second)
                theta -= STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return model


def score(texts: pa.Array, model: Model) -> np.ndarray:
    """Scores of texts, 0 to 1."""
    return 1 / (1 + np.exp(-np.clip(_margins(*_inputs(texts, model.edges), model), -30, 30)))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  sample: int = SAMPLE) -> DataFrame:
    """Quality of every text: doc_id, held_out, score and predicted.

    Learns from rows of ``labels`` (doc_id, quality) that are not held
    out. A null or empty text is scored by its statistics, all zero.
    Without rows of both labels every score is the known share of good
    rows. Repeated rows are scored alike; an empty table gives an empty
    result; other columns are not read.
    """
    model = fit(*labelled_sample(docs, labels, "quality", sample, id_col, text_col))
    return scored(docs, lambda texts: score(texts, model), CUT, id_col, text_col)


def drop_poor(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns as they
    are. Each row goes by its own text alone, whatever its id; null and
    empty texts are scored by their statistics; an empty table stays
    empty."""
    model = fit(*labelled_sample(docs, labels, "quality", SAMPLE, id_col, text_col))
    return scored_from(docs, lambda texts: score(texts, model), CUT, text_col)
