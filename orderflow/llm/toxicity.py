"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, all other text is unlabelled. With the share p of toxic
text (the class prior), a classifier g and the logistic loss, the risk is

    p * loss(g, positives as toxic) + max(0, loss(g, unlabelled as clean) - p * loss(g, positives as clean))

The bracket estimates the loss on clean text; where it falls below zero the fit has begun to learn
the unlabelled texts by heart, and the step goes the other way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Hasher, raw, slices, words
from .cuts import Cuts, by_size
from .workers import map_batches

#: Confirmed and unlabelled texts that a model is fitted on.
POSITIVES = 4_000
UNLABELLED = 12_000
CELL_BITS = 18
ROUNDS = 250
#: A word or word beginning counts if this share of the positives, and five of them, hold it, and
#: if they hold it more often than the unlabelled texts by this many standard deviations.
LEAST_SHARE = 0.01
LEAST_LIFT = 5.0
#: Beginnings of words, in bytes, that count like words, so that endings do not hide a stem.
STEMS = (4, 5, 6, 8)
OFTEN = 3


def cells(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and distinct cells of the words and word beginnings in a slice, a pair per row and cell."""
    starts, ends, first = words(data, at, letters=True)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hasher = Hasher(data)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    rows, hashes = [row], [hasher.of(starts, ends)]
    for size in STEMS:
        longer = np.flatnonzero(ends - starts > size)
        rows.append(row[longer])
        hashes.append(hasher.of(starts[longer], starts[longer] + size) * np.uint64(2 * size + 1))
    cell = np.concatenate(hashes) >> np.uint64(64 - CELL_BITS)
    pair, times = np.unique(
        np.concatenate(rows) << CELL_BITS | cell.astype(np.int64), return_counts=True
    )
    # What occurs often in a text is marked again.
    often = pair[times >= OFTEN] ^ ((1 << CELL_BITS) // 3)
    pair = np.unique(np.concatenate([pair, often]))
    return pair >> CELL_BITS, pair & ((1 << CELL_BITS) - 1)


def fit_weights(
    rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias from the words (rows, cols) of texts, some of which are positives."""
    n_pos, n_all = int(positive.sum()), len(positive)
    found = np.bincount(cols[positive[rows]], minlength=1 << CELL_BITS)
    every = np.bincount(cols, minlength=1 << CELL_BITS)
    share = every / n_all
    spread = np.sqrt(share * (1 - share) * (1 / n_pos + 1 / max(1, n_all - n_pos))) + 1e-12
    lift = (found / n_pos - (every - found) / max(1, n_all - n_pos)) / spread
    use = ((found >= max(5, LEAST_SHARE * n_pos)) & (lift >= LEAST_LIFT))[cols]
    rows, cols = rows[use], cols[use]
    w, bias = np.zeros(1 << CELL_BITS), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    rate_pos, rate_un = prior / n_pos, 1.0 / max(1, n_all - n_pos)
    for k in range(1, ROUNDS + 1):
        z = np.bincount(rows, w[cols], n_all) + bias
        toxic = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean_loss = np.logaddexp(0, z)
        rest = clean_loss[~positive].sum() * rate_un - clean_loss[positive].sum() * rate_pos
        # Slopes of the loss: as toxic it is toxic - 1, as clean it is toxic.
        rest_slope = np.where(positive, -toxic * rate_pos, toxic * rate_un)
        if rest >= 0:
            slope = rest_slope + np.where(positive, (toxic - 1) * rate_pos, 0)
        else:
            slope = -rest_slope
        step = np.bincount(cols, slope[rows], 1 << CELL_BITS) + 1e-5 * w
        step_bias = slope.sum()
        m, v = 0.9 * m + 0.1 * step, 0.99 * v + 0.01 * step**2
        mb, vb = 0.9 * mb + 0.1 * step_bias, 0.99 * vb + 0.01 * step_bias**2
        fix = np.sqrt(1 - 0.99**k) / (1 - 0.9**k)
        w -= 0.1 * fix * m / (np.sqrt(v) + 1e-6)
        bias -= 0.1 * fix * mb / (np.sqrt(vb) + 1e-6)
    return w, bias


def fit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(cells, weights, bias) learned from `labels` (doc_id, toxic) and the texts in `docs`.

    The prior is the share of toxic rows among the labelled ones. About `positives` confirmed and
    `unlabelled` other texts, chosen by a hash, are turned into cells where they lie; the cells, at
    most 2^`CELL_BITS` a text, go to one task that fits the weights. None if no label is toxic. Labels that are null, or for no document, teach nothing; several labels of a
    document count as toxic if one of them does.
    """
    cuts = Cuts(docs.sparkSession)
    marked = cuts.cut(
        labels.filter("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("bigint").alias("doc"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    total, toxic = marked.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return None
    prior = min(0.5, max(0.001, toxic / total))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    texts = texts.filter("text is not null and doc is not null")
    draw = F.pmod(F.xxhash64("doc"), F.lit(1 << 24)) / float(1 << 24)
    some = cuts.cut(marked.filter(F.col("toxic") == 1).filter(draw < min(1.0, positives / toxic)).select("doc"))
    count = texts.select("doc").count()
    confirmed = texts.join(by_size(some), "doc").select(F.lit(True).alias("positive"), "text")
    other = texts.filter(draw < min(1.0, unlabelled / max(1, count))).select(F.lit(False).alias("positive"), "text")

    def marked_cells(batches):
        for batch in batches:
            body, at = raw(batch.column(1))
            for low, high in slices(at):
                row, cell = cells(body[at[low] : at[high]], at[low : high + 1] - at[low])
                first = np.searchsorted(row, np.arange(high - low + 1)).astype(np.int32)
                listed = pa.ListArray.from_arrays(pa.array(first), pa.array(cell.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), listed], names=["positive", "cells"]
                )

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        held = rows["cells"].to_numpy()
        where = np.repeat(np.arange(len(held)), [len(x) for x in held])
        which = np.concatenate([np.zeros(0, np.int64), *held]).astype(np.int64)
        positive = rows["positive"].to_numpy()
        if not positive.any():
            return pd.DataFrame({"cell": [], "w": []})
        w, bias = fit_weights(where, which, positive, prior)
        used = np.flatnonzero(w)
        return pd.DataFrame({"cell": np.append(used, -1), "w": np.append(w[used], bias)})

    marks = map_batches(confirmed.union(other), marked_cells, "positive boolean, cells array<int>")
    fitted = marks.groupBy().applyInPandas(learn, "cell bigint, w double").toPandas()
    if not len(fitted):
        return None
    bias = fitted.loc[fitted["cell"] == -1, "w"].iloc[0]
    fitted = fitted[fitted["cell"] >= 0]
    return fitted["cell"].to_numpy(), fitted["w"].to_numpy(), float(bias)


def score(docs: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score, predicted, from the distinct words and word beginnings of the whole text.

    Cases: a null or empty text gets the score of the bias alone; without a model every score is
    0; ties do not arise; repeated rows are each answered. Other columns are not looked at.
    """

    def run(batches):
        w, bias = np.zeros(1 << CELL_BITS), -np.inf
        if model is not None:
            w[model[0]], bias = model[1], model[2]
        for batch in batches:
            body, at = raw(batch.column(1))
            z = np.full(len(batch), bias)
            for low, high in slices(at):
                row, cell = cells(body[at[low] : at[high]], at[low : high + 1] - at[low])
                z[low:high] += np.bincount(row, w[cell], high - low)
            value = 1 / (1 + np.exp(-np.clip(z, -500, 500))) if model is not None else np.zeros(len(z))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, "doc_id bigint, score double, predicted int")
