"""Language identification with error-correcting output codes.

Every language has a codeword of signs. For each place of the code one binary classifier over
hashed byte trigrams learns to tell the languages with a plus from those with a minus. A text gets
the language whose codeword loses least against the classifiers' margins, each place weighted by
how often its classifier was right for that language; a text that two codewords fit almost
equally well is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bytetext import raw, slices
from .cuts import unused
from .workers import give_back, map_batches, ship

#: Labelled texts a model is fitted on, over all languages; each language has an equal share.
SAMPLE = 6_000
CELLS = 4096
ROUNDS = 150
#: Below this probability of the best language the decision is flagged.
AMBIGUOUS = 0.6
UNKNOWN = "und"

#: Texts whose features are worked out together.
SLICE_ROWS = 512

# Letters, lower-cased in ASCII, and all bytes of other scripts; the rest counts as a blank.
_FOLD = np.full(256, 32, np.uint32)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x places, +1 or -1
    trust: np.ndarray  # languages x places, rows sum to 1
    weights: np.ndarray  # cells x places
    bias: np.ndarray


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of unit length: square roots of the shares of hashed trigrams; texts may be of any length."""
    rows = len(at) - 1
    one = _FOLD[data]
    two, three = np.zeros_like(one), np.zeros_like(one)
    two[:-1], three[:-2] = one[1:], one[2:]
    ends = at[1:][at[1:] > at[:-1]]
    two[ends - 1] = three[ends - 1] = 0
    inner = ends[ends >= 2] - 2
    three[inner] = 0
    cell = (one | (two << np.uint32(8)) | (three << np.uint32(16))) * np.uint32(2654435761)
    cell >>= np.uint32(20)
    row = np.repeat(np.arange(rows), np.diff(at))
    counts = np.bincount(row * CELLS + cell, minlength=rows * CELLS).reshape(rows, CELLS)
    size = np.maximum(np.diff(at), 1)
    shares = counts / size[:, None]
    del counts
    return np.sqrt(shares, out=shares).astype(np.float32)


def few(at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of bounded bytes and rows: a row takes a whole line of cells, however short its text."""
    for low, high in slices(at):
        for k in range(low, high, SLICE_ROWS):
            yield k, min(k + SLICE_ROWS, high)


def codewords(languages: int) -> np.ndarray:
    """Languages x places. Up to five languages get every split, more get spread random ones."""
    if languages < 2:
        return np.ones((languages, 0), np.int8)
    if languages <= 5:
        splits = np.arange(1, 2 ** (languages - 1))
        bits = [np.ones(len(splits), np.int8)]
        bits += [1 - 2 * ((splits >> k) & 1) for k in range(languages - 1)]
        return np.array(bits, np.int8)
    places, best = int(np.ceil(10 * np.log2(languages))), (-1, None)
    random = np.random.default_rng(7)
    for _ in range(200):
        code = random.choice(np.array([-1, 1], np.int8), (languages, places))
        if (np.abs(code.sum(0)) == languages).any():
            continue
        near = code.astype(int) @ code.T - 2 * places * np.eye(languages, dtype=int)
        if best[1] is None or -near.max() > best[0]:
            best = (-near.max(), code)
    return best[1]


def _fit_place(x: np.ndarray, sign: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient steps; `weight` sums to one."""
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    for k in range(ROUNDS):
        margin = sign * (x @ v[:-1] + v[-1])
        pull = (-sign * weight / (1 + np.exp(np.clip(margin, -30, 30)))).astype(np.float32)
        step = np.append(x.T @ pull, pull.sum())
        new = v - 40 * step - 0.001 * v
        v = new + k / (k + 3) * (new - w)
        w = new
    return w[:-1], float(w[-1])


def fit(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE,
) -> Model:
    """Learn from rows with a text and a language; about `sample` of them, the same share each.

    Rows are chosen by a hash, so that the choice does not hang on their order. One task per place
    of the code fits a classifier; only weights come back. With one language, or none, there is
    nothing to learn and the model has no places.
    """
    known = docs.select(
        F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(counts)
    code = codewords(len(languages))
    places = code.shape[1]
    if not places:
        return Model(languages, code, code.astype(float), np.zeros((CELLS, 0)), np.zeros(0))
    share = max(1, sample // len(languages))
    keep = F.lit(0.0)
    for name, n in counts.items():
        keep = F.when(F.col("lang") == name, min(1.0, share / n)).otherwise(keep)
    draw = F.pmod(F.xxhash64("doc", "text"), F.lit(1 << 24)) / float(1 << 24)
    chosen = known.filter(draw < keep).select("lang", "text")

    def fit_place(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = key[0].as_py()
        # Texts pass by in batches; only their features stay. Pages of the table that no row reaches take no memory.
        x, named = np.empty((2 * sample, CELLS), np.float32), []
        for batch in rows:
            body, at = raw(batch.column("text"))
            begin = len(named)
            named += batch.column("lang").to_pylist()
            if len(named) > len(x):
                x = np.concatenate([x[:begin], np.empty((max(begin, batch.num_rows), CELLS), np.float32)])
            for a, b in few(at):
                x[begin + a : begin + b] = features(body[at[a] : at[b]], at[a : b + 1] - at[a])
        x = x[: len(named)]
        number = {k: i for i, k in enumerate(languages)}
        index = np.array([number[k] for k in named])
        sign = code[index, place].astype(np.float32)
        n = np.bincount(index, minlength=len(languages))
        weight = 1.0 / n[index]
        for side in (-1, 1):
            if (sign == side).any():
                weight[sign == side] /= 2 * weight[sign == side].sum()
        w, b = _fit_place(x, sign, weight)
        right = (sign * (x @ w + b)) > 0
        hits = np.bincount(index, right, minlength=len(languages)) / np.maximum(n, 1)
        del x
        give_back()
        yield pa.RecordBatch.from_pydict(
            {"place": pa.array([place], pa.int32()), "w": [w.astype(float)], "b": [b], "hits": [hits]}
        )

    ship(docs.sparkSession)
    fitted = (
        chosen.withColumn("place", F.explode(F.array(*map(F.lit, range(places)))))
        .groupBy("place")
        .applyInArrow(fit_place, "place int, w array<double>, b double, hits array<double>")
        .toArrow()
        .sort_by("place")
    )
    trust = np.array(fitted["hits"].to_pylist()).T + 1e-6
    return Model(
        languages,
        code,
        trust / trust.sum(1, keepdims=True),
        np.array(fitted["w"].to_pylist(), np.float32).T,
        fitted["b"].to_numpy(),
    )


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the best language and its probability, per row of margins."""
    loss = np.zeros((len(margins), len(model.languages)))
    for k in range(len(model.languages)):
        loss[:, k] = np.logaddexp(0, -margins * model.code[k]) @ model.trust[k]
    odds = np.exp(-(loss - loss.min(1, keepdims=True)) * max(1, model.code.shape[1]))
    best = loss.argmin(1)
    return best, odds[np.arange(len(best)), best] / odds.sum(1)


def with_language(
    docs: DataFrame, model: Model, *, text_col: str = "text", keep_unknown: bool = False
) -> DataFrame:
    """The rows of `docs` as they are, with lang_pred, score and ambiguous beside.

    Rows without a language are left out unless `keep_unknown`. Nothing is shuffled. Columns of
    these three names in `docs` are replaced.
    """
    own = ("lang_pred", "score", "ambiguous")
    docs = docs.drop(*own)
    place = docs.columns.index(text_col)

    def score(batches):
        for batch in batches:
            names, sureness, unsure = _answers(model, batch.column(place), batch.column(batch.num_columns - 1).to_pylist())
            arrays = batch.columns[:-1] + [pa.array(names, pa.string()), pa.array(sureness, pa.float64()), pa.array(unsure, pa.bool_())]
            out = pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1] + list(own))
            yield out if keep_unknown else out.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    schema = StructType(docs.schema.fields)
    schema = schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return map_batches(docs.select("*", lettered.alias(unused(docs, "_lettered"))), score, schema)


def _answers(model: Model, texts: pa.Array, lettered: list[bool]):
    """Language, probability and doubt of each text."""
    body, at = raw(texts)
    names, sureness = [], []
    for low, high in few(at):
        if not model.languages:
            names += [UNKNOWN] * (high - low)
            sureness += [0.0] * (high - low)
            continue
        x = features(body[at[low] : at[high]], at[low : high + 1] - at[low])
        best, sure = decode(model, x @ model.weights + model.bias)
        names += [model.languages[k] for k in best]
        sureness += sure.tolist()
    names = [n if ok else UNKNOWN for n, ok in zip(names, lettered, strict=True)]
    sureness = [s if n != UNKNOWN else 0.0 for s, n in zip(sureness, names, strict=True)]
    unsure = [n != UNKNOWN and s < AMBIGUOUS for n, s in zip(names, sureness, strict=True)]
    return names, sureness, unsure


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score, ambiguous, from the whole text alone.

    Cases: a null text, one without any letter, or a model without languages gives `und` with
    score 0, not ambiguous; texts of one or two bytes are padded; equal losses go to the language
    first in order; repeated rows are each answered. Other columns are not looked at.
    """
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    found = with_language(given, model, keep_unknown=True)
    return found.select("doc_id", "lang_pred", "score", "ambiguous")
