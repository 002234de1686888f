"""Ranked lexical search for a set of items, with identical bags of words scored once.

Documents are reduced to the counts of the items' terms. Those counts and the document's length
factor m are all that its scores depend on, so documents that agree in both form a class: they are
brought together by a hash of the counts and grouped on the counts themselves. Every class is scored
once against all items, and the best classes of an item are expanded by ascending document id.

Ten classes are enough for ten documents: of any further class each of the ten has a member that
comes first. Items are taken in passes bounded by bytes and number, so that what goes to every
executor is bounded too; within a pass they are scored in blocks against all classes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import _LOWER, Hasher, raw, repeat_index, slices, words
from .cuts import Cuts, release
from .workers import map_batches

#: Bytes and number of the items of a pass, on average.
PASS_BYTES, PASS_ITEMS = 1 << 20, 4096
#: Items scored together, and entries of classes together.
BLOCK, ENTRIES = 256, 1 << 14
#: Bytes of the best classes up to which they are sent to every executor.
SENT_BYTES = 8 << 20

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LAST = np.iinfo(np.int64).max


def terms(text: str | None) -> list[str]:
    """The terms of a text in order."""
    return [t.translate(_FOLD) for t in TERM.findall(text or "")]


class Vocabulary:
    """Terms by number; finds the numbers of all words of a slice of texts."""

    def __init__(self, known: list[str]):
        coded = [t.encode() for t in known]
        data = np.frombuffer(b"".join(coded), np.uint8)
        size = np.array([len(t) for t in coded], np.int64)
        ends = np.cumsum(size)
        hashed = Hasher(data).of(ends - size, ends)
        order = np.argsort(hashed)
        self.hashed, self.size = hashed[order], size[order]
        self.at, self.data = (ends - size)[order], _LOWER[data]
        self.terms = [known[k] for k in order]

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each word [start, end), -1 where it is no term; bytes are compared."""
        hashed = Hasher(data).of(starts, ends)
        at = np.minimum(np.searchsorted(self.hashed, hashed), len(self.hashed) - 1)
        size = ends - starts
        maybe = np.flatnonzero((self.hashed[at] == hashed) & (self.size[at] == size))
        out = np.full(len(starts), -1, np.int64)
        if len(maybe):
            inside, count = repeat_index(size[maybe]), size[maybe]
            same = _LOWER[data[np.repeat(starts[maybe], count) + inside]] == self.data[np.repeat(self.at[at[maybe]], count) + inside]
            whole = np.logical_and.reduceat(same, np.cumsum(count) - count)
            out[maybe[whole]] = at[maybe[whole]]
        return out


def _bags(docs: DataFrame, known: list[str]) -> DataFrame:
    """(doc_id, n, bag): the number of a document's terms, and number and count of the known ones."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(known)
        v = len(vocabulary.terms)
        for batch in batches:
            n, bags = np.zeros(len(batch), np.int64), [b""] * len(batch)
            body, at = raw(batch.column("text"))
            for low, high in slices(at):
                data, inside = body[at[low] : at[high]], at[low : high + 1] - at[low]
                starts, ends, first = words(data, inside, letters=True)
                number = np.diff(first)
                n[low:high] = number
                if not len(starts):
                    continue
                term = vocabulary.numbers(data, starts, ends)
                row = np.repeat(np.arange(high - low), number)[term >= 0]
                code, tf = np.unique(row * v + term[term >= 0], return_counts=True)
                pairs = np.stack([code % v, tf], 1).astype("<u4")
                edge = np.searchsorted(code, np.arange(high - low + 1) * v)
                for k in np.flatnonzero(np.diff(edge)):
                    bags[low + k] = pairs[edge[k] : edge[k + 1]].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"]
            )

    return map_batches(docs, count, "doc_id bigint, n bigint, bag binary")


def _entries(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers and counts of many bags, and how many each bag has."""
    body, at = raw(bags)
    pairs = np.frombuffer(body[at[0] : at[-1]].tobytes(), "<u4").reshape(-1, 2).astype(np.int64)
    return pairs[:, 0], pairs[:, 1], np.diff(at) // 8


def _holders(classes: DataFrame, v: int) -> dict[int, int]:
    """How many documents hold each term; as many rows come to the driver as there are terms."""

    def add(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(v, np.int64)
        for batch in batches:
            term, _, size = _entries(batch.column("bag"))
            np.add.at(total, term, np.repeat(batch.column("members").to_numpy(), size))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "df"])

    found = map_batches(classes.select("bag", "members"), add, "term bigint, df bigint")
    return {r["term"]: r["df"] for r in found.groupBy("term").agg(F.sum("df").alias("df")).collect()}


class Best:
    """The best classes of each item so far, by descending score and ascending first document."""

    def __init__(self, items: int, k: int):
        self.k, self.rows = k, [np.zeros(0, np.int64)] * 5
        self.least = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, low: int, classes: tuple[np.ndarray, ...]) -> None:
        """`scores` by class and item, items counted from `low`; classes are (first, hash, m)."""
        row, item = np.nonzero(scores >= self.least[low : low + scores.shape[1]])
        if not len(row):
            return
        new = [item + low, scores[row, item], *[c[row] for c in classes]]
        rows = [np.concatenate(x) for x in zip(self.rows, new, strict=True)]
        order = np.lexsort((rows[2], -rows[1], rows[0]))
        item = rows[0][order]
        at = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[at < self.k]
        self.rows = [x[kept] for x in rows]
        full = order[at == self.k - 1]
        self.least[rows[0][full]] = rows[1][full]


def _scored(classes: DataFrame, items: list[Counter], weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, first, hash, m) of the k best classes of each item in each task."""

    def score(batches) -> Iterator[pa.RecordBatch]:
        blocks = []
        for low in range(0, len(items), BLOCK):
            block = np.zeros((len(weights), len(items[low : low + BLOCK])), np.int64)
            for j, counted in enumerate(items[low : low + BLOCK]):
                for term, times in counted.items():
                    block[term, j] = times * weights[term]
            blocks.append((low, block))
        best = Best(len(items), k)
        for batch in batches:
            term, tf, size = _entries(batch.column("bag"))
            first, hashed, m = (batch.column(c).to_numpy() for c in ("first", "hash", "m"))
            part = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, size))
            ends = np.cumsum(size)
            begin = 0
            while begin < len(size):
                before = ends[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
                here = slice(before, ends[stop - 1])
                mine = slice(begin, stop)
                for low, block in blocks:
                    scores = np.add.reduceat(block[term[here]] * part[here, None], (ends - size)[mine] - before, axis=0)
                    best.add(scores, low, (first[mine], hashed[mine], m[mine]))
                begin = stop
        names = ["item", "score", "first", "hash", "m"]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best.rows], names=names)

    return map_batches(
        classes.select("first", "hash", "m", "bag"), score, "item bigint, score bigint, first bigint, hash bigint, m bigint"
    )


def _pass(cuts: Cuts, docs: DataFrame, asked: list, k: int) -> DataFrame:
    """The k best documents of the items of one pass."""
    spark = docs.sparkSession
    counted = [Counter(terms(r["text"])) for r in asked]
    vocabulary = Vocabulary(sorted(set().union(*counted)))
    bags = cuts.cut(_bags(docs, vocabulary.terms).filter("n > 0"))
    total = bags.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).head()
    factor = F.expr(f"25 + (75 * n * {total['N']}) div {total['L'] or 1}")
    keyed = bags.filter(F.octet_length("bag") > 0).select("doc_id", factor.alias("m"), "bag", F.xxhash64("bag").alias("hash"))
    classes = keyed.groupBy("hash", "m", "bag").agg(
        F.coalesce(F.min("doc_id"), F.lit(_LAST)).alias("first"), F.count(F.lit(1)).alias("members")
    )
    classes = cuts.cut(classes)
    release(spark)
    # The vocabulary's order is by hash and so the same on every executor.
    held = _holders(classes, len(vocabulary.terms))
    weights = np.array(
        [math.floor(1000 * math.log((2 * total["N"] + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(vocabulary.terms))],
        np.int64,
    )
    number = {t: j for j, t in enumerate(vocabulary.terms)}
    items = [Counter({number[t]: times for t, times in c.items()}) for c in counted]
    best = _top(_scored(classes, items, weights, k), ["item"], [F.desc("score"), "first", "hash"], k)
    best = cuts.cut(best.drop("at"))
    chosen = cuts.cut(best.select("hash", "m", "first").distinct().join(classes, ["hash", "m", "first"]).drop("members"))
    size = chosen.agg(F.sum(F.octet_length("bag") + 24)).head()[0] or 0
    members = keyed.join(F.broadcast(chosen) if size <= SENT_BYTES else chosen, ["hash", "m", "bag"])
    # A class may hold a third of all documents: its parts are cut to k documents before they meet.
    parted = members.select("hash", "m", "first", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("part"))
    parted = parted.repartition("hash", "m", "first", "part")
    parted = _top(parted, ["hash", "m", "first", "part"], [F.asc_nulls_last("doc_id")], k)
    parted = _top(parted.drop("at", "part"), ["hash", "m", "first"], [F.asc_nulls_last("doc_id")], k)
    ranked = best.join(parted.drop("at"), ["hash", "m", "first"])
    ranked = _top(ranked, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    names = spark.createDataFrame([(j, r["item_id"]) for j, r in enumerate(asked)], "item bigint, item_id bigint")
    return names.join(ranked, "item").select("item_id", F.col("at").alias("rank"), "doc_id", "score")


def _top(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("at", at).filter(F.col("at") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 for each item.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased.
    N, the total length L and each term's document count are taken over all documents. Equal
    scores go by ascending doc_id, a null id last; repeated rows are documents of their own and take
    ranks of their own. Every row of `items` is an item of its own. A null or empty text, on either
    side, has no terms and so no rows. Other columns are not read. Empty tables give no rows. A long
    text is counted whole, alone in its slice.
    """
    spark = docs.sparkSession
    cuts = Cuts(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    asked = asked.filter(F.octet_length("text") > 0)
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).head()
    passes = max((size["bytes"] or 0) // PASS_BYTES, size["n"] // PASS_ITEMS) + 1
    found = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for k_pass in range(passes):
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k_pass).collect()
        mine = [r for r in mine if TERM.search(r["text"])]
        if mine:
            found = found.unionByName(_pass(cuts, rows, mine, k))
    return found
