"""Near-duplicate documents by word shingles: b-bit signatures and a multi-index Hamming join.

A document's set holds its distinct word shingles. Its signature keeps `bits` bits of each of
`parts * 4` minimum hashes. Two signatures that differ in at most `2 * parts - 1` places have, by
the pigeonhole principle, a part of four places in which at most one differs; so each signature is
filed under every part with every one of its four places left out, and all pairs within that
distance meet under some key. At a similarity of 0.8 a place differs with probability 0.2, so with
nine parts the distance 17 leaves out a true pair with probability below 0.0001. Candidates
are then settled as `setjoin` does it, with an exact check on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Hasher, mix, odd_numbers, raw, repeat_index, slices, words
from .cuts import Cuts, by_size, unused
from .setjoin import SetJoin, numbered
from .workers import map_batches

#: Places of a part; one of them may differ.
PLACES = 4


class Shingler:
    """Hashed word shingles of whole texts; a shorter text is one shingle of all its words."""

    def __init__(self, width: int):
        self.width = width
        self.weights = odd_numbers(width, 1)
        self.short = odd_numbers(width + 1, 2)

    def slice(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All shingle hashes of a slice, repeats included, and each row's offsets among them."""
        starts, ends, first = words(data, at)
        total = np.zeros(len(at), np.int64)
        if not len(starts):
            return np.zeros(0, np.uint64), total
        hashed = Hasher(data).of(starts, ends)
        count = np.diff(first)
        few = (count > 0) & (count < self.width)
        number = np.where(few, 1, np.maximum(count - self.width + 1, 0))
        np.cumsum(number, out=total[1:])
        n = len(hashed)
        wide = np.concatenate([hashed, np.zeros(self.width, np.uint64)])
        sums = wide[:n] * self.weights[0]
        for k in range(1, self.width):
            sums += wide[k : k + n] * self.weights[k]
        out = sums[np.repeat(first[:-1], number) + repeat_index(number)]
        for row in np.flatnonzero(few):
            size = int(count[row])
            here = hashed[first[row] : first[row] + size] * self.weights[:size]
            out[total[row]] = here.sum() ^ self.short[size]
        return mix(out), total

    def rows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
        """(hashes, offsets, first row, end row) per slice of a text column."""
        body, at = raw(column)
        for low, high in slices(at):
            yield *self.slice(body[at[low] : at[high]], at[low : high + 1] - at[low]), low, high


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, width: int, parts: int, id_col: str, text_col: str) -> DataFrame:
    """(doc, n, node, sig): set size, digest of the set and signature; both null for empty sets."""

    def sign(batches):
        shingler, places = Shingler(width), parts * PLACES
        times, salts = odd_numbers(places, 3), odd_numbers(places, 4)
        for batch in batches:
            sizes, nodes, sigs = [], [], []
            for hashes, at, low, high in shingler.rows(batch.column(1)):
                filled = np.flatnonzero(at[1:] > at[:-1])
                sig = np.empty((len(filled), places), np.uint16)
                for k in range(places if len(filled) else 0):
                    least = np.minimum.reduceat((hashes ^ salts[k]) * times[k], at[filled])
                    sig[:, k] = mix(least) >> np.uint64(48)
                row_sig = dict(zip(filled.tolist(), sig, strict=True))
                for row in range(high - low):
                    if row not in row_sig:
                        sizes.append(0), nodes.append(None), sigs.append(None)
                        continue
                    distinct = np.unique(hashes[at[row] : at[row + 1]])
                    sizes.append(len(distinct))
                    nodes.append(_digest(distinct))
                    sigs.append(row_sig[row].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(sigs, pa.binary()),
                ],
                names=["doc", "n", "node", "sig"],
            )

    given = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    return map_batches(given, sign, "doc bigint, n bigint, node binary, sig binary")


def _items(width: int):
    def items_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for hashes, at, _, _ in Shingler(width).rows(texts):
            yield hashes, at

    return items_of


def _bodies(found: DataFrame, width: int) -> DataFrame:
    """(id, body) of the rows (id, node, text) whose set has that digest.

    Only rows that share a doc_id with another text can differ.
    """

    def run(batches):
        items_of = _items(width)
        for batch in batches:
            nodes = iter(batch.column(1).to_pylist())
            same = [
                _digest(np.unique(hashes[low:high])) == next(nodes)
                for hashes, at in items_of(batch.column(2))
                for low, high in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
            ]
            yield batch.select([0, 2]).rename_columns(["id", "body"]).filter(pa.array(same, pa.bool_()))

    return map_batches(found, run, "id bigint, body string")


def _keys(parts: int) -> F.Column:
    """Every part of the signature with each of its places left out."""
    keys = []
    for part in range(parts):
        for left_out in range(PLACES):
            begin = 2 * PLACES * part + 1
            keys.append(
                F.xxhash64(
                    F.lit(part * PLACES + left_out),
                    F.substring("sig", begin, 2 * left_out),
                    F.substring("sig", begin + 2 * left_out + 2, 2 * (PLACES - 1 - left_out)),
                )
            )
    return F.array(*keys)


def near_duplicates(
    docs: DataFrame,
    *,
    width: int = 5,
    percent: int = 80,
    parts: int = 9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets share at least `percent` percent of their union.
    component_id is the smallest doc_id reachable over links, kept says whether it is the
    document's own. Cases: a null or blank text has an empty set, is linked with nothing and is
    its own component; fewer words than `width` are one shingle; equal texts are always linked;
    rows with the same doc_id are each returned, and ties need no order since only the smallest
    doc_id counts; a null doc_id is grouped like any other but never names a component unless all
    of its group are null, and it is kept only then. Other columns are not looked at.
    """
    cuts = Cuts(docs.sparkSession)
    signed = cuts.cut(signatures(docs, width, parts, id_col, text_col))
    distinct = (
        signed.filter("node is not null")
        .groupBy("node")
        .agg(F.min("doc").alias("head"), F.min("n").alias("n"), F.min("sig").alias("sig"))
    )
    reps = numbered(cuts, distinct, "head")
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))

    def fetch(ids: DataFrame) -> DataFrame:
        asked = cuts.cut(reps.join(ids, "id").select("id", F.col("head").alias("of"), "node"))
        found = texts.join(by_size(asked), F.col("doc").eqNullSafe(F.col("of")))
        return _bodies(found.select("id", "node", "text"), width)

    join = SetJoin(
        cuts, reps, _keys(parts), parts * PLACES, 2 * parts - 1, percent, fetch, _items(width)
    )
    roots = join.roots()

    # The smallest document of each component, for the sets that are in one; others stand alone.
    grouped = reps.join(roots, "id", "left").select(
        "node", "head", F.coalesce("root", "id").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("head").alias("component_id"))
    named = grouped.join(least, "root").select("node", "component_id")
    return signed.join(named, "node", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("node").isNull(), True)
        .otherwise(F.col("doc").eqNullSafe(F.col("component_id")))
        .alias("kept"),
    )


def without_copies(docs: DataFrame, decided: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The documents that `near_duplicates` keeps, each row as it was, and each document once.

    Rows with one doc_id are one document; a null doc_id is kept as it is.
    """
    cuts = Cuts(docs.sparkSession)
    off = unused(docs, "gone")
    gone = cuts.cut(decided.filter("not kept").select(F.col("doc_id").alias(off)).distinct())
    return docs.join(by_size(gone), F.col(id_col).cast("bigint") == F.col(off), "left_anti")
