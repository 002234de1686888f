"""Repeated passages: recurring windows confirmed by count, automata per block of documents.

A window is `width` consecutive words of one document. Equal windows hold the same smallest hash
among their inner seven-word grams; that gram is the key of the window. The work is cut into blocks
of documents, spread by a hash of each row, and goes in three passes over the text:

1. Every block names its keys, one per key with the smallest document that has it. Keys are dealt
   into buckets by their value; a bucket sends each block those that also lie in other documents.
2. Every block names its windows under such keys, by fingerprints of 128 bits with the smallest
   document, and is sent those that recur, each with the first document it starts in.
3. Every block cuts its recurring windows into passages, compiles them into an Aho-Corasick
   automaton over its words, and streams all of its documents through it. An occurrence of a
   passage whose windows all start in smaller documents is removed.

So every automaton is a shard as large as its block, no document is streamed more than once, and a
key held by a third of all documents is one row per block. Nothing is sampled, capped or broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Hasher, mix, odd_numbers, raw, repeat_index, slices, words
from .cuts import Cuts, release
from .workers import ship

#: Words of a gram inside a window.
GRAM = 7
#: Bytes of text in a block, on average.
BLOCK_BYTES = 4 << 20
#: Bytes of text whose keys go to one bucket, on average.
BUCKET_BYTES = 8 << 20
#: Windows of a passage at most; longer runs are cut into passages that overlap.
RUN = 52

WORD = re.compile(r"[^\x20\x09-\x0D]+")

_ENTRIES = "bucket int, block bigint, one binary, two binary, low binary, many binary"
_REPLIES = "block bigint, one binary, two binary, low binary"


class Windows:
    """Keys and fingerprints of all windows in slices of texts."""

    def __init__(self, width: int):
        self.width, self.gram = width, min(GRAM, width)
        self.grams = odd_numbers(self.gram, 11)
        self.weights = odd_numbers(width, 12), odd_numbers(width, 13)

    def _sums(self, hashed: np.ndarray, weights: np.ndarray) -> np.ndarray:
        n = len(hashed) - len(weights) + 1
        out = hashed[:n] * weights[0]
        for k in range(1, len(weights)):
            out += hashed[k : k + n] * weights[k]
        return mix(out)

    def rows(self, column: pa.Array) -> Iterator[tuple]:
        """(first row, windows' rows, their first words in the row, word hashes, windows' places)."""
        body, at = raw(column)
        for low, high in slices(at):
            data, inside = body[at[low] : at[high]], at[low : high + 1] - at[low]
            starts, ends, first = words(data, inside)
            number = np.maximum(np.diff(first) - self.width + 1, 0)
            if not number.sum():
                continue
            row = np.repeat(np.arange(high - low), number)
            begins = repeat_index(number)
            hashed = Hasher(data, fold=False).of(starts, ends)
            yield low + row, begins, hashed, first[:-1][row] + begins

    def keys(self, hashed: np.ndarray) -> np.ndarray:
        """The key of the window that begins at each word."""
        grams = self._sums(hashed, self.grams)
        steps = self.width - self.gram + 1
        out = grams[: len(grams) - steps + 1].copy()
        for k in range(1, steps):
            np.minimum(out, grams[k : k + len(out)], out=out)
        return out

    def prints(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._sums(hashed, self.weights[0]), self._sums(hashed, self.weights[1])


def _least(one: np.ndarray, two: np.ndarray, low: np.ndarray, many: np.ndarray | None):
    """Distinct (one, two), their smallest `low`, whether several documents have them, and where."""
    order = np.lexsort((two, one)) if two.any() else np.argsort(one, kind="stable")
    one, two, low = one[order], two[order], low[order]
    new = np.ones(len(one), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return one, two, low, np.zeros(0, bool), order
    least = np.minimum.reduceat(low, at)
    several = np.maximum.reduceat(low, at) > least
    if many is not None:
        several |= np.maximum.reduceat(many[order], at) > 0
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return one[at], two[at], least, several, group


def _entries(block: int, buckets: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Table:
    """A block's keys dealt into buckets: one row per bucket with packed columns."""
    rows = []
    if parts:
        one, two, low, many, _ = _least(*(np.concatenate(x) for x in zip(*parts, strict=True)), None)
        dealt = ((one >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        edge = np.searchsorted(dealt, np.arange(buckets + 1, dtype=np.uint64))
        both = two.any()
        for k in np.flatnonzero(np.diff(edge)):
            s = slice(edge[k], edge[k + 1])
            rows.append((int(k), block, one[s].tobytes(), two[s].tobytes() if both else b"",
                         low[s].tobytes(), many[s].tobytes()))
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    names = ["bucket", "block", "one", "two", "low", "many"]
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _packed(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _merge(table: pa.Table) -> pa.Table:
    """A bucket's keys of all blocks: to each block those that several documents have."""
    one, low, many = (_packed(table, n, k) for n, k in (("one", "u8"), ("low", "i8"), ("many", "u1")))
    two = _packed(table, "two", "u8")
    both = len(two) > 0
    _, _, least, several, group = _least(one, two if both else np.zeros(len(one), "u8"), low, many)
    wanted, first = several[group], least[group]
    sizes = np.array([len(x) // 8 for x in table["one"].to_pylist()], np.int64)
    ends, rows = np.cumsum(sizes), []
    for block, n, end in zip(table["block"].to_pylist(), sizes, ends, strict=True):
        mine = wanted[end - n : end]
        if mine.any():
            s = slice(end - n, end)
            rows.append((block, one[s][mine].tobytes(), two[s][mine].tobytes() if both else b"",
                         first[s][mine].tobytes()))
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    kinds = [pa.int64(), *[pa.binary()] * 3]
    return pa.table(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "one", "two", "low"]
    )


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document ids, and which of them are there."""
    column = table["doc_id"].combine_chunks()
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype("i8"), column.is_valid().to_numpy(zero_copy_only=False)


def _passages(first: np.ndarray, begins: np.ndarray, tokens: list[int], width: int) -> Iterator[tuple]:
    """(token sequence, largest first document) of each run of consecutive windows, cut at RUN."""
    breaks = np.flatnonzero(np.diff(begins) != 1) + 1
    for run in np.split(np.arange(len(begins)), breaks):
        for at in range(0, len(run), RUN):
            piece = run[at : at + RUN]
            low, high = int(begins[piece[0]]), int(begins[piece[-1]]) + width
            yield tuple(tokens[low:high]), int(first[piece].max())


def _locate(table: pa.Table, replies: pa.Table, width: int) -> pa.Table:
    """A block's documents with their removed words, by the automaton of its recurring passages."""
    windows = Windows(width)
    one, two, low = (_packed(replies, n, k) for n, k in (("one", "u8"), ("two", "u8"), ("low", "i8")))
    order = np.lexsort((two, one))
    one, two, low = one[order], two[order], low[order]
    ids, named = _ids(table)
    texts = table["text"].combine_chunks()
    runs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for row, begins, hashed, place in windows.rows(texts) if len(one) else ():
        a, b = windows.prints(hashed)
        a, b = a[place], b[place]
        at = np.minimum(np.searchsorted(one, a), len(one) - 1)
        # Equal first halves lie side by side; step on while the second half is too small.
        while len(step := np.flatnonzero((one[at] == a) & (two[at] < b) & (at + 1 < len(one)))):
            at[step] += 1
        hit = (one[at] == a) & (two[at] == b) & (low[at] < ids[row]) & named[row]
        hits = np.flatnonzero(hit)
        for part in np.split(hits, np.flatnonzero(np.diff(row[hits])) + 1) if len(hits) else ():
            runs.setdefault(int(row[part[0]]), []).append((low[at[part]], begins[part]))
    numbers: dict[str, int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for row, found in runs.items():
        tokens = [numbers.setdefault(w, len(numbers) + 1) for w in WORD.findall(texts[row].as_py())]
        for first, begins in found:
            for passage, largest in _passages(first, begins, tokens, width):
                automaton.add_word(passage, (len(passage), largest))
    if runs:
        automaton.make_automaton()
    counts, removed, spans, kept = [], [], [], []
    for row, text in enumerate(texts):
        mine = WORD.findall(text.as_py() or "")
        gone = np.zeros(len(mine) + 1, np.int64)
        if runs and named[row] and len(mine) >= width:
            sequence = tuple([numbers.get(w, 0) for w in mine])
            for end, (length, largest) in automaton.iter(sequence):
                if largest < ids[row]:
                    gone[end - length + 1] += 1
                    gone[end + 1] -= 1
        off = np.cumsum(gone)[:-1] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], off, [0]])))
        counts.append(len(mine))
        removed.append(int(off.sum()))
        spans.append([{"low": int(a), "high": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        kept.append(" ".join(w for w, x in zip(mine, off.tolist(), strict=True) if not x) if off.any() else " ".join(mine))
    span = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
    return pa.table(
        {
            "doc_id": pa.array(table["doc_id"].combine_chunks(), pa.int64()),
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "removed": pa.array(spans, span),
            "kept": pa.array(kept, pa.string()),
        }
    )


def without_passages(docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words of passages that already start in an earlier one.

    A word goes if a window of `width` words covers it whose word sequence also starts in a
    document with a smaller id; windows are those of the input. Words are runs without blanks or
    bytes 9 to 13, unchanged. Returns doc_id, n_words, n_removed, the removed ranges of words
    [low, high) and the kept words joined by one blank.

    A null or empty text has no words. A text under `width` words keeps them all. Rows with equal
    ids remove nothing from each other; a null id neither removes nor loses anything. Rows of the
    result are as many as those of the input. Other columns are not read, so their names are free.
    A block is held by one task, with a longer text as it is.
    """
    spark = docs.sparkSession
    ship(spark)
    cuts = Cuts(spark)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks, buckets = size // BLOCK_BYTES + 1, size // BUCKET_BYTES + 1
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def name_keys(table: pa.Table) -> pa.Table:
        windows, parts = Windows(width), []
        ids, named = _ids(table)
        for row, _, hashed, place in windows.rows(table["text"]):
            keys = windows.keys(hashed)[place]
            # Neighbours mostly share their key.
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])
            new &= named[row]
            parts.append((keys[new], np.zeros(int(new.sum()), "u8"), ids[row[new]]))
        return _entries(table["block"][0].as_py(), buckets, parts)

    def name_windows(table: pa.Table, replies: pa.Table) -> pa.Table:
        parts = []
        if len(replies) and len(table):
            known = np.sort(_packed(replies, "one", "u8"))
            windows = Windows(width)
            ids, named = _ids(table)
            for row, _, hashed, place in windows.rows(table["text"]):
                keys = windows.keys(hashed)[place]
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = (known[at] == keys) & named[row]
                a, b = windows.prints(hashed)
                parts.append((a[place[hit]], b[place[hit]], ids[row[hit]]))
        return _entries(table["block"][0].as_py() if len(table) else 0, buckets, parts)

    def locate(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _locate(table, replies, width)

    def answers(entries: DataFrame) -> DataFrame:
        out = cuts.cut(entries.groupBy("bucket").applyInArrow(_merge, _REPLIES))
        release(spark)
        return out

    keys = answers(rows.groupBy("block").applyInArrow(name_keys, _ENTRIES))
    known = answers(rows.groupBy("block").cogroup(keys.groupBy("block")).applyInArrow(name_windows, _ENTRIES))
    cuts.drop(keys)
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        locate, "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<low: int, high: int>>, kept string"
    )
