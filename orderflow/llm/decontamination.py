"""Benchmark decontamination: random-walk embedding, bit-sampled hashing, exact edit distance.

A walk reads a window of words from its start. At step t it writes down the word it stands on and
moves on by one word if bit t of that word's hash is set, so windows that differ by few edits fall
into step again and what they write differs in few places. Hash keys are made of a few sampled
places of the walk; a document window that has a key in common with a benchmark item at the same
size is a candidate, and the edit distance between the item and the document around the window
decides. All windows of a slice walk at once, and since two walks that meet stay together, only
the distinct places are moved on.

Items also walk from later words, so that edits near their start do not hide them. Windows come in
sizes of 8, 16 and 32 words; an item uses the largest that fits from each start.

Walks find an item with some probability, which is low for short ones. So each item is also cut into
one piece more than edits are allowed. Edits leave one piece as it was, so a document holds an item
only where it holds one of its pieces word for word, and all places where it does are candidates
too: nothing within the allowed distance is lost. Characters of scripts without blanks are words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import Hasher, mix, odd_numbers, powers, raw, repeat_index, slices, words
from .workers import map_batches

#: Words of edit distance allowed per hundred words of the item.
EDIT_PERCENT = 20
#: Items with fewer words do not walk.
LEAST_WORDS = 8
#: Words of a piece that are looked up; the rest of a longer one is left to the edit distance.
PIECE_WORDS = 8
#: Words of regions whose edit distances are found together.
TOGETHER = 1 << 18
#: Items held against all documents in one pass.
BLOCK = 2_000
SIZES = (8, 16, 32)
WALKS = 2
SETS = 2
SAMPLED = 5
#: Steps after which walks that have met are joined.
MEET = (1, 3, 6, 10, 16, 24, 36, 50)
_TABLE_BITS = 22


def _samples() -> dict[int, list[list[list[int]]]]:
    """For each size, walk and set: the steps whose places make a key, in order."""
    random = np.random.default_rng(11)
    return {
        size: [
            [
                sorted(random.choice(2 * size, SAMPLED, replace=False).tolist())
                for _ in range(SETS)
            ]
            for _ in range(WALKS)
        ]
        for size in SIZES
    }


_STEPS = _samples()
_TIMES = odd_numbers(SAMPLED + 1, 21)


class Walks:
    """Keys of the walks from every word of a run of words, for some window sizes."""

    def __init__(self, hashed: np.ndarray, sizes: list[int]):
        self.keys: dict[tuple[int, int, int], np.ndarray] = {}
        if not sizes or not len(hashed):
            return
        last = 2 * max(sizes)
        padded = np.concatenate([hashed, np.zeros(last + 1, np.uint64)])
        for walk in range(WALKS):
            bits = mix(padded ^ odd_numbers(WALKS, 22)[walk])
            wanted = {t for size in sizes for steps in _STEPS[size][walk] for t in steps}
            place = np.arange(len(hashed))
            seen: dict[int, tuple[int, np.ndarray]] = {}
            joins: list[np.ndarray] = []
            for t in range(last):
                if t in wanted:
                    seen[t] = (len(joins), padded[place])
                place = place + ((bits[place] >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
                if t in MEET:
                    fresh = np.append(True, place[1:] != place[:-1])
                    joins.append(np.cumsum(fresh) - 1)
                    place = place[fresh]
            for size in sizes:
                for k, steps in enumerate(_STEPS[size][walk]):
                    self.keys[size, walk, k] = self._key(seen, joins, steps, size * 64 + walk * 8 + k)

    @staticmethod
    def _key(seen, joins, steps, salt) -> np.ndarray:
        level, key = seen[steps[-1]]
        key = (key ^ np.uint64(salt)) * _TIMES[0]
        for n, t in enumerate(reversed(steps[:-1]), 1):
            upper, value = seen[t]
            while level > upper:
                level -= 1
                key = key[joins[level]]
            key = key * _TIMES[n] + value
        while level:
            level -= 1
            key = key[joins[level]]
        return mix(key)


#: First and last characters of scripts written without blanks: Thai, Lao, Tibetan, Burmese, Khmer,
#: Tai and Yi, kana, bopomofo and Han.
_UNSPACED = [
    (0xE00, 0xFFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x303B), (0x3040, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF),
    (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F),
    (0x20000, 0x3FFFF),
]
#: Blanks and marks of the same scripts, which separate as those of ASCII do.
_MARKS = [
    (0xE2F, 0xE2F), (0xE5A, 0xE5B), (0xF08, 0xF14), (0x104A, 0x104F), (0x17D4, 0x17DA), (0x3000, 0x3004),
    (0x3008, 0x3020), (0x302A, 0x3030), (0x303C, 0x303F), (0x30FB, 0x30FB), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20),
    (0xFF3B, 0xFF40), (0xFF5B, 0xFF65),
]


def _within(code: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    edges = np.array(ranges).ravel() + np.tile([0, 1], len(ranges))
    return np.searchsorted(edges, code, "right") % 2 == 1


def _all_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`words` with letters, in which each character of a script without blanks is a word."""
    starts, ends, first = words(data, at, letters=True)
    lead = np.flatnonzero(data >= 0xE0)
    if not len(lead):
        return starts, ends, first
    size = np.where(data[lead] >= 0xF0, 4, 3)
    code = data[lead].astype(np.int64) & np.where(size == 4, 7, 15)
    for k in range(1, 4):
        more = data[np.minimum(lead + k, len(data) - 1)] & 63
        code = np.where(k < size, code << 6 | more, code)
    mark = _within(code, _MARKS)
    cut = mark | _within(code, _UNSPACED)
    before, after = lead[cut], lead[cut] + size[cut]
    begin = np.union1d(np.union1d(starts, before), np.setdiff1d(after, ends))
    ends = np.union1d(np.union1d(ends, after), np.setdiff1d(before, starts))
    keep = ~np.isin(begin, lead[mark])
    begin, ends = begin[keep], ends[keep]
    return begin, ends, np.searchsorted(begin, at)


def _runs(hashed: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words."""
    power, inverse = powers(len(hashed))
    sums = np.append(np.uint64(0), np.cumsum(hashed * power[: len(hashed)]))
    n = max(0, len(hashed) - size + 1)
    return mix((sums[size : size + n] - sums[:n]) * inverse[:n] + np.uint64(size))


def _pieces(words: int, percent: int) -> list[tuple[int, int]]:
    """First word and looked-up size of one piece more than edits are allowed."""
    number = min(percent * words // 100 + 1, words)
    at = [words * k // number for k in range(number + 1)]
    return [(a, min(b - a, PIECE_WORDS)) for a, b in zip(at, at[1:], strict=False)]


def _word_hashes(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Word hashes, row offsets among them and the first row, per slice."""
    body, at = raw(texts)
    for low, high in slices(at):
        data = body[at[low] : at[high]]
        starts, ends, first = _all_words(data, at[low : high + 1] - at[low])
        hashed = Hasher(data).of(starts, ends) if len(starts) else np.zeros(0, np.uint64)
        yield hashed, first, low


class Items:
    """Benchmark items as words, and indexes from walk keys and pieces to item and start."""

    def __init__(self, rows: list[tuple[int, str | None]], percent: int = EDIT_PERCENT):
        self.ids, self.words = [], []
        for hashed, first, low in _word_hashes(pa.array([t for _, t in rows], pa.large_string())):
            for k in range(len(first) - 1):
                one = hashed[first[k] : first[k + 1]]
                if len(one):
                    self.ids.append(rows[low + k][0])
                    self.words.append(one)
        self.lengths = np.array([len(one) for one in self.words], np.int64)
        self.index: dict[tuple[int, int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found, pieces = defaultdict(list), defaultdict(list)
        for item, one in enumerate(self.words):
            n = len(one)
            for start, size in _pieces(n, percent):
                pieces[size].append((int(_runs(one[start : start + size], size)[0]), item, start))
            if n < LEAST_WORDS:
                continue
            starts = sorted({0, *range(0, n - SIZES[0] + 1, max(2, n // 6))})
            for start in starts:
                size = max(s for s in SIZES if s <= n - start)
                walks = Walks(one[start:], [size])
                for name, keys in walks.keys.items():
                    found[name].append((int(keys[0]), item, start))
        for index, all_entries in ((self.index, found), (self.pieces, pieces)):
            for name, entries in all_entries.items():
                entries.sort()
                _, item, start = (np.array(c) for c in zip(*entries, strict=True))
                index[name] = (np.array([e[0] for e in entries], np.uint64), item, start)
        self.sizes = sorted({name[0] for name in self.index})
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        for key, _, _ in [*self.index.values(), *self.pieces.values()]:
            self.table[key >> np.uint64(64 - _TABLE_BITS)] = True

    def candidates(self, hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (item, row, where the item would begin) of all windows, as three columns."""
        out = [np.zeros((0, 3), np.int64)]

        def row_of(place):
            return np.searchsorted(first, np.clip(place, 0, len(hashed) - 1), "right") - 1

        for name, keys in Walks(hashed, self.sizes).keys.items():
            if name in self.index:
                _, item, begin = self._met(keys, self.index[name])
                # A window may begin before its row; the row is the one in which the item's middle lies.
                for row in (row_of(begin), row_of(begin + self.lengths[item] // 2)):
                    out.append(np.column_stack([item, row, begin]))
        for size, known in self.pieces.items():
            window, item, begin = self._met(_runs(hashed, size), known)
            row = row_of(window)
            inside = window + size <= first[row + 1]
            out.append(np.column_stack([item, row, begin])[inside])
        return np.unique(np.concatenate(out), axis=0)

    def _met(self, keys: np.ndarray, entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window, item and where the item would begin for all entries with the key of a window."""
        known, item, start = entries
        window = np.flatnonzero(self.table[keys >> np.uint64(64 - _TABLE_BITS)])
        low = np.searchsorted(known, keys[window], "left")
        number = np.searchsorted(known, keys[window], "right") - low
        entry = np.repeat(low, number) + repeat_index(number)
        window = np.repeat(window, number)
        return window, item[entry], window - start[entry]


def window_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance between the item and any run of the text, and where that run ends."""
    distance, end = window_distances(item, text[None, :])
    return int(distance[0]), int(end[0])


def window_distances(item: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`window_distance` for each row of texts of one length."""
    cost = np.zeros((len(texts), texts.shape[1] + 1), np.int64)
    step = np.arange(texts.shape[1] + 1)
    for k, word in enumerate(item, 1):
        new = np.empty_like(cost)
        new[:, 0] = k
        new[:, 1:] = np.minimum(cost[:, :-1] + (texts != word), cost[:, 1:] + 1)
        cost = np.minimum.accumulate(new - step, 1) + step
    end = cost.argmin(1)
    return cost[np.arange(len(cost)), end], end


def _hits(items: Items, hashed: np.ndarray, first: np.ndarray, percent: int) -> dict[tuple[int, int], tuple[int, int]]:
    """(row, item) to (distance, first word of the region) of the confirmed candidates."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    if not len(hashed):
        return best
    found = items.candidates(hashed, first)
    # In order of item; each item's regions have one length.
    edge = np.flatnonzero(np.diff(found[:, 0], prepend=-1, append=-1)) if len(found) else []
    for k in range(len(edge) - 1):
        item = int(found[edge[k], 0])
        one, n = items.words[item], len(items.words[item])
        most = percent * n // 100
        together = max(1, TOGETHER // (n + 2 * most))
        for at in range(edge[k], edge[k + 1], together):
            row, begin = found[at : min(at + together, edge[k + 1]), 1:].T
            low, high = first[row], first[row + 1]
            place = (begin - most)[:, None] + np.arange(n + 2 * most)
            own = (place >= low[:, None]) & (place < high[:, None])
            # Words outside of the row are equal to none.
            region = np.where(own, hashed[np.clip(place, 0, len(hashed) - 1)], np.uint64(0))
            exact = (region[:, most : most + n] == one).all(1)
            # Each word of the item that is not edited stands in the region.
            near = np.flatnonzero(~exact & (np.isin(region, one).sum(1) >= n - most))
            distance = np.where(exact, 0, most + 1)
            head = begin - low
            if len(near):
                distance[near], end = window_distances(one, region[near])
                head[near] = np.maximum(0, begin[near] - most - low[near] + end - n)
            for r, d, h in zip(row.tolist(), distance.tolist(), head.tolist(), strict=True):
                known = best.get((r, item))
                if d <= most and (known is None or d < known[0]):
                    best[r, item] = (d, h)
    return best


def item_blocks(
    benchmark: DataFrame, percent: int = EDIT_PERCENT, *, id_col: str = "item_id", text_col: str = "text"
) -> Iterator[Items]:
    """The benchmark in blocks of `BLOCK` items, so that any number of items passes in bounded memory."""
    rows: list[tuple[int, str | None]] = []
    for row in benchmark.select(F.col(id_col).cast("bigint"), text_col).toLocalIterator():
        rows.append((row[0], row[1]))
        if len(rows) == BLOCK:
            yield Items(rows, percent)
            rows = []
    if rows:
        yield Items(rows, percent)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, percent: int = EDIT_PERCENT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, item_id, distance, first_word, n_words for each document and item it holds.

    Words are runs of letters and digits, ASCII letters lower-cased, and single characters of
    scripts without blanks. An item is held if some run of the document's words is within `percent`
    percent of the item's words in edit distance, so an item of fewer words than allow one edit
    only word for word; the least distance of all candidates is given, and where that run begins.
    Cases: null and empty texts hold nothing; items of null text or without words are not held;
    repeated items and repeated documents are each reported; no items give no rows. Other columns
    are not looked at.
    """
    found = None
    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    for items in item_blocks(benchmark, percent):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            items = shared.value
            for batch in batches:
                out = []
                for hashed, first, low in _word_hashes(batch.column(1)):
                    for (row, item), (distance, at) in _hits(items, hashed, first, percent).items():
                        out.append((low + row, items.ids[item], distance, at, len(items.words[item])))
                rows, ids, distances, places, sizes = zip(*out, strict=True) if out else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        *[pa.array(c, pa.int64()) for c in (ids, distances, places, sizes)],
                    ],
                    names=["doc_id", "item_id", "distance", "first_word", "n_words"],
                )

        schema = "doc_id bigint, item_id bigint, distance bigint, first_word bigint, n_words bigint"
        part = map_batches(given, run, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return given.select(
            "doc_id", *[F.lit(0).cast("bigint").alias(c) for c in ("item_id", "distance", "first_word", "n_words")]
        ).filter("false")
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, percent: int = EDIT_PERCENT, text_col: str = "text") -> DataFrame:
    """The documents that hold no item, each row as it was; nothing is shuffled."""
    place = docs.columns.index(text_col)
    for items in item_blocks(benchmark, percent):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            for batch in batches:
                clean = np.ones(len(batch), bool)
                for hashed, first, low in _word_hashes(batch.column(place)):
                    for row, _ in _hits(shared.value, hashed, first, percent):
                        clean[low + row] = False
                yield batch.filter(pa.array(clean))

        docs = map_batches(docs, run, docs.schema)
    return docs
