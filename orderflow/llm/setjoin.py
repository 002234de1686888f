"""Components of sets that share most of their union, from signatures, for any keys and any sets.

`reps` holds one row per distinct set: id, n (its size) and sig (16 bits for each of its minimum
hashes). The caller says under which keys a signature is filed, in how many places two linked
signatures may differ if that is limited, how the texts of ids are fetched, and how texts become sets. Texts and not
sets travel through the shuffles, since they are smaller and compress.

Pairs inside a key are not all written out. Keys travel packed, a row for each batch and bucket of
keys, and a bucket at a time is sorted, which leaves out the keys of a single set; keys that a sample
shows under very many sets would make one bucket long and are grouped instead. First every set is held against the first one under its key only, and what the exact check confirms is joined into components; groups of copies end
here. Keys that still hold several components are settled by an exact join of their members
alone: a set is filed under the rarest of its items, as many as a partner must share one of, and a
pair is taken up only if they are of different components and the sizes and places of the shared item
still allow the wanted overlap. Without a limit of places, pairs are held against parities before: a bit for each of `PARITIES` parts of the
items says whether a set has an odd number there. Each bit in which two sets differ stands for an
item that only one of them has, so no pair that reaches the share is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytetext import repeat_index, SLICE_BYTES, raw
from .components import components
from .cuts import Cuts, release
from .workers import map_batches

#: Sets whose items are counted to tell rare from frequent ones; only speed hangs on it.
COUNTED = 20_000
COUNTER_BITS = 20
#: Sets out of those counted from which a key is common, so that at most a bounded number of keys is.
COMMON = 100
#: Sets to a bucket of keys, unless that makes fewer than four buckets a shuffle partition.
BUCKET = 1 << 16
#: 64 bits of a column for each 64.
PARITIES = 256
_PARITY = [f"parity{k}" for k in range(PARITIES // 64)]
_EVERY_OTHER = 0x5555555555555555
#: Pairs compared together; the row of a pair takes eight bits of an item, 56 of its hash stay.
PAIRS = 256
#: Rows of items taken together, and pairs of them held against each other at once.
BLOCK = 1 << 16
CANDIDATES = 1 << 18
_ROW = np.uint64(56)


def numbered(cuts: Cuts, distinct: DataFrame, *head: str) -> DataFrame:
    """`distinct` as a written table with an id that grows with the columns `head`."""
    spread = distinct.repartitionByRange(*head).sortWithinPartitions(*head)
    return cuts.cut(spread.withColumn("id", F.monotonically_increasing_id()))


def _packed(key: np.ndarray, one: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: the keys that fall into it and their ids, as whole numbers of eight bytes."""
    bucket = ((key.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    number = np.bincount(bucket, minlength=buckets)
    filled = np.flatnonzero(number)
    at = pa.py_buffer(np.append(0, 8 * np.cumsum(number[filled])).astype(np.int32))
    sides = [pa.Array.from_buffers(pa.binary(), len(filled), [None, at, pa.py_buffer(x[order])]) for x in (key, one)]
    return pa.RecordBatch.from_arrays([pa.array(filled.astype(np.int32)), *sides], names=["bucket", "keys", "ids"])


def _met_in(bucket: list[pa.RecordBatch]) -> pa.RecordBatch:
    """(key, id, first) for the keys that several rows of a bucket have."""
    sides = []
    for k in (1, 2):
        parts = [raw(part.column(k)) for part in bucket]
        sides.append(np.concatenate([body[at[0] : at[-1]] for body, at in parts]).view(np.int64))
    order = np.argsort(sides[0])
    key, one = (x[order] for x in sides)
    again = np.append(False, key[1:] == key[:-1])
    several = again | np.append(again[1:], False)
    key, one, begin = key[several], one[several], np.flatnonzero(~again[several])
    first = np.minimum.reduceat(one, begin) if len(begin) else one
    first = np.repeat(first, np.diff(np.append(begin, len(key))))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (key, one, first)], names=["key", "id", "first"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, first) of packed rows sorted by bucket; one bucket is held at a time."""
    held, of = [], None
    for batch in batches:
        bucket = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if held and bucket[low] != of:
                yield _met_in(held)
                held = []
            if high > low:
                of = bucket[low]
                held.append(batch.slice(low, high - low))
    if held:
        yield _met_in(held)


def _whole_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by item, at least `BLOCK` of them together if there are, and no item in two blocks."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not len(batch):
            continue
        item = batch.column(0).to_numpy()
        if rows >= BLOCK:
            last = held[-1].column(0)[-1].as_py()
            other = np.flatnonzero(item != last)
            if len(other):
                yield pa.Table.from_batches([*held, batch.slice(0, other[0])])
                batch = batch.slice(other[0])
                held, rows = [], 0
        held.append(batch)
        rows += len(batch)
    if held:
        yield pa.Table.from_batches(held)


def _across(block: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (x, y) of rows of one item, two components, and the same or the next class of sizes.

    x is a row whose place allows the share with a set that is not smaller. The rows are sorted by item,
    class and component.
    """
    item, size, root, n = (block[c] for c in ("item", "size", "root", "n"))
    change = (item[1:] != item[:-1]) | (size[1:] != size[:-1])
    first = np.append(0, np.flatnonzero(change) + 1)
    end = np.append(first[1:], len(item))
    group = np.repeat(np.arange(len(first)), end - first)
    own = group << 32 | np.unique(root, return_inverse=True)[1]
    x = np.flatnonzero((100 + percent) * (n - block["place"]) >= 2 * percent * n)
    follows = np.append((item[first[1:]] == item[first[:-1]]) & (size[first[1:]] == size[first[:-1]] + 1), False)
    sides, low, high = [], [], []
    for some, away in ((x, 0), (x[follows[group[x]]], 1)):
        among, key = group[some] + away, own[some] + (away << 32)
        sides += [some, some]
        low += [first[among], np.searchsorted(own, key, "right")]
        high += [np.searchsorted(own, key), end[among]]
    x, low = np.concatenate(sides), np.concatenate(low)
    many = np.concatenate(high) - low
    x, low, many = x[many > 0], low[many > 0], many[many > 0]
    done = np.cumsum(many)
    begin = 0
    while begin < len(x):
        stop = max(begin + 1, int(np.searchsorted(done, done[begin] + CANDIDATES)))
        part = slice(begin, stop)
        yield np.repeat(x[part], many[part]), np.repeat(low[part], many[part]) + repeat_index(many[part])
        begin = stop


def _pair_slices(x: pa.Array, y: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of up to `PAIRS` pairs and about `SLICE_BYTES` bytes; a longer pair is its own."""
    (_, a), (_, b) = raw(x), raw(y)
    size, low, n = a - a[0] + b - b[0], 0, len(x)
    while low < n:
        high = int(np.searchsorted(size, size[low] + SLICE_BYTES, "right")) - 1
        high = min(max(high, low + 1), low + PAIRS, n)
        yield low, high
        low = high


def _marked(parts: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The items of up to `PAIRS` rows, each once in a row, sorted, the row in the top bits."""
    hashes, offsets = zip(*parts, strict=True)
    sizes = np.concatenate([np.diff(at) for at in offsets])
    items = np.concatenate(hashes) >> np.uint64(64 - int(_ROW))
    items |= np.repeat(np.arange(len(sizes), dtype=np.uint64) << _ROW, sizes)
    items.sort()
    return items[np.append(True, items[1:] != items[:-1])] if len(items) else items


def alike(x: np.ndarray, y: np.ndarray, rows: int, percent: int) -> np.ndarray:
    """For each row whether its sets, as `_marked` gives them, share `percent` percent of their union."""
    both = np.concatenate([x, y])
    both.sort()
    common = both[1:][both[1:] == both[:-1]]
    n_x, n_y, shared = (np.bincount((items >> _ROW).astype(np.int64), minlength=rows) for items in (x, y, common))
    return 100 * shared >= percent * (n_x + n_y - shared)


@dataclass
class SetJoin:
    cuts: Cuts
    reps: DataFrame
    keys: Column
    places: int
    may_differ: int | None
    percent: int
    fetch: Callable[[DataFrame], DataFrame]  # (id) -> (id, body)
    # texts -> hashed items, repeats included, and the offsets of the texts among them, by slices
    items_of: Callable[[pa.Array], Iterator[tuple[np.ndarray, np.ndarray]]]

    def _sets(self) -> Callable[[pa.Array], list[np.ndarray]]:
        """What gives the sorted distinct items of each text."""
        items_of = self.items_of

        def sets_of(texts):
            return [np.unique(x[low:high]) for x, at in items_of(texts) for low, high in zip(at[:-1].tolist(), at[1:].tolist())]

        return sets_of

    def roots(self) -> DataFrame:
        """(id, root) for each id whose component has a smaller id."""
        cuts = self.cuts
        met = cuts.cut(self._met())
        star = met.filter("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
        pairs = cuts.cut(self._close(star.distinct()))
        texts = self._texts(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
        links = cuts.cut(self._confirmed(pairs, texts))
        cuts.drop(texts)
        release(cuts.spark)
        roots = components(cuts, links)
        late = self._rest(met, roots)
        return roots if cuts.empty(late) else components(cuts, links.union(late))

    def _met(self) -> DataFrame:
        """(key, id, first) for each key of several ids, first being the smallest of them."""
        spark, rows = self.reps.sparkSession, max(1, self.reps.count())
        draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
        some = self.reps.filter(draw < int((1 << 20) * min(1.0, COUNTED / rows)))
        often = some.select(F.explode(self.keys).alias("key")).groupBy("key").count().filter(F.col("count") >= COMMON)
        common = sorted(row["key"] for row in often.collect())
        left_out = np.array(common, np.int64)
        buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows // BUCKET)

        def pack(batches):
            for batch in batches:
                lists = batch.column(0)
                key = lists.flatten().to_numpy()
                one = np.repeat(batch.column(1).to_numpy(), lists.value_lengths().to_numpy())
                if len(left_out):
                    lone = ~np.isin(key, left_out)
                    key, one = key[lone], one[lone]
                if len(key):
                    yield _packed(key, one, buckets)

        packed = map_batches(self.reps.select(self.keys.alias("keys"), "id"), pack, "bucket int, keys binary, ids binary")
        dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
        met = map_batches(dealt, _meetings, "key bigint, id bigint, first bigint")
        if not common:
            return met
        held = self.reps.select(F.explode(self.keys).alias("key"), "id").filter(F.col("key").isin(common))
        firsts = held.groupBy("key").agg(F.min("id").alias("first"))
        return met.union(held.join(F.broadcast(firsts), "key").select("key", "id", "first"))

    def _texts(self, ids: DataFrame) -> DataFrame:
        """(id, body), each id once even if its row is repeated in the input."""
        ids = self.cuts.cut(ids.distinct())
        texts = self.cuts.cut(self.fetch(ids))
        return self.cuts.cut(texts.dropDuplicates(["id"])) if texts.count() > ids.count() else texts

    def _rest(self, met: DataFrame, roots: DataFrame) -> DataFrame:
        """Links between the components that meet under some key."""
        cuts = self.cuts
        # The first of a key has been held against all others, so only those are left.
        placed = met.filter("id != first").join(roots, "id", "left")
        placed = placed.select("key", "id", F.coalesce("root", "id").alias("root"))
        spread = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = spread.filter("low != high").select("key")
        open_ids = placed.join(mixed, "key").select("id", "root").distinct()
        marks = _PARITY if self.may_differ is None else ["sketch"]
        open_ids = cuts.cut(open_ids if self.may_differ is None else self._sketched(open_ids))
        cuts.drop(met)
        texts = self._texts(open_ids.select("id"))
        rare = cuts.cut(self._rare_first(texts).join(open_ids, "id"))
        pairs = self._sharing(rare, marks).distinct()
        late = cuts.cut(self._confirmed(cuts.cut(self._close(pairs)), texts))
        cuts.drop(texts, rare)
        return late

    def _sharing(self, rare: DataFrame, marks: list[str]) -> DataFrame:
        """(a, b) for rows of `_rare_first` of two components with one item, if sizes, places and marks allow a link.

        Sets of one component are never held against each other, nor those too far apart in size, and of
        two sets the smaller one only where its places still allow the share: the work is that of the
        pairs that may be links, not of all that have the item.
        """
        percent, may_differ = self.percent, self.may_differ
        # Two sets that may be linked are in one class of sizes or in two that follow each other.
        ratio = float(np.log(100.1 / percent))
        names = ["item", "root", "id", "n", "place", *marks]
        dealt = rare.select(*names).repartition("item").sortWithinPartitions("item")

        def near(block, x, y):
            differ = [(block[c][x] ^ block[c][y]).view(np.uint64) for c in marks]
            if may_differ is None:
                apart = sum(np.bitwise_count(d).astype(np.int64) for d in differ)
                return (100 + percent) * apart <= (100 - percent) * (block["n"][x] + block["n"][y])
            places = (differ[0] | differ[0] >> np.uint64(1)) & np.uint64(_EVERY_OTHER)
            return np.bitwise_count(places) <= may_differ

        def run(batches):
            for rows in _whole_items(batches):
                block = {name: rows.column(k).to_numpy() for k, name in enumerate(names)}
                size = np.floor(np.log(block["n"]) / ratio).astype(np.int64)
                order = np.lexsort((block["root"], size, block["item"]))
                block = {name: column[order] for name, column in (block | {"size": size}).items()}
                for x, y in _across(block, percent):
                    n_x, n_y = block["n"][x], block["n"][y]
                    most = np.minimum(n_x - block["place"][x], n_y - block["place"][y])
                    ordered = (n_x < n_y) | ((n_x == n_y) & (block["id"][x] < block["id"][y]))
                    may = ordered & (100 * most >= percent * (n_x + n_y - most))
                    x, y = x[may], y[may]
                    allowed = near(block, x, y)
                    x, y = x[allowed], y[allowed]
                    lower = block["root"][x] < block["root"][y]
                    found = np.stack([block["id"][np.where(lower, x, y)], block["id"][np.where(lower, y, x)]])
                    found = np.unique(found, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

        return map_batches(dealt, run, "a bigint, b bigint")

    def _sketched(self, ids: DataFrame) -> DataFrame:
        """(id, root) with two bits of each of the first 32 places of the signature beside.

        Places that differ there differ in the signature too, so what a join drops by them could
        not have passed.
        """
        places = self.places

        def run(batches):
            shift = 2 * np.arange(min(32, places), dtype=np.uint64)
            for batch in batches:
                if len(batch):
                    sigs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, places)
                    bits = (sigs[:, : len(shift)] & np.uint16(3)).astype(np.uint64) << shift
                    sketch = pa.array(bits.sum(1, dtype=np.uint64).view(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), sketch], names=["id", "root", "sketch"]
                    )

        signed = self.reps.select("id", "sig").join(ids, "id").select("id", "root", "sig")
        return map_batches(signed, run, "id bigint, root bigint, sketch bigint")

    def _close(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and signatures allow a link; all without a limit of places."""
        if self.may_differ is None:
            return pairs
        for side in ("a", "b"):
            own = [F.col(c).alias(f"{c}_{side}") for c in ("n", "sig")]
            pairs = pairs.join(self.reps.select(F.col("id").alias(side), *own), side)
        sizes = 100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")
        places, most = self.places, self.may_differ

        def near(batches):
            for batch in batches:
                if not len(batch):
                    continue
                x, y = (
                    np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, places)
                    for k in (2, 3)
                )
                keep = pa.array((x != y).sum(1) <= most)
                yield batch.select([0, 1]).filter(keep)

        allowed = pairs.filter(sizes).select("a", "b", "sig_a", "sig_b")
        return map_batches(allowed, near, "a bigint, b bigint")

    def _confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs whose full sets reach the wanted share of their union."""
        for side in ("a", "b"):
            own = texts.select(F.col("id").alias(side), F.col("body").alias(f"body_{side}"))
            pairs = pairs.join(own, side)
        items_of, percent = self.items_of, self.percent

        def check(batches):
            for batch in batches:
                for low, high in _pair_slices(batch.column(2), batch.column(3)):
                    part = batch.slice(low, high - low)
                    x, y = (_marked(items_of(part.column(k))) for k in (2, 3))
                    yield part.select([0, 1]).filter(pa.array(alike(x, y, len(part), percent)))

        return map_batches(
            pairs.select("a", "b", "body_a", "body_b"), check, "a bigint, b bigint"
        )

    def _rare_first(self, texts: DataFrame) -> DataFrame:
        """(item, id, n, place): each set's rarest items, as many as a partner must share one of.

        Without a limit of places the parities of the set stand beside.
        """
        rows = max(1, texts.count())
        sets_of, percent = self._sets(), self.percent
        draw = F.pmod(F.xxhash64("id"), F.lit(1 << 20))

        def count(batches):
            for batch in batches:
                sets = sets_of(batch.column(0))
                cells = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - COUNTER_BITS)
                cell, number = np.unique(cells.astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(number)], names=["cell", "number"])

        some = texts.filter(draw < int((1 << 20) * min(1.0, COUNTED / rows))).select("body")
        counted = (
            map_batches(some, count, "cell bigint, number bigint")
            .groupBy("cell")
            .agg(F.sum("number").alias("count"))
            .toArrow()
        )
        counters = np.zeros(1 << COUNTER_BITS, np.int32)
        counters[counted["cell"].to_numpy()] = np.minimum(counted["count"].to_numpy(), 1 << 30)
        shared = texts.sparkSession.sparkContext.broadcast(counters)

        marks = _PARITY if self.may_differ is None else []

        def pick(batches):
            frequency = shared.value
            for batch in batches:
                out = []
                for one, items in zip(batch.column(0).to_pylist(), sets_of(batch.column(1)), strict=True):
                    n = len(items)
                    keep = n - (percent * n + 99) // 100 + 1
                    cells = (items >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)
                    order = np.lexsort((items, frequency[cells]))[:keep]
                    row = [items[order].view(np.int64), np.full(keep, one), np.full(keep, n), np.arange(keep)]
                    if marks:
                        parts = np.bincount((items % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
                        row += [np.full(keep, bits) for bits in np.packbits(parts % 2 == 1).view(np.int64)]
                    out.append(row)
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)],
                        names=["item", "id", "n", "place", *marks],
                    )

        schema = ", ".join(f"{c} bigint" for c in ("item", "id", "n", "place", *marks))
        return map_batches(texts.select("id", "body"), pick, schema)
