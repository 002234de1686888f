"""Document fingerprints by a randomised edit embedding.

One random walk, the same for all texts, reads a text from its start: at step t it writes down the
three characters it stands before and moves on by one if the walk's bit for (t, character) is set.
Texts within few edits fall into step again and differ in few places of what they write. A text of
n characters is walked for 2n steps. Of the steps a nested sample is kept: step t belongs to level
l if l bits of a hash of t are zero, and a text uses the lowest level that leaves about
`KEPT` steps, so that texts of different length are compared on the steps that both have kept.
The share of equal places estimates how alike two texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytetext import mix, odd_numbers
from .components import components
from .cuts import Cuts, by_size
from .workers import map_batches

KEPT = 192
#: Characters walked together.
CHARS = 4_000_000
_PERIOD = 4096
_BITS = (np.random.default_rng(5).random((_PERIOD, 256)) < 0.5).astype(np.int64)
_BITS[:, 0] = 0  # what follows the end of a text; a walk stays there


def _zeros(steps: np.ndarray) -> np.ndarray:
    """The level up to which each step is kept."""
    value = mix(steps.astype(np.uint64) * odd_numbers(1, 31)[0] + np.uint64(1))
    low = value & (~value + np.uint64(1))
    return np.log2(np.maximum(low, 1).astype(float)).astype(np.int64)


def _level(chars: np.ndarray) -> np.ndarray:
    return np.maximum(0, np.ceil(np.log2(np.maximum(2 * chars, 1) / KEPT))).astype(np.int64)


def fingerprint_texts(texts: list[str]) -> list[str]:
    """The fingerprint of each text: level, a colon, two hex digits per kept step."""
    # Texts of like length walk together, so that few steps are taken for the longest one alone.
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    out = [""] * len(texts)
    low, size = 0, 0
    for high in range(len(order) + 1):
        more = len(texts[order[high]]) if high < len(order) else CHARS
        if size and size + more > CHARS or high == len(order):
            part = order[low:high]
            for k, found in zip(part, _walk([texts[k] for k in part]), strict=True):
                out[k] = found
            low, size = high, 0
        size += more
    return out


def _walk(texts: list[str]) -> list[str]:
    count = np.array([len(t) for t in texts], np.int64)
    if not len(count):
        return []
    # Every text is followed by three fillers, so that three characters can be read anywhere.
    joined = "".join(t + "\0\0\0" for t in texts)
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    begin = np.cumsum(count + 3) - count - 3
    single = (mix(chars + np.uint64(3)) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    three = chars.copy()
    three[:-1] += chars[1:] << np.uint64(21)
    three[:-2] += chars[2:] << np.uint64(42)
    three = (mix(three) >> np.uint64(56)).astype(np.uint8)
    stops = begin + count
    single[stops] = 0
    order = np.argsort(-count, kind="stable")  # the longest first
    level, steps = _level(count)[order], 2 * count[order]
    place = begin[order].copy()
    longest = int(steps[0]) if len(steps) else 0
    kept = _zeros(np.arange(longest)) if longest else np.zeros(0, np.int64)
    # In order of length: the active texts come first, those of low level last.
    active = np.searchsorted(-steps, -np.arange(longest), "left")
    from_level = np.searchsorted(-level, -kept, "left")
    rows, values = [], []
    for t in range(longest):
        n = active[t]
        here = place[:n]
        if from_level[t] < n:
            values.append(three[here[from_level[t] :]])
            rows.append((from_level[t], n))
        place[:n] = here + _BITS[t % _PERIOD].take(single[here])
    who = np.concatenate([np.arange(a, b) for a, b in rows]) if rows else np.zeros(0, np.int64)
    what = np.concatenate(values) if values else np.zeros(0, np.uint8)
    sort = np.argsort(who, kind="stable")
    body = what[sort].tobytes()
    ends = np.searchsorted(who[sort], np.arange(len(texts) + 1))
    out = [""] * len(texts)
    for k, row in enumerate(order.tolist()):
        out[row] = f"{level[k]:02d}:{body[ends[k] : ends[k + 1]].hex()}"
    return out


def _parsed(fingerprint: str) -> tuple[int, np.ndarray]:
    head, _, body = fingerprint.partition(":")
    return int(head), np.frombuffer(bytes.fromhex(body), np.uint8)


_steps_of: dict[int, np.ndarray] = {}


def _steps(level: int, count: int) -> np.ndarray:
    """The levels of the first `count` steps kept at a level."""
    known = _steps_of.get(level)
    if known is None or len(known) < count:
        found, start = [], 0
        total, block = 0, max(4096, 2 * KEPT << level)
        while total < max(count, 2 * KEPT):
            zeros = _zeros(np.arange(start, start + block))
            found.append(zeros[zeros >= level])
            total, start = total + len(found[-1]), start + block
        known = _steps_of[level] = np.concatenate(found)
    return known[:count]


def likeness(one: str, other: str) -> float:
    """The share of equal places, 0 to 1, on the steps that both have kept; two empty texts are alike."""
    if one == other:
        return 1.0
    (a, x), (b, y) = _parsed(one), _parsed(other)
    if a < b:
        x = x[_steps(a, len(x)) >= b]
    elif b < a:
        y = y[_steps(b, len(y)) >= a]
    longer, both = max(len(x), len(y)), min(len(x), len(y))
    return float((x[:both] == y[:both]).sum() / longer) if longer else 0.0


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint per row, from the whole text.

    Cases: a null text counts as empty and gets the fingerprint `00:`; equal texts have equal
    fingerprints; texts may be of any length; repeated rows are each answered. Other columns are
    not looked at.
    """

    def run(batches):
        for batch in batches:
            for low, part in _parts(batch, 1):
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(fingerprint_texts(texts), pa.string())],
                    names=["doc_id", "n_chars", "fingerprint"],
                )

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, "doc_id bigint, n_chars bigint, fingerprint string")


def _parts(batch: pa.RecordBatch, column: int, rows: int = 4_000) -> Iterator[tuple[int, pa.RecordBatch]]:
    for low in range(0, len(batch), rows):
        yield low, batch.slice(low, rows)


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document, its text with the last quarter replaced by the next document's start, and likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The
    order is that of doc_id, equal ones by text, null ones last, and the first follows the last.
    Documents are dealt into ranges of doc_id; a copy of each range's first document goes along
    with the range before, so each text is moved once and no task sees more than a range.
    """
    given = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    spark = docs.sparkSession
    ranges = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = given.filter("doc is not null").approxQuantile("doc", [k / ranges for k in range(1, ranges)], 0.2 / ranges)
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="as_double", outputCol="range", handleInvalid="keep").transform(
        given.withColumn("as_double", F.coalesce(F.col("doc").cast("double"), F.lit(float("nan"))))
    )
    dealt = dealt.select(F.col("range").cast("int").alias("range"), "doc", "text")
    heads = sorted(
        (r["range"], r["head"]) for r in dealt.groupBy("range").agg(F.min("doc").alias("head")).collect()
    )
    # Where the first document of each range is copied to: the filled range before, in a circle.
    # A row per range; a join, since an expression with a branch per range outgrows the parser's stack.
    targets = F.broadcast(
        spark.createDataFrame([(head, heads[k - 1][0]) for k, (_, head) in enumerate(heads)], "head bigint, target int")
    )
    copies = dealt.join(targets, F.col("doc").eqNullSafe(F.col("head"))).select(
        F.col("target").alias("range"), F.lit(1).alias("copy"), "doc", "text"
    )
    rows = dealt.select("range", F.lit(0).alias("copy"), "doc", "text").union(copies)
    rows = rows.repartition(ranges, "range").sortWithinPartitions("range", "copy", F.col("doc").asc_nulls_last(), "text")

    def run(batches):
        held = None
        for batch in batches:
            for _, part in _parts(batch, 3, 4_000):
                listed = list(zip(*(part.column(k).to_pylist() for k in range(4)), strict=True))
                if held is not None:
                    listed.insert(0, held)
                yield _answers(listed)
                held = listed[-1]

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_batches(rows, run, schema)


def _answers(rows: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch:
    """For each document that another row of its range follows."""
    texts = [r[3] for r in rows]
    pairs = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
    edited = []
    for k in pairs:
        cut = len(texts[k]) // 4
        edited.append(texts[k][: len(texts[k]) - cut] + texts[k + 1][:cut])
    found = fingerprint_texts(texts + edited)
    own, changed = found[: len(texts)], found[len(texts) :]
    columns = [
        pa.array([rows[k][2] for k in pairs], pa.int64()),
        pa.array([len(texts[k]) for k in pairs], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
        pa.array([own[k] for k in pairs], pa.string()),
        pa.array(changed, pa.string()),
        pa.array([likeness(own[k], c) for k, c in zip(pairs, changed, strict=True)], pa.float64()),
        pa.array([likeness(own[k], own[k + 1]) for k in pairs], pa.float64()),
    ]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def edit_distance_within(one: str, other: str, most: int) -> bool:
    """Whether the edit distance of two texts is at most `most`, looking at a band of that width."""
    if abs(len(one) - len(other)) > most:
        return False
    x = np.frombuffer(one.encode("utf-32-le", "surrogatepass"), "<u4")
    y = np.frombuffer(other.encode("utf-32-le", "surrogatepass"), "<u4")
    far = most + 1
    # cost[k] stands for the cell (i, i + k - most).
    shift = np.arange(-most, most + 1)
    cost = np.where(shift >= 0, shift, far)
    step = np.arange(len(shift))
    for i in range(1, len(x) + 1):
        j = i + shift
        valid = (j >= 1) & (j <= len(y))
        differ = np.ones(len(shift), np.int64)
        differ[valid] = y[j[valid] - 1] != x[i - 1]
        new = np.minimum(cost + differ, np.append(cost[1:], far) + 1)
        new[j == 0] = i
        new[(j < 0) | (j > len(y))] = far
        cost = np.minimum(np.minimum.accumulate(new - step) + step, far)
        cost[(j < 0) | (j > len(y))] = far
        if cost.min() > most:
            return False
    end = len(y) - len(x) + most
    return bool(cost[end] <= most)


def _chunk_size(chars: int, percent: int) -> int:
    """The largest size of chunks, up to five characters, that makes more of them than edits are allowed."""
    return min(5, chars // (percent * chars // 100 + 1))


def _chunks_and_runs(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(item, id, place) of the chunks each text is cut into and of all its runs of such sizes."""
    sizes = sorted({_chunk_size(n, percent) for n in range(1, 2_000) if percent * n >= 100})
    times = odd_numbers(5, 32)

    def items(chunked: bool):
        def run(batches):
            for batch in batches:
                for _, part in _parts(batch, 1, 200):
                    out = []
                    for one, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        chars = mix(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(3))
                        own = _chunk_size(len(chars), percent) if percent * len(chars) >= 100 else None
                        for size in [own] * (own is not None) if chunked else sizes:
                            n = max(0, len(chars) - size + 1)
                            runs = sum((chars[k : k + n] * times[k] for k in range(size)), np.full(n, size, np.uint64))
                            place = np.arange(0, n, size if chunked else 1)
                            out.append((mix(runs[place]).view(np.int64), np.full(len(place), one), place))
                    columns = zip(*out, strict=True) if out else ([np.zeros(0, np.int64)],) * 3
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names=["item", "id", "place"]
                    )

        return map_batches(texts.select("id", "text"), run, "item bigint, id bigint, place bigint")

    return items(True), items(False)


def _rest(cuts: Cuts, texts: DataFrame, open_ids: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of ids (id, root) with different roots that may be within `percent` percent.

    The longer text of a pair is cut into more chunks than edits are allowed. Of any as many chunks
    as edits and one more, one stands in the shorter text as it was, shifted by no more places than
    edits; the rarest are looked up.
    """
    texts = texts.join(open_ids.select("id"), "id")
    chunks, runs = (cuts.cut(t) for t in _chunks_and_runs(texts, percent))
    held = runs.groupBy("item").agg(F.count("*").alias("times"))
    sized = cuts.cut(texts.select("id", F.length("text").alias("n")).join(open_ids, "id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("times", "item", "place"))
    rare = chunks.join(held, "item").withColumn("rank", rank).drop("times").join(sized, "id")
    most = F.floor(F.col("n_a") * percent / 100)
    x = rare.select("item", "rank", *[F.col(c).alias(f"{c}_a") for c in ("id", "place", "n", "root")])
    x = x.filter(F.col("rank") <= most + 1)
    y = runs.join(sized, "id").select("item", *[F.col(c).alias(f"{c}_b") for c in ("id", "place", "n", "root")])
    lengths = (F.col("n_b") <= F.col("n_a")) & (F.col("n_a") - F.col("n_b") <= most)
    shift = F.abs(F.col("place_a") - F.col("place_b")) <= most
    found = x.join(y, "item").filter((F.col("root_a") != F.col("root_b")) & lengths & shift)
    return found.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()


def edit_groups(
    docs: DataFrame, *, percent: int = 10, bands: int = 24, sampled: int = 4,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, component_id: texts linked by an edit distance within `percent` percent of the longer.

    Equal texts are one. Fingerprints are banded by sampled places at their own level and the next,
    each text is held against the smallest document in its band, and the edit distance of the
    whole texts decides; component_id is the smallest doc_id reachable. Bands that then still hold
    several components are settled by an exact join of their members, and so are all texts that may
    be too short for some band. The bands find a pair of longer texts only with some probability,
    which falls as the edits grow; no link within a band is lost. `percent` is less than 100. Null
    and empty texts are linked with nothing.
    """
    cuts = Cuts(docs.sparkSession)
    marked = fingerprints(docs, id_col=id_col, text_col=text_col)
    digests = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.sha2(F.encode(F.col(text_col), "utf-8"), 256).alias("node"))
    signed = cuts.cut(marked.join(digests.distinct(), "doc_id").filter("n_chars > 0"))
    reps = signed.groupBy("node").agg(F.min("doc_id").alias("id"), F.min("fingerprint").alias("fingerprint"))
    reps = cuts.cut(reps.filter("id is not null"))

    def band(batches):
        random = np.random.default_rng(13)
        drawn = np.sort(random.random((bands, sampled)), 1)
        for batch in batches:
            ids, keys = [], []
            for one, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                level, symbols = _parsed(text)
                zeros = _steps(level, len(symbols))
                for at in (level, level + 1):
                    used = symbols[zeros >= at]
                    # Places are fixed, early ones more often, so that texts of other length share them.
                    places = (drawn**2 * KEPT / 2).astype(int)
                    for k, row in enumerate(places):
                        if row[-1] < len(used):
                            ids.append(one)
                            keys.append(f"{at}:{k}:{used[row].tobytes().hex()}")
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.string())], names=["id", "key"])

    filed = cuts.cut(map_batches(reps.select("id", "fingerprint"), band, "id bigint, key string"))
    heads = filed.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    pairs = filed.join(heads, "key").filter("id != first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    pairs = cuts.cut(pairs.distinct())
    # Texts with fewer steps than the last place of a band, and those that may be near to one.
    few = KEPT // 4 * 100 // (100 - percent) + 1
    short = signed.filter(F.col("n_chars") <= few).select(F.col("doc_id").alias("id")).join(reps.select("id"), "id")
    short = cuts.cut(short.distinct())
    ids = cuts.cut(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).union(short).distinct())
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).join(by_size(ids), "id")
    texts = cuts.cut(texts.groupBy("id").agg(F.min("text").alias("text")))

    def verify(batches):
        for batch in batches:
            keep = [
                edit_distance_within(x, y, max(len(x), len(y)) * percent // 100)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    def confirmed(pairs):
        for side in ("a", "b"):
            pairs = pairs.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}")), side)
        return cuts.cut(map_batches(pairs.select("a", "b", "text_a", "text_b"), verify, "a bigint, b bigint"))

    links = confirmed(pairs)
    roots = components(cuts, links)
    # The first of a band has been held against all others, so only those are left.
    placed = filed.join(heads, "key").filter("id != first").join(roots, "id", "left")
    placed = placed.select("key", "id", F.coalesce("root", "id").alias("root"))
    spread = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = placed.join(spread.filter("low != high").select("key"), "key").select("id", "root")
    apart = short.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    open_ids = cuts.cut(mixed.union(apart).distinct())
    late = confirmed(cuts.cut(_rest(cuts, texts, open_ids, percent)))
    if not cuts.empty(late):
        roots = components(cuts, links.union(late))
    named = reps.select("node", "id").join(roots, "id", "left").select("node", F.coalesce("root", "id").alias("component_id"))
    found = signed.select("doc_id", "node").join(named, "node", "left")
    alone = marked.filter("n_chars = 0").select("doc_id", F.col("doc_id").alias("component_id"))
    return found.select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id")).union(alone)
