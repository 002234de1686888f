"""Byte-pair encoding by speculation and verification, and decoding.

Each word is first cut greedily into the longest tokens. That is the exact result if and only if
every token alone and every two neighbours would come out as they are when merged by rank, so all
neighbours of all new words are looked up at once among the judged pairs; pairs not seen before
are judged by merging just the two. Only the words that fail are merged exactly, in the order of
the ranks. All three steps work on arrays of all new words together.
"""

from __future__ import annotations

import heapq
import json
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytetext import raw, repeat_index, slices
from .workers import map_batches

# Fixed value: how the byte-level scheme splits text into words before any merge (`split_words`).
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: Words whose tokens a task remembers before it starts anew (about 40 MB), and judged pairs.
REMEMBERED = 200_000
#: Bytes of text worked on together: the more, the fewer times a word is looked up.
TEXT_BYTES = 1 << 21
#: Longer words are merged with a queue.
SHORT = 64
_NONE = 1 << 62
_TOKEN = (1 << 32) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)

_LETTER, _NUMBER, _SPACE, _OTHER, _UNKNOWN = range(5)
#: What each code point is to `WORDS`, found out when it is first met.
_kinds = np.full(0x110000, _UNKNOWN, np.uint8)
_ONE_MORE = np.frombuffer(b"stmd", np.uint8)
_TWO_MORE = ("re", "ve", "ll")


def _kinds_of(points: np.ndarray) -> np.ndarray:
    kinds = _kinds[points]
    if (kinds == _UNKNOWN).any():
        for point in np.unique(points[kinds == _UNKNOWN]).tolist():
            found = regex.match(r"(\p{L})|(\p{N})|(\s)|", chr(point)).lastindex
            _kinds[point] = found - 1 if found else _OTHER
        kinds = _kinds[points]
    return kinds


def split_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the words of a slice of texts start, as `WORDS` finds them in each text; `at` are the texts' offsets."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    heads, points, edges = None, data, at
    if data.max() > 127:
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        n, edges = len(points), np.searchsorted(heads, at)
    kinds = _kinds_of(points)
    edge = np.zeros(n + 3, bool)
    edge[edges] = True
    edge[n:] = True
    start = edge.copy()
    start[1:n] |= kinds[1:] != kinds[:-1]
    # The last blank before other characters is a word of its own, or goes with them if it is a space.
    after = np.flatnonzero((kinds[:-1] == _SPACE) & (kinds[1:] != _SPACE) & ~edge[1:n]) + 1
    start[after - 1] = True
    start[after] = points[after - 1] != 32
    # An apostrophe that begins a word takes the letters of a contraction, and no more of them.
    mark = np.flatnonzero((points == 39) & start[:n])
    if len(mark):
        one, two = (np.append(points, (0, 0))[mark + k] for k in (1, 2))
        inside = ~edge[mark + 1]
        short = inside & np.isin(one, _ONE_MORE)
        long = np.zeros(len(mark), bool)
        for x, y in _TWO_MORE:
            long |= (one == ord(x)) & (two == ord(y))
        long &= inside & ~edge[mark + 2]
        start[mark[short | long] + 1] = False
        start[mark[short] + 2] = True
        start[mark[long] + 3] = True
    found = np.flatnonzero(start[:n])
    return found if heads is None else heads[found]


class _Lookup:
    """Whole numbers by distinct keys from 0 on, for many keys at a time: open addressing in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]
            mine = self.keys[place] == keys
            self.values[place[mine]] = values[mine]
            keys, values, place = keys[~mine], values[~mine], place[~mine] + 1 & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _ODD >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray, none: int) -> np.ndarray:
        place = self._place(keys)
        held = self.keys[place]
        out = np.where(held == keys, self.values[place], none)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            place[left] = place[left] + 1 & self.mask
            held = self.keys[place[left]]
            found = held == keys[left]
            out[left[found]] = self.values[place[left[found]]]
            left = left[~found & (held >= 0)]
        return out


def byte_letters() -> dict[str, int]:
    """Which letter of a vocabulary file stands for which byte.

    Printable bytes of Latin-1 stand for themselves, the others for code points from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *added.values()], default=-1) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in ids.items():
            if token not in added:
                self.bytes_of[number] = bytes(letters[c] for c in token)
        for token, number in added.items():
            self.bytes_of[number] = token.encode()
        self.special = added
        self.split = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
            if added
            else None
        )
        self.id_of = {self.bytes_of[n]: n for t, n in ids.items() if t not in added}
        self.of_byte = np.array([self.id_of[bytes([b])] for b in range(256)])
        #: Both tokens in one number to the rank and the new token in one number.
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left] << 32 | ids[right]] = rank << 32 | ids[left + right]
        self.rules = _Lookup(*(np.fromiter(x, np.int64, len(self.merges)) for x in (self.merges, self.merges.values())))
        self._plant()
        self.texts = pa.array(self.bytes_of, pa.binary())
        self.forget()

    def _plant(self) -> None:
        """The tokens as a tree by their bytes; node b + 1 is byte b, and a token lies at its node or -1."""
        below: dict[int, int] = {b: b + 1 for b in range(256)}
        token_at = {0: -1}
        for token, number in self.id_of.items():
            node = 0
            for byte in token:
                node = below.setdefault(node << 8 | byte, len(below) + 1)
            token_at[node] = number
        self.below = _Lookup(*(np.fromiter(x, np.int64, len(below)) for x in (below, below.values())))
        self.token_at = np.full(len(below) + 1, -1)
        self.token_at[list(token_at)] = list(token_at.values())

    def merged(self, body: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The exact results for the words at `at`: merge the pair of least rank, the leftmost first, until none is left.

        Each round does the next merge of every word that still has one. Gives all tokens and how many a word has.
        """
        size = np.diff(at)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in np.flatnonzero(size > SHORT).tolist():
            ids = np.array(self._merged_long(self.of_byte[body[at[k] : at[k + 1]]].tolist()))
            parts.append((np.array([k]), np.array([len(ids)]), ids))
        which = np.flatnonzero((size > 0) & (size <= SHORT))
        count = size[which]
        ids = self.of_byte[body[np.repeat(at[which], count) + repeat_index(count)]]
        start = np.cumsum(count) - count
        codes = np.full(len(ids), _NONE)
        inner = np.ones(len(ids), bool)
        inner[start + count - 1] = False
        inner = np.flatnonzero(inner)
        codes[inner] = self._rule(ids, inner)
        while len(which):
            best = np.minimum.reduceat(codes, start)
            done = best == _NONE
            if done.any():
                over = np.repeat(done, count)
                parts.append((which[done], count[done], ids[over]))
                ids, codes, which, count, best = ids[~over], codes[~over], which[~done], count[~done], best[~done]
                if not len(which):
                    break
                start = np.cumsum(count) - count
            hits = np.flatnonzero(codes == np.repeat(best, count))
            first = hits[np.searchsorted(hits, start)]
            ids[first] = best & _TOKEN
            stay = np.ones(len(ids), bool)
            stay[first + 1] = False
            ids, codes = ids[stay], codes[stay]
            gone = np.arange(len(first))
            first, start, count = first - gone, start - gone, count - 1
            codes[first] = _NONE
            for pairs in (first[first < start + count - 1], first[first > start] - 1):
                codes[pairs] = self._rule(ids, pairs)
        number = np.zeros(len(size), np.int64)
        for which, count, _ in parts:
            number[which] = count
        start, flat = np.cumsum(number) - number, np.zeros(int(number.sum()), np.int64)
        for which, count, ids in parts:
            flat[np.repeat(start[which], count) + repeat_index(count)] = ids
        return flat, number

    def _rule(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank and new token of each token at `at` with the one after it."""
        return self.rules.get(ids[at] << 32 | ids[at + 1], _NONE)

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a queue, for words in which looking for the least rank would be slow."""
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            rule = self.merges.get(ids[k] << 32 | ids[after[k]])
            if rule is not None:
                heapq.heappush(queue, (rule, k, ids[k], ids[after[k]]))

        for k in range(size - 1):
            offer(k)
        while queue:
            rule, k, left, right = heapq.heappop(queue)
            nxt = after[k]
            if ids[k] != left or nxt >= size or ids[nxt] != right:
                continue
            ids[k], ids[nxt] = rule & _TOKEN, -1
            after[k] = after[nxt]
            if after[k] < size:
                before[after[k]] = k
                offer(k)
            if before[k] >= 0:
                offer(before[k])
        return [x for x in ids if x >= 0]

    def longest_match(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words that lie at `at` in `data`, each the longest that fits, and how many a word has."""
        ends = np.repeat(at[1:], np.diff(at))
        places, node, depth = np.arange(len(data)), data.astype(np.int64) + 1, 1
        token, size = self.of_byte[data], np.ones(len(data), np.int64)
        while len(places):
            inside = places + depth < ends[places]
            places, node = places[inside], node[inside]
            node = self.below.get(node << 8 | data[places + depth], -1)
            places, node = places[node >= 0], node[node >= 0]
            depth += 1
            here = self.token_at[node]
            longer = here >= 0
            token[places[longer]], size[places[longer]] = here[longer], depth
        begins = np.zeros(len(data), bool)
        now, end = at[:-1], at[1:]
        while len(now):
            begins[now] = True
            now = now + size[now]
            now, end = now[now < end], end[now < end]
        return token[begins], np.add.reduceat(begins, at[:-1], dtype=np.int64)

    def _stands(self, pairs: np.ndarray) -> np.ndarray:
        """Whether each coded pair, or token alone coded with no right one, is what merging gives."""
        asked, where = np.unique(pairs, return_inverse=True)
        new = asked[~_held(asked, self.judged)]
        if len(new):
            tokens = np.stack([new >> 32, (new & _TOKEN) - 1], 1).reshape(-1)
            number = 1 + (tokens[1::2] >= 0)
            body, at = raw(self.texts.take(pa.array(tokens[tokens >= 0])))
            flat, count = self.merged(body, at[np.append(0, np.cumsum(number))])
            last = np.cumsum(count) - 1
            # With as many tokens as there were, the first and the last are all of them.
            same = (count == number) & (flat[last - count + 1] == tokens[::2])
            same &= (number == 1) | (flat[last] == tokens[1::2])
            self.judged, self.sound = np.append(self.judged, new), np.append(self.sound, same)
            order = np.argsort(self.judged, kind="stable")
            self.judged, self.sound = self.judged[order], self.sound[order]
        return self.sound[np.searchsorted(self.judged, asked)][where]

    def learn(self, words: pa.Array) -> None:
        """Find and remember the tokens of new words, all together."""
        body, at = raw(words)
        body, at = body[at[0] : at[-1]], at - at[0]
        flat, count = self.longest_match(body, at)
        last = np.cumsum(count) - 1
        follows = np.append(flat[1:], -1)
        follows[last] = -1
        # The last token of a longer word has been judged with its left neighbour.
        asked = np.ones(len(flat), bool)
        asked[last] = count == 1
        stands = np.ones(len(flat), bool)
        stands[asked] = self._stands((flat[asked] << 32) + follows[asked] + 1)
        right = np.minimum.reduceat(stands, last - count + 1)
        wrong = np.flatnonzero(~right)
        size = np.diff(at)[wrong]
        exact, number = self.merged(
            body[np.repeat(at[wrong], size) + repeat_index(size)], np.append(0, np.cumsum(size))
        )
        total = count.copy()
        total[wrong] = number
        tokens, own = np.zeros(int(total.sum()), "<u4"), np.repeat(right, total)
        tokens[own], tokens[~own] = flat[np.repeat(right, count)], exact
        ids = _joined(pa.binary(), tokens.view(np.uint8), np.append(0, 4 * np.cumsum(total)))
        self.words, self.ids = pa.concat_arrays([self.words, words]), pa.concat_arrays([self.ids, ids])

    def forget(self) -> None:
        """Drop what was learned of words and pairs."""
        self.words = self.ids = pa.array([], pa.binary())
        self._forget_pairs()

    def _forget_pairs(self) -> None:
        self.judged, self.sound = np.zeros(0, np.int64), np.zeros(0, bool)

    def _plain(self, data: np.ndarray, at: np.ndarray) -> pa.Array:
        if not len(data):
            return _joined(pa.binary(), data, at)
        begin = split_words(data, at)
        words = _joined(pa.binary(), data, np.append(begin, len(data))).dictionary_encode()
        if len(self.words) > REMEMBERED:
            self.words = self.ids = pa.array([], pa.binary())
        if len(self.judged) > REMEMBERED:
            self._forget_pairs()
        place = pc.index_in(words.dictionary, self.words)
        if place.null_count:
            known = len(self.words)
            self.learn(words.dictionary.filter(place.is_null()))
            new = place.is_null().to_numpy(zero_copy_only=False)
            place = place.fill_null(0).to_numpy().copy()
            place[new] = np.arange(known, len(self.words))
            place = pa.array(place)
        body, ends = raw(self.ids.take(place.take(words.indices)))
        return _joined(pa.binary(), body, ends[np.searchsorted(begin, at)])

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Ids of each text as little-endian unsigned 32-bit integers; a null has none."""
        data, at = raw(texts)
        data, at = data[at[0] : at[-1]], at - at[0]
        body = data.tobytes() if self.special else b""
        if not any(special.encode() in body for special in self.special):
            return self._plain(data, at)
        parts = [self.split.split(text or "") for text in texts.to_pylist()]
        plain = self._plain(*raw(pa.array([x for some in parts for x in some[::2]], pa.string()))).to_pylist()
        out, low = [], 0
        for some in parts:
            ids = [b"".join((x, y)) for x, y in zip(
                plain[low:], [*(np.uint32(self.special[s]).astype("<u4").tobytes() for s in some[1::2]), b""], strict=False
            )]
            out.append(b"".join(ids))
            low += len(some[::2])
        return pa.array(out, pa.binary())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.encode_all(pa.array(texts, pa.string())).to_pylist()

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """The texts of ids; bytes that are no UTF-8 become the replacement character."""
        body, at = raw(ids)
        tokens = np.frombuffer(body[at[0] : at[-1]].tobytes(), "<u4")
        body, ends = raw(self.texts.take(pa.array(tokens)))
        at = ends[(at - at[0]) // 4]
        texts = _joined(pa.string(), body, at)
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            data = body.tobytes()
            texts = pa.array([data[low:high].decode("utf-8", "replace") for low, high in pairwise(at.tolist())], pa.string())
        return texts

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become the replacement character."""
        return self.decode_all(pa.array([ids], pa.binary()))[0].as_py()


def _held(asked: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of `asked` are among the sorted numbers `of`."""
    place = np.searchsorted(of, asked)
    held = place < len(of)
    held[held] = of[place[held]] == asked[held]
    return held


def _joined(kind: pa.DataType, body: np.ndarray, at: np.ndarray) -> pa.Array:
    """Texts or binaries that lie one after another in `body`."""
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(body)])


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and ids, the token ids of the whole text as a binary of unsigned 32-bit integers.

    `path` is a byte-level vocabulary file found on every executor. Special tokens written in a
    text count as such, none are added. Cases: a null or empty text has no ids; texts and words
    may be of any length; repeated rows are each answered. Other columns are not looked at.
    """

    def run(batches):
        words = vocabulary(path)
        # Workers outlive their tasks; what one has remembered must not pile up beside the next.
        words.forget()
        for batch in batches:
            _, at = raw(batch.column(1))
            for low, high in slices(at, TEXT_BYTES):
                part = batch.slice(low, high - low)
                ids = words.encode_all(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])
        words.forget()

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, "doc_id bigint, ids binary")


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, text): `encode` and then `decode` of what it gives, in one worker a task instead of two.

    Cases are those of `encode`; the text is the decoded one.
    """

    def run(batches):
        words = vocabulary(path)
        words.forget()
        for batch in batches:
            _, at = raw(batch.column(1))
            for low, high in slices(at, TEXT_BYTES):
                part = batch.slice(low, high - low)
                ids = words.encode_all(part.column(1))
                texts = words.decode_all(ids)
                yield pa.RecordBatch.from_arrays([part.column(0), ids, texts], names=["doc_id", "ids", "text"])
        words.forget()

    given = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(given, run, "doc_id bigint, ids binary, text string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) with the decoded text beside; null ids decode to the empty text."""

    def run(batches):
        words = vocabulary(path)
        for batch in batches:
            given = batch.column(1).cast(pa.binary()).fill_null(b"")
            _, at = raw(given)
            for low, high in slices(at):
                part = batch.slice(low, high - low)
                texts = words.decode_all(given.slice(low, high - low))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["doc_id", "ids", "text"])

    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, ids binary, text string")
