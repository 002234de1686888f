import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from texts import awkward, documents, prose

from orderflow.llm.hard_negatives import mine, mine_sorted, pack, unpack, window
from orderflow.llm.lexical_search import search
from orderflow.llm.substring_dedup import without_passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_passages(rows, width):
    first, out = {}, []
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1):
            if i is not None:
                s = tuple(w[k : k + width])
                first[s] = min(i, first.get(s, i))
    for i, w in split:
        off = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                off[k : k + width] = [True] * width
        out.append((i, len(w), sum(off), " ".join(a for a, x in zip(w, off) if not x)))
    return sorted(out, key=str)


def test_passages_against_brute_force(spark, monkeypatch):
    source = random.Random(4)
    shared = [prose(900 + k, n) for k, n in enumerate((12, 13, 14, 30, 70, 150))]
    rows = []
    for k in range(150):
        text = prose(k, source.randint(0, 60)).split()
        for passage in source.sample(shared, source.randint(0, 3)):
            at, cut = source.randint(0, len(text)), source.randint(0, 3)
            text[at:at] = passage.split()[cut:]
        rows.append((source.randrange(120), "\n ".join(text)))
    rows += [(200, "la " * 400), (201, "la " * 150 + "x " + "la " * 90), (202, "la " * 13), (5, None), (7, "a b c")]
    rows += [(None, shared[4]), (0, shared[5]), (0, shared[5])]
    for size in (1 << 10, 1 << 13, 4 << 20):  # many blocks and buckets, or one
        monkeypatch.setattr("orderflow.llm.substring_dedup.BLOCK_BYTES", size)
        monkeypatch.setattr("orderflow.llm.substring_dedup.BUCKET_BYTES", size)
        found = without_passages(documents(spark, rows)).collect()
        got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found), key=str)
        assert got == brute_passages(rows, 13)
    for r in found:
        assert sum(s["high"] - s["low"] for s in r["removed"]) == r["n_removed"]


def test_passages_narrow_windows(spark):
    rows = [(k, prose(k % 7, 9) + " " + prose(k, 3)) for k in range(30)]
    found = without_passages(documents(spark, rows), width=3).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found), key=str) == brute_passages(rows, 3)


def test_passages_awkward(spark):
    found = without_passages(documents(spark, awkward())).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found), key=str)
    assert got == brute_passages(awkward(), 13)
    assert without_passages(documents(spark, [])).count() == 0


def brute_search(rows, items, k=10):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]

    bags = [(i, Counter(terms(t))) for i, t in rows]
    bags = [(i, c) for i, c in bags if c]
    n, total = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        ranked = []
        for i, c in bags:
            m = 25 + (75 * sum(c.values()) * n) // total
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                ranked.append((-score, i is None, i if i is not None else 0, i))
        ranked.sort(key=lambda x: x[:3])
        out += [(item, at, x[3], -x[0]) for at, x in enumerate(ranked[:k], 1)]
    return sorted(out, key=str)


def test_search_against_brute_force(spark, monkeypatch):
    source = random.Random(5)
    texts = [prose(source.randrange(40), source.randint(1, 30)).upper() for _ in range(120)]
    texts += ["Ba-ce di", "ba CE, di!", "di ce ba"] * 9  # one class of 27
    rows = [(source.randrange(500), t) for t in texts] + [*awkward(), (None, "ba ce di")]
    items = [(k, prose(k, 12)) for k in range(30)] + [(30, "ba ce di di"), (31, None), (32, ""), (33, "zzz"), (30, "é word")]
    table = spark.createDataFrame([(i, t, "x", 2) for i, t in items], "item_id int, text string, score string, doc_id int")
    docs = documents(spark, rows)
    want = brute_search(rows, items)

    def got():
        found = search(docs, table).collect()
        return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in found), key=str)

    assert got() == want
    monkeypatch.setattr("orderflow.llm.lexical_search.PASS_ITEMS", 9)  # several passes, blocks, and no broadcast
    monkeypatch.setattr("orderflow.llm.lexical_search.BLOCK", 4)
    monkeypatch.setattr("orderflow.llm.lexical_search.ENTRIES", 50)
    monkeypatch.setattr("orderflow.llm.lexical_search.SENT_BYTES", 0)
    assert got() == want


def test_search_empty(spark):
    table = spark.createDataFrame([(1, "word")], "item_id int, text string")
    assert search(documents(spark, []), table).count() == 0
    assert search(documents(spark, [(1, "a word")]), table.limit(0)).count() == 0
    assert search(documents(spark, [(1, None), (2, "--")]), table).count() == 0


def brute_mine(rows, every=100, positives=5, negatives=10):
    out = []
    for a, la, va in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            inside = [(t, i) for t, i, label in scored if label != la and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, p, at, i, -s, -t) for at, (t, i) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, label, "x", 3) for i, label, v in rows], "vec_id bigint, embedding array<float>, label int, score string, id int"
    )


def test_negatives_against_brute_force(spark, monkeypatch):
    source = random.Random(6)
    rows = [(k, source.randrange(4), [source.randint(-3, 6) / 4 for _ in range(6)]) for k in range(900)]
    rows += [(1000 + k, k % 3, rows[100][2]) for k in range(120)]  # one common vector
    rows += [(2000 + k, k % 4, [0.0] * 6) for k in range(30)]  # scores of 0
    rows += [(-100, 1, [1.0] * 6), (-7, 1, [0.5, 0.25, 1.0, -1.0, 0.0, 0.0]), (3000, 9, [1.0] * 6)]
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]
    want = brute_mine(whole)
    table = vectors(spark, rows).repartition(5)
    assert sorted(tuple(r) for r in mine(table).collect()) == want
    monkeypatch.setattr("orderflow.llm.hard_negatives.ANCHORS", 4)
    monkeypatch.setattr("orderflow.llm.hard_negatives.ROWS", 37)
    assert sorted(tuple(r) for r in mine(table).collect()) == want


def test_negatives_awkward(spark):
    good = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 0.5]), (3, 2, [0.25, 0.5, 7.0])]
    bad = [(None, 1, [1.0]), (100, None, [1.0]), (200, 1, None), (300, 1, [1.0, None]), (400, 1, [math.nan]),
           (500, 1, [math.inf, 0.0]), (600, 2, []), (700, 3, [3e30])]
    got = sorted(tuple(r) for r in mine(vectors(spark, good + bad + good)).collect())
    whole = [(i, label, [math.floor(256 * x) for x in v] + [0] * (3 - len(v))) for i, label, v in [*good, (600, 2, [])]]
    assert got == brute_mine(whole)
    assert mine(vectors(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-2, 2), st.integers(-40, 90), st.booleans()), max_size=60))
def test_sorted_keys_against_brute_force(parts):
    keys = sorted({pack(a, s, other, row) for row, (a, s, other) in enumerate(parts)})
    assert [unpack(k) for k in keys] == sorted(
        ((a, s, other, row) for row, (a, s, other) in enumerate(parts)), key=lambda x: (x[0], -x[1], x[2], x[3])
    )
    want = []
    for anchor in {p[0] for p in parts}:
        rows = sorted((-s, row, other) for row, (a, s, other) in enumerate(parts) if a == anchor)
        for s, p, _ in [x for x in rows if not x[2]][:3]:
            least, largest = window(-s, 30, 90)
            inside = [(row, -t) for t, row, other in rows if other and least <= -t <= largest]
            want += [(anchor, p, at, row, -s, t) for at, (row, t) in enumerate(inside[:4], 1)]
    assert sorted(mine_sorted(iter(keys), 4, 3, 30, 90)) == sorted(want)
