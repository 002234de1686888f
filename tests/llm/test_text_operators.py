import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import awkward, documents, prose
from tokenizers import Tokenizer

from orderflow.llm import bpe, edit_fingerprints
from orderflow.llm.bytetext import raw
from orderflow.llm.decontamination import Items, _hits, _word_hashes, find_leaks, window_distance, without_leaks
from orderflow.llm.html_extraction import Page, extract, main_text

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcdé the ing's\n\t 12½漢🙂.,!<|>", max_size=60), max_size=20))
def test_bpe_equals_the_library(texts):
    texts = [*texts, "x<|endoftext|>y", "a" * 500, " " * 200]
    words = bpe.vocabulary(PATH)
    for text, ids in zip(texts, words.encode(texts), strict=True):
        wanted = REFERENCE.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == wanted
        assert words.decode(ids) == REFERENCE.decode(wanted, skip_special_tokens=False) == text


ODD = ["'s", "'re", "'ll", "'d", "'S", " '", "''", *"strvelmd", " ", "  ", "\n", "\t", "\xa0", "\x1c", "é", "漢", "١", "Ⅷ", "5", "!", "--", "\0", "😀"]


def test_words_are_split_as_the_pattern_says():
    rng = random.Random(4)
    texts = ["", " ", "\n\n", *("".join(rng.choices(ODD, k=rng.randint(0, 12))) for _ in range(3000))]
    body, at = raw(pa.array(texts))
    wanted, place = [], 0
    for text in texts:
        for word in bpe.WORDS.findall(text):
            wanted.append(place)
            place += len(word.encode())
    assert bpe.split_words(body, at).tolist() == wanted
    words = bpe.vocabulary(PATH)
    texts = [t + s for t, s in zip(texts, [*words.special, "", "x"] * len(texts), strict=False)]
    found = words.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [REFERENCE.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(map(words.decode, found)) == texts


def test_many_new_words_are_merged_together():
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("etaoinshr", k=rng.randint(3, 14))) for _ in range(500)) for _ in range(100)]
    words = bpe.Vocabulary(PATH)
    begun = time.process_time()
    found = words.encode(texts)
    # Word by word it took about 40 microseconds for each of 50,000.
    assert time.process_time() - begun < 1
    for text, ids in zip(texts[:20], found, strict=False):
        assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode(text, add_special_tokens=False).ids


def test_bpe_table(spark):
    rows = awkward()
    coded = bpe.decode(bpe.encode(documents(spark, rows), PATH), PATH).collect()
    assert [r["text"] for r in coded] == [t or "" for _, t in rows]
    assert bpe.round_trip(documents(spark, rows), PATH).collect() == coded
    assert bpe.encode(documents(spark, []), PATH).count() == 0


def test_window_distance_is_exact():
    def slow(item, text):
        cost = [0] * (len(text) + 1)
        for k, a in enumerate(item, 1):
            new = [k]
            for j, b in enumerate(text, 1):
                new.append(min(cost[j - 1] + (a != b), cost[j] + 1, new[-1] + 1))
            cost = new
        return min(cost)

    source = random.Random(1)
    for _ in range(200):
        item = [source.randrange(4) for _ in range(source.randint(1, 9))]
        text = [source.randrange(4) for _ in range(source.randint(1, 15))]
        assert window_distance(np.array(item), np.array(text))[0] == slow(item, text)


def test_leaks_found_and_clean_documents_left(spark):
    items = [(k, prose(k, 12 + k)) for k in range(40)]
    source, docs = random.Random(2), []
    for k, text in items:
        words = text.split()
        for _ in range(len(words) // 10):
            words[source.randrange(len(words))] = "edited"
        docs.append((k, prose(900 + k, 50) + " " + " ".join(words).upper() + ". " + prose(800 + k, 50)))
    docs += [(1000 + k, prose(5000 + k, 300)) for k in range(40)]
    table = documents(spark, docs)
    benchmark = spark.createDataFrame([*items, (99, None), (98, "too short")], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(table, benchmark).collect()}
    assert sum((k, k) in found for k, _ in items) >= 38
    assert not any(d >= 1000 for d, _ in found)
    left = without_leaks(table, benchmark)
    assert left.columns == table.columns and left.filter("doc_id >= 1000").count() == 40


def test_leak_recall_against_brute_force():
    """Every item at up to its allowed distance, found by the walks or not."""
    import pyarrow as pa

    source, items = random.Random(7), [(k, prose(k, 30)) for k in range(60)]
    index, found, total = Items(items), 0, 0
    for place, (_, text) in enumerate(items):
        words = text.split()
        for _ in range(6):
            k = source.randrange(len(words))
            words[k : k + 1] = source.choice([[], ["new"], [words[k], "new"]])
        doc = prose(2000 + place, 40).split() + words + prose(3000 + place, 40).split()
        hashed, first, _ = next(_word_hashes(pa.array([" ".join(doc)])))
        near = window_distance(index.words[place], hashed)[0] <= 6
        total += near
        found += near and (0, place) in _hits(index, hashed, first, 20)
    assert found >= 0.9 * total > 40


def test_leaks_awkward(spark):
    benchmark = spark.createDataFrame([(1, "é word " * 9)], "item_id bigint, text string")
    table = documents(spark, awkward())
    assert {r["doc_id"] for r in find_leaks(table, benchmark).collect()} == {5}
    assert find_leaks(table, benchmark.filter("false")).count() == 0
    assert without_leaks(table, benchmark).count() == 7
    assert find_leaks(documents(spark, []), benchmark).count() == 0


def least_distance(item, text):
    cost = [0] * (len(text) + 1)
    for k, a in enumerate(item, 1):
        new = [k]
        for j, b in enumerate(text, 1):
            new.append(min(cost[j - 1] + (a != b), cost[j] + 1, new[-1] + 1))
        cost = new
    return min(cost)


def held_against_brute_force(items, docs, cut=str.split):
    """Number of pairs held by the module and by plain Python, which have to be the same."""
    import pyarrow as pa

    index, found = Items(list(enumerate(items))), set()
    for hashed, first, low in _word_hashes(pa.array(docs)):
        found |= {(low + row, item, d) for (row, item), (d, _) in _hits(index, hashed, first, 20).items()}
    wanted = set()
    for row, doc in enumerate(docs):
        for item, text in enumerate(items):
            distance = least_distance(cut(text), cut(doc))
            if distance <= len(cut(text)) // 5:
                wanted.add((row, item, distance))
    return found, wanted


def copies(items, source):
    """Each item word for word and with as many edits as are allowed, between other words."""
    docs = []
    for k, item in enumerate(items):
        for edits in (0, len(item.split()) // 5):
            words = item.split()
            for _ in range(edits):
                at = source.randrange(len(words))
                words[at : at + 1] = source.choice([[], [items[k - 1].split()[0]], [words[at], items[k - 1].split()[0]]])
            docs.append(" ".join([prose(9000 + k, 20), *words, prose(9500 + k, 20)]))
    return docs


def test_items_of_few_words():
    items = [prose(k, 1 + k % 7) for k in range(70)]
    docs = [*copies(items, random.Random(3)), "", items[6], items[6] + " " + items[5], *items[:7]]
    found, wanted = held_against_brute_force(items, docs)
    assert found == wanted and len(wanted) >= 140


def test_items_without_blanks():
    def cut(text):
        return re.findall(r"[a-z0-9]+|[^\x00-\x7f。]", text)

    source = random.Random(4)
    for alphabet in ("天地玄黄宇宙洪荒日月盈昃辰宿列张𠀀𠀁", "กขคงจฉชซญดตถทนบปผ", "あいうえおアイウエオかきくけこ"):
        items = ["".join(source.choices(alphabet, k=4 + k % 4)) for k in range(20)]
        docs = ["abc" + "".join(source.choices(alphabet, k=30)) + f"{t[:2]}。{t[2:]}x1 {t}" for t in items]
        found, wanted = held_against_brute_force(items, docs, cut)
        assert found == wanted and len(wanted) >= 20


def test_items_of_every_length():
    lengths = [*range(8, 16), 20, 25, 30, 45, 60]
    items = [prose(100 * n + k, n) for n in lengths for k in range(6)]
    found, wanted = held_against_brute_force(items, copies(items, random.Random(8)))
    assert found == wanted
    assert {item for _, item, d in wanted if d == 0} == set(range(len(items)))


def test_short_items_in_tables(spark):
    benchmark = spark.createDataFrame([(1, "Two words"), (2, "天地玄黄"), (3, "..."), (4, None)], "item_id bigint, text string")
    table = documents(spark, [(1, "here: two, words"), (2, "two other words"), (3, "他说天地玄黄。"), (4, "...")])
    found = {(r["doc_id"], r["item_id"], r["first_word"], r["n_words"]) for r in find_leaks(table, benchmark).collect()}
    assert found == {(1, 1, 1, 2), (3, 2, 2, 4)}
    assert {r["doc_id"] for r in without_leaks(table, benchmark).collect()} == {2, 4}


def test_fingerprints(spark):
    rows = [*awkward(), *[(100 + k, prose(k, 80)) for k in range(20)], (200, prose(3, 80))]
    found = edit_fingerprints.fingerprints(documents(spark, rows)).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] and by_id[1]["n_chars"] == 0
    assert by_id[103]["fingerprint"] == by_id[200]["fingerprint"]
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    pairs = edit_fingerprints.with_next(documents(spark, rows)).collect()
    assert len(pairs) == len(rows)
    import hashlib

    wanted = []
    for k, (i, text) in enumerate(ordered):
        after, cut = ordered[(k + 1) % len(ordered)][1], len(text) // 4
        wanted.append((i, hashlib.sha256((text[: len(text) - cut] + after[:cut]).encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["edited_sha256"]) for r in pairs), key=key) == sorted(wanted, key=key)
    assert edit_fingerprints.with_next(documents(spark, [])).count() == 0
    likely = [r for r in pairs if (r["doc_id"] or 0) >= 100]
    assert all(0.4 < r["near_edited"] <= 1 for r in likely) and np.mean([r["near_next"] for r in likely]) < 0.2


def test_likeness_falls_with_edits():
    text = prose(1, 400)
    mean = []
    for edits in (0, 5, 40, 200):
        source, chars = random.Random(edits), list(text)
        for _ in range(edits):
            chars[source.randrange(len(chars))] = "z"
        one, other = edit_fingerprints.fingerprint_texts([text, "".join(chars)])
        mean.append(edit_fingerprints.likeness(one, other))
    assert mean[0] == 1 and mean == sorted(mean, reverse=True) and mean[3] < 0.5
    longer, shorter = edit_fingerprints.fingerprint_texts([text, text[: len(text) * 2 // 3]])
    assert 0.5 < edit_fingerprints.likeness(longer, shorter) < 0.8


def test_edit_groups(spark):
    base = prose(1, 100)
    rows = [(1, base), (2, base[:200] + "x" + base[200:]), (3, base), (4, prose(2, 100)), (5, None), (6, "")]
    found = {r["doc_id"]: r["component_id"] for r in edit_fingerprints.edit_groups(documents(spark, rows)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6}
    assert edit_fingerprints.edit_distance_within("kitten", "sitting", 3)
    assert not edit_fingerprints.edit_distance_within("kitten", "sitting", 2)


def test_edit_groups_against_brute_force(spark):
    source, start = random.Random(6), prose(1, 80)[:300]

    def edited(text, edits):
        chars = list(text)
        for _ in range(edits):
            at = source.randrange(len(chars))
            chars[at : at + 1] = source.choice(["", "x", chars[at] + "y"])
        return "".join(chars)

    # Below one long beginning: a smallest text far from all others, and near copies among those.
    texts = [start + prose(2, 80)[:200]]
    for k in range(8):
        own = start + prose(10 + k, 80)[:200]
        texts += [own, start + edited(own[300:], 14), start + edited(own[300:], 14)]
    for k in range(40):  # short texts, some with an edit
        text = prose(100 + k, 20)[: 5 + k]
        texts += [text, edited(text, len(text) // 10)]
    rows = list(enumerate(texts))
    found = edit_fingerprints.edit_groups(documents(spark, rows), percent=10)
    root = {k: k for k, t in rows}
    for a, x in rows:
        for b, y in rows[:a]:
            if edit_fingerprints.edit_distance_within(x, y, max(len(x), len(y)) // 10):
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == root
    assert len(set(root.values())) < len(rows) - 30


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home, sweet, home</a></nav>
<div class="cookie-notice"><p>We use cookies, as, you, know.</p></div>
<div id="page"><h1>Title &amp; more</h1><div class="body"><p>First, long, paragraph&nbsp;here.
<p>Second <b>par</b>t, with <a href=x>a link</a>.<ul><li>One<li>Two</ul></div>
<div class="comments"><p>I, for, one, like, this, very, much, yes.</p></div></div>
<form><p>Name, address, and so on</p></form><aside>Also, read, this</aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE) == "Title & more First, long, paragraph here. Second part, with a link. One Two"
    assert main_text("no markup, at &lt; all") == "no markup, at < all"
    for broken in ("<", "<p", "<a href='x>", "<!-- open", "</p></div>", "<script>never closed", "<p>a<div>b</p>c"):
        main_text(broken)
    assert main_text("<p>" + "word, " * 50_000).count("word,") == 50_000
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


PARAGRAPHS = [f"A long, plain paragraph of words, number {i}, and then some more of them." for i in range(5)]


@pytest.mark.parametrize(
    "name", ["site has-sidebar", "content ads-enabled", "post comments-open", "social-history", "page-form", "plain"]
)
def test_wrappers_with_suspect_names(name):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    want = " ".join(PARAGRAPHS)
    assert main_text(f"<body><div class='{name}'>{body}</div></body>") == want
    assert main_text(f"<body><form id='{name}'>{body}</form></body>") == want
    aside = "<div class='sidebar'><p>Buy, buy, buy</p></div><div class='ad-slot'>Cheap, new</div>"
    comments = f"<div class='comments'>{'<p>I, for, one, agree.</p>' * 8}</div>"
    whole = f"<body><div class='{name}'>{aside}<h1>Title</h1>{body}{comments}{aside}</div></body>"
    assert main_text(whole) == f"Title {want}"


def test_suspects_beside_the_article_go():
    article = f"<article><h1>Title</h1><p>{PARAGRAPHS[0]}</p></article>"
    for name in ("comment-list", "comments", "newsletter-box", "ad"):
        long = f"<div class='{name}'>{'<p>I, for, one, like, this, very, much.</p>' * 2}</div>"
        assert main_text(f"<body>{long}{article}{long}</body>") == f"Title {PARAGRAPHS[0]}"
    thread = f"<ol class='comments'>{'<li><article><p>Me, too, and, so, on.</p></article>' * 40}</ol>"
    assert main_text(f"<body>{article}{thread}</body>") == f"Title {PARAGRAPHS[0]}"


def test_points_by_brute_force():
    rnd = random.Random(3)
    for _ in range(30):
        # A random tree of sections with paragraphs; points go up halved, worked out path by path.
        parents = [None] + [rnd.randrange(k) for k in range(1, 12)]
        held = [[f"w{'x, ' * rnd.randrange(6)}{'y' * rnd.randrange(200)}" for _ in range(rnd.randrange(3))] for _ in parents]

        def written(k):
            inner = "".join(f"<p>{' '.join(p.split())}</p>" for p in held[k])
            return f"<div>{inner}{''.join(written(c) for c in range(len(parents)) if parents[c] == k)}</div>"

        page = Page(written(0))
        divs = [one for one in page.elements if one.tag == "div"]
        order = []

        def visit(k):
            order.append(k)
            for c in range(len(parents)):
                if parents[c] == k:
                    visit(c)

        visit(0)
        want = [0.0] * len(parents)
        for k, texts in enumerate(held):
            for text in (" ".join(t.split()) for t in texts):
                up, share = k, 1.0
                while up is not None:
                    want[up] += share * (1 + text.count(",") + min(len(text) / 100, 3))
                    up, share = parents[up], share / 2
        assert [one.points for one in divs] == pytest.approx([want[k] for k in order])


def test_broken_pages_in_linear_time():
    began = time.monotonic()
    main_text("<div>x" * 100_000)
    main_text("<div>" * 50_000 + "x" + "</div>" * 50_000)
    assert main_text("<a " * 340_000) == " ".join(["<a"] * 340_000)
    assert time.monotonic() - began < 60


def test_pages_awkward(spark):
    rows = [(1, "u", None, 1), (2, None, "", 2), (None, "v", PAGE, 3), (3, "w", PAGE, 4), (3, "w", PAGE, 4)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    found = extract(table).collect()
    assert [r["text"] for r in found] == ["", "", *[main_text(PAGE)] * 3]
    assert extract(table.filter("false")).count() == 0


def test_next_documents_over_many_ranges(spark):
    docs = documents(spark, [(k, prose(k, 20)) for k in range(300)] + [(None, "no id"), (7, prose(7, 20))])
    few = sorted(tuple(r) for r in edit_fingerprints.with_next(docs).fillna(-1, ["doc_id"]).collect())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3000")
    try:
        many = edit_fingerprints.with_next(docs).fillna(-1, ["doc_id"])
        assert many.count() == len(few) == 302
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        assert sorted(tuple(r) for r in edit_fingerprints.with_next(docs).fillna(-1, ["doc_id"]).collect()) == few
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
