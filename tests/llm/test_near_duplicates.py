import itertools
import random
import re

from texts import awkward, documents, prose

from orderflow.llm.line_dedup import near_lines, without_repeats
from orderflow.llm.minhash_dedup import near_duplicates, without_copies


def shingles(text, width):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute(sets, percent=80):
    root = {k: k for k in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def family(base, copies, edits, seed):
    """Copies of a text with some words replaced; with many edits they are near misses."""
    source, out = random.Random(seed), []
    for _ in range(copies):
        words = base.split()
        for _ in range(source.randint(0, edits)):
            words[source.randrange(len(words))] = prose(source.randrange(10**6), 1)
        out.append(" ".join(words))
    return out


def test_documents_against_brute_force(spark):
    texts = [prose(k, 60) for k in range(40)]
    texts += family(prose(100, 120), 30, 3, 1) + family(prose(101, 120), 40, 8, 2)
    texts += [prose(102, 60) + " " + prose(200 + k, 60) for k in range(30)]  # a shared passage
    texts += ["One two", "one  TWO", "one", "", " "]
    random.Random(3).shuffle(texts)
    found = near_duplicates(documents(spark, list(enumerate(texts))), width=4).collect()
    sets = {k: shingles(t, 4) for k, t in enumerate(texts)}
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(sets)
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) for r in found)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_documents_awkward(spark):
    docs = documents(spark, [*awkward(), (9, "null ID text")])
    found = near_duplicates(docs)
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == 9 and rows[1]["kept"] and rows[2]["n_shingles"] == 0
    assert rows[None]["component_id"] == 9 and not rows[None]["kept"] and rows[9]["kept"]
    assert without_copies(docs, found).count() == 9  # a null id is never taken for another's
    empty = near_duplicates(documents(spark, []))
    assert empty.count() == 0


def line_brute(texts, width=8):
    sets = {}
    for doc, text in texts:
        for k, line in enumerate(text.split("\n") if text else []):
            body = re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
            sets[doc, k] = frozenset(body[j : j + width] for j in range(max(1, len(body) - width + 1))) if body else frozenset()
    return brute(sets)


def test_lines_against_brute_force(spark):
    lines = [prose(k, 30) for k in range(30)]
    for k in range(12):
        lines += family(lines[k], 4, 1, k)
    lines += ["", " ", "short", "SHORT ", "é" * 9]
    random.Random(5).shuffle(lines)
    texts = [(k, "\n".join(lines[k : k + 3])) for k in range(0, len(lines), 2)]
    found = near_lines(documents(spark, texts)).collect()
    got = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in found}
    wanted = line_brute(texts)
    assert got.keys() == wanted.keys()
    assert sum(got[k] == wanted[k] for k in got) >= 0.97 * len(got)  # banding has this recall
    sets_apart = [k for k in got if got[k] != wanted[k]]
    assert all(got[k] >= wanted[k] for k in sets_apart)


def test_short_lines_of_one_band_are_not_lost(spark):
    """Pairs of 4 to 12 shingles at 0.8 or above that meet in a band, all of which have to be linked."""
    import numpy as np
    import pyarrow as pa

    from orderflow.llm import line_dedup

    source, lines = random.Random(9), []
    while len(lines) < 1200:
        line = "".join(source.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=source.randint(11, 19)))
        lines += [line, line + source.choice("!?")]
    sigs = np.concatenate([line_dedup._signatures(x) for x, _, _ in line_dedup._lines(pa.array(lines), 8)])
    bands = (sigs[::2] == sigs[1::2]).reshape(-1, 8, 4).all(2).any(1)
    sets = line_brute(list(enumerate(lines)))
    meant = [k for k in range(0, len(lines), 2) if bands[k // 2] and sets[k + 1, 0] == (k, 0)]
    found = {r["doc_id"]: r["first_doc_id"] for r in near_lines(documents(spark, list(enumerate(lines)))).collect()}
    assert len(meant) > 400 and all(found[k + 1] == k for k in meant)


def test_lines_with_one_edit_by_length(spark):
    """Edit distance 1 in the middle is tolerated from 79 characters on, with width 4 from 39 on."""
    source, lines = random.Random(11), []
    for size in [20, 38, 39, 60, 78, 79, 80] * 12:
        line = "".join(source.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        lines += [line, line[: size // 2] + "#" + line[size // 2 + 1 :]]
    docs = documents(spark, list(enumerate(lines)))
    for width, least in ((8, 79), (4, 39)):
        found = {r["doc_id"]: r["first_doc_id"] for r in near_lines(docs, width=width).collect()}
        linked = {k: found[k + 1] == k for k in range(0, len(lines), 2)}
        assert not any(linked[k] for k in linked if len(lines[k]) < least)
        able = [linked[k] for k in linked if len(lines[k]) >= least]
        assert sum(able) >= 0.85 * len(able)


def test_lines_awkward(spark):
    docs = documents(spark, [*awkward(), (7, "a\nnew line here\n"), (8, "\n a \n")])
    found = near_lines(docs)
    rows = {(r["doc_id"], r["line_no"]): r for r in found.collect()}
    assert not any(k[0] in (1, 2) for k in rows)
    assert rows[7, 0]["first_doc_id"] == 4 and not rows[7, 0]["kept"] and rows[7, 2]["kept"]
    kept = {r["doc_id"]: r["text"] for r in without_repeats(docs, found).collect()}
    assert kept[7] == "new line here\n" and 8 not in kept and kept[1] is None and kept[2] == ""
    assert near_lines(documents(spark, [])).count() == 0
