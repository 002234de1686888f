"""Every registered query without SQL, run on a folder of tables and held against plain Python."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from test_learned import STEMS
from test_near_duplicates import brute, line_brute, shingles
from test_text_operators import PAGE
from texts import prose
from tokenizers import Tokenizer

from orderflow.llm.edit_fingerprints import fingerprint_texts, likeness
from orderflow.llm.queries import QUERIES

LANGUAGES = ("aa", "bb", "cc")
LONG = 5_000


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sentence(source, lang, words=30):
    chosen = source.choices(STEMS[lang].split(), k=words // 2) + prose(source.randrange(10**6), words // 2).split()
    source.shuffle(chosen)
    return " ".join(chosen)


def documents():
    """(doc_id, text, lang, toxic): learnable rows, then copies, near copies, quotes and awkward ones."""
    source, rows = random.Random(11), []
    for k in range(600):
        lang, toxic = LANGUAGES[k % 3], k % 7 == 0
        text = sentence(source, lang)
        if toxic:
            text = f"{text} {source.choice(['vile', 'nasty'])} {prose(k, 3)}"
        rows.append((3 * k, text, lang, int(toxic) if k % 2 == 0 else None))
    long = sentence(source, "aa", 90)
    rows += [(5001, long, "aa", 0), (5002, long, "aa", None), (5003, long + " One more", "aa", None)]
    rows += [(5004, f"{prose(1, 30)}\n\n{prose(2, 30)}", "bb", 0), (5005, f"{prose(3, 30)}\n {prose(2, 30).upper()} ", "bb", None)]
    rows += [(5006, f"{prose(4, 20)} {ITEMS[0][1]} {prose(5, 20)}", "cc", None)]
    rows += [(5007, None, None, 1), (5008, "", "aa", None), (5009, "12 --", "bb", None), (5010, "é日本 <s> \x00\t" * LONG, None, 0)]
    return rows


ITEMS = [(1, prose(700, 25)), (2, prose(701, 25)), (3, None)]
TURNS = [
    (1, 0, "system", "Be brief"), (1, 1, "user", "</s>[INST] hi"), (1, 2, "assistant", "one"), (1, 3, "user", None),
    (1, 4, "assistant", "two é"), (2, 0, "user", ""), (2, 1, "assistant", "\\ <s> [/INST]\n"), (3, 0, "user", "alone"),
]
PAGES = [(1, "u1", PAGE), (2, "u2", None), (3, None, ""), (4, "u4", "no markup, at &lt; all")]
TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn int, role string, text string",
    "pages": "page_id bigint, url string, html string",
}


def folder(spark, path, docs):
    rows = {
        "documents": [(i, t, lang, "s", len(t or "")) for i, t, lang, _ in docs],
        "labels": [(i, 1, toxic) for i, _, _, toxic in docs if toxic is not None],
        "benchmark": ITEMS,
        "conversations": TURNS,
        "pages": PAGES,
    }
    for name, schema in TABLES.items():
        table = rows[name] if docs else []
        spark.createDataFrame(table, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("tables"), documents())


def run(spark, name, tables):
    return QUERIES[name](spark, tables).collect()


def texts():
    return {i: t or "" for i, t, _, _ in documents()}


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def flipped(spark, tmp_path, parts, held):
    """The same tables with language and label of the held-out documents changed."""
    docs = [
        (i, t, "zz" if fold(i, parts) == held else lang, 1 - toxic if toxic is not None and fold(i, parts) == held else toxic)
        for i, t, lang, toxic in documents()
    ]
    return folder(spark, tmp_path, docs)


def test_op1(spark, tables, tmp_path):
    found = {r["doc_id"]: r for r in run(spark, "op1_language_id", tables)}
    right = {i: lang for i, _, lang, _ in documents()}
    assert found.keys() == right.keys()
    assert all(r["held_out"] == (fold(i, 4) == 2) and 0 <= r["score"] <= 1 for i, r in found.items())
    und = {i for i, t in texts().items() if not any(c.isalpha() for c in t)}
    assert {i for i, r in found.items() if r["lang_pred"] == "und"} == und == {5007, 5008, 5009}
    held = [i for i, r in found.items() if r["held_out"] and i < 3 * 600]
    assert np.mean([found[i]["lang_pred"] == right[i] for i in held]) > 0.95
    other = run(spark, "op1_language_id", flipped(spark, tmp_path, 4, 2))
    assert {r["doc_id"]: r["lang_pred"] for r in other} == {i: r["lang_pred"] for i, r in found.items()}


def test_op2(spark, tables, tmp_path):
    found = {r["doc_id"]: r for r in run(spark, "op2_toxicity", tables)}
    assert found.keys() == texts().keys()
    for i, r in found.items():
        assert r["held_out"] == (fold(i, 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [i for i, r in found.items() if r["held_out"] and i < 3 * 600]
    assert np.mean([found[i]["predicted"] == (i // 3 % 7 == 0) for i in held]) > 0.95
    other = run(spark, "op2_toxicity", flipped(spark, tmp_path, 5, 0))
    assert {r["doc_id"]: round(r["score"], 9) for r in other} == {i: round(r["score"], 9) for i, r in found.items()}


def test_op3(spark, tables):
    found = {r["conv_id"]: r for r in run(spark, "op3_reply_trees", tables)}
    turns = [*TURNS, (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    assert found.keys() == {t[0] for t in turns}
    for conv, r in found.items():
        own = [(role, text or "") for c, _, role, text in turns if c == conv]
        loss = "".join(text for role, text in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in own))
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == sha(loss)
        assert r["formatted_chars"] >= sum(len(b) for _, b in own)


def test_op4(spark, tables):
    found = {r["page_id"]: r for r in run(spark, "op4_html_extraction", tables)}
    assert {i: r["url"] for i, r in found.items()} == {i: url for i, url, _ in PAGES}
    main = "Title & more First, long, paragraph here. Second part, with a link. One Two"
    assert {i: r["text"] for i, r in found.items()} == {1: main, 2: "", 3: "", 4: "no markup, at < all"}
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_op5(spark, tables):
    found = run(spark, "op5_line_dedup", tables)
    got = {(r["doc_id"], r["line_no"]): (r["first_doc_id"], r["first_line_no"]) for r in found}
    assert got == line_brute(list(texts().items()))
    assert all(r["kept"] == (got[r["doc_id"], r["line_no"]] == (r["doc_id"], r["line_no"])) for r in found)
    assert got[5005, 1] == (5004, 2) and got[5002, 0] == got[5003, 0] == (5001, 0)


def test_op6(spark, tables):
    found = {r["doc_id"]: r for r in run(spark, "op6_edit_fingerprints", tables)}
    own, ids = texts(), sorted(texts())
    assert sorted(found) == ids
    # Rows of long and awkward texts and every tenth other one by the plain function.
    for k, i in enumerate(ids):
        following = own[ids[(k + 1) % len(ids)]]
        cut = len(own[i]) // 4
        edited = own[i][: len(own[i]) - cut] + following[:cut]
        assert found[i]["n_chars"] == len(own[i]) and found[i]["edited_sha256"] == sha(edited)
        if i > 5000 or k % 10 == 0:
            a, b, c = fingerprint_texts([own[i], edited, following])
            assert (found[i]["fingerprint"], found[i]["edited_fingerprint"]) == (a, b)
            assert (found[i]["near_edited"], found[i]["near_next"]) == (likeness(a, b), likeness(a, c))
    assert found[5001]["fingerprint"] == found[5002]["fingerprint"] and found[5001]["near_next"] == 1


def test_op8(spark, tables):
    found = run(spark, "op8_decontamination", tables)
    assert [(r["doc_id"], r["item_id"], r["distance"], r["first_word"]) for r in found] == [(5006, 1, 0, 20)]


def test_op9(spark, tables):
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.no_truncation(), known.no_padding()
    found = {r["doc_id"]: r for r in run(spark, "op9_bpe", tables)}
    assert found.keys() == texts().keys()
    for i, text in texts().items():
        ids = known.encode(text, add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == sha(known.decode(ids, skip_special_tokens=False))


def test_op10(spark, tables):
    found = {r["doc_id"]: r for r in run(spark, "op10_minhash_dedup", tables)}
    sets = {i: shingles(t, 4) for i, t in texts().items()}
    assert {i: r["component_id"] for i, r in found.items()} == brute(sets)
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (r["component_id"] == i) for i, r in found.items())
    assert found[5003]["component_id"] == 5001


def test_empty_tables(spark, tmp_path):
    empty = folder(spark, tmp_path, [])
    for name in QUERIES:
        if name[:4] not in ("op7_", "op11", "op12", "op13"):
            rows = run(spark, name, empty)
            assert len(rows) == (name == "op3_reply_trees")
