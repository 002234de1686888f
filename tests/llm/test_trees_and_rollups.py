import random

from orderflow.llm import reply_trees
from orderflow.llm.token_rollups import Rollup, deltas

SCHEMA = "tree_id bigint, msg_id bigint, parent_id bigint, score double, role string, text string, node int, up int"


def brute(rows, top):
    out = {}
    trees = {}
    for tree, msg, parent, score, *_ in rows:
        trees.setdefault(tree, {})[msg] = (parent, score or 0)
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        ways = []
        for leaf in nodes:
            if leaf in parents:
                continue
            way, at = [], leaf
            while at in nodes:
                way.append(at)
                at = nodes[at][0]
            ways.append((-sum(nodes[m][1] for m in way), leaf, way[::-1]))
        for k, (_, _, way) in enumerate(sorted(ways)[:top], 1):
            out[tree, k] = way
    return out


def test_branches_against_brute_force(spark):
    source, rows = random.Random(1), []
    for tree in range(12):
        for msg in range(source.randint(1, 25)):
            parent = source.randrange(msg) if msg and source.random() > 0.1 else None
            rows.append((tree, msg, parent, float(source.randint(0, 3)), "user", f"{tree}/{msg}", 1, 2))
    rows += [(50, k, k - 1 if k else None, 1.0, "user", f"50/{k}", 1, 2) for k in range(37)]  # a chain
    rows += [(51, k, 0 if k else None, 0.0, "user", f"51/{k}", 1, 2) for k in range(30)]  # a star
    found = reply_trees.branches(spark.createDataFrame(rows, SCHEMA), top=3).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["place"]):
        got.setdefault((r["tree_id"], r["branch"]), []).append(int(r["text"].split("/")[1]))
    assert got == brute(rows, 3)


def test_awkward_trees(spark):
    rows = [
        (1, 1, None, None, None, None, 0, 0),
        (1, 1, None, None, None, None, 0, 0),  # repeated
        (2, 1, 9, 1.0, "user", "orphan", 0, 0),
        (3, 1, 2, 1.0, "user", "circle", 0, 0),
        (3, 2, 1, 1.0, "user", "circle", 0, 0),
        (None, 1, None, 1.0, "assistant", "null tree", 0, 0),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    read = reply_trees.read_back(reply_trees.format_branches(reply_trees.branches(table))).collect()
    turns = {r["tree_id"]: [tuple(t) for t in r["turns"]] for r in read}
    assert turns == {1: [("", "")], 2: [("user", "orphan")], None: [("assistant", "null tree")]}
    assert reply_trees.branches(table.filter("false")).count() == 0


def test_template_is_reversible(spark):
    texts = ["", "<|im_end|>", "\\", "<\\|", "\\<|im_start|>\\\\", "<|im_sep|>a<", "|>", "é\n🙂", "</s>[INST]", "long " * 20_000]
    rows = [(1, k, ["user", "assistant", "<|im_sep|>\\"][k % 3], t) for k, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    paths = reply_trees.branches(reply_trees.chains(table))
    one = reply_trees.read_back(reply_trees.format_branches(paths)).first()
    assert [(t["role"], t["text"]) for t in one["turns"]] == [(r, t) for _, _, r, t in rows]
    assert one["loss_text"] == "".join(t for _, _, r, t in rows if r == "assistant")


CHANGES = "op string, source string, lang string, tokenizer string, tokens bigint, old_tokens bigint, n_docs int"


def test_rollup(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "rollup"))
    first = spark.createDataFrame(
        [("insert", "s", "en", "v1", 10, None, 0), ("insert", "s", "en", "v1", 5, None, 0), ("insert", None, None, None, None, None, 0)],
        CHANGES,
    )
    second = spark.createDataFrame(
        [("revise", "s", "en", "v1", 7, 10, 0), ("delete", "s", "en", "v1", 5, None, 0)], CHANGES
    )
    key = lambda: {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}
    assert key() == {}
    assert rollup.commit("a", first) and not rollup.commit("a", first)
    assert key() == {("s", "en", "v1"): (2, 15), (None, None, None): (1, 0)}
    rollup.compact()
    assert not rollup.commit("a", first)
    assert rollup.commit("b", second) and not rollup.commit("b", second)
    rollup.compact()
    assert not rollup.commit("b", second)
    assert key() == {("s", "en", "v1"): (1, 7), (None, None, None): (1, 0)}
    assert rollup.commit("none", first.filter("false")) and key()["s", "en", "v1"] == (1, 7)


def test_unknown_change_fails(spark):
    bad = spark.createDataFrame([("upsert", "s", "en", "v", 1, 1, 0)], CHANGES)
    try:
        deltas(bad).collect()
    except Exception as error:
        assert "unknown change" in str(error)
    else:
        raise AssertionError("an unknown change passed")
