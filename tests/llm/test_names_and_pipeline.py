"""Columns named like inner ones, and the pipeline from end to end against plain Python."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from texts import prose
from tokenizers import Tokenizer

import corpus_pipeline
from orderflow.llm import language_id
from orderflow.llm.line_dedup import near_lines, without_repeats
from orderflow.llm.minhash_dedup import near_duplicates, without_copies


def rows():
    out = [(k, prose(k, 60), "xx" if k % 2 else "yy", "s", None) for k in range(30)]
    out += [(100, out[3][1], "xx", "s", None)]  # an exact copy
    out += [(101, out[4][1] + " " + prose(999, 2), "yy", "s", None)]  # a near copy
    out += [(102, "first line of its own " + prose(500, 20) + "\n" + prose(501, 30), "xx", "s", None)]
    out += [(103, prose(502, 30) + "\n" + prose(501, 30), "xx", "s", None)]  # its second line again
    out += [(104, prose(503, 20) + " " + prose(700, 25) + " " + prose(504, 20), "yy", "s", None)]  # quotes item 1
    out += [(105, None, "xx", "s", None), (106, "12 34 --", "xx", "s", None), (107, "", None, "s", None)]
    return out


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_clashing_names(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    odd = docs.withColumns({n: F.lit(n) for n in ("gone", "of", "_lettered", "id", "node", "Gone_")})
    assert without_repeats(odd, near_lines(odd)).columns == odd.columns
    assert without_copies(odd, near_duplicates(odd)).columns == odd.columns
    model = language_id.fit(odd)
    plain = language_id.with_language(docs, language_id.fit(docs)).select("doc_id", "lang_pred").collect()
    found = language_id.with_language(odd, model)
    assert found.columns == [*odd.columns, "lang_pred", "score", "ambiguous"]
    assert sorted(found.select("doc_id", "lang_pred").collect()) == sorted(plain)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline(spark, tmp_path, empty):
    table = [] if empty else rows()
    spark.createDataFrame(table, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    items = [] if empty else [(1, prose(700, 25)), (2, prose(701, 25))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    texts = {i: t for i, t, *_ in table}
    if not empty:
        # No letters: 105 to 107. A copy line by line is emptied: 100, and 101 is a near copy. An item: 104.
        for i in (100, 101, 104, 105, 106, 107):
            del texts[i]
        texts[103] = texts[103].split("\n")[0]
    assert set(found) == set(texts)
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in texts.items():
        ids = known.encode(text, add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_texts_that_lose_no_line_are_not_shuffled(spark, monkeypatch):
    """Joined by size or merged, the same rows; those merged are the marked ones."""
    from orderflow.llm import cuts, line_dedup

    own = [(k, prose(k, 40), "xx", "s", None) for k in range(200)]
    again = [(1000 + k, prose(k, 40) + "\n" + prose(2000 + k, 10), "xx", "s", 5) for k in range(0, 40, 2)]
    odd = [(None, prose(7, 40) + "\n" + prose(5000, 9), "xx", "s", 5), (3, None, "xx", "s", None), (5000, "", "xx", "s", 0)]
    docs = spark.createDataFrame([*own, *again, *odd], SCHEMA)
    decided = near_lines(docs).cache()
    small = sorted(map(str, without_repeats(docs, decided).collect()))
    monkeypatch.setattr(line_dedup, "by_size", lambda df: df)
    large = without_repeats(docs, decided)
    assert sorted(map(str, large.collect())) == small and len(small) == 222
    cut = [r for r in large.collect() if (r["doc_id"] or 0) >= 1000 and r["text"]]
    assert all(r["n_chars"] == len(r["text"]) and "\n" not in r["text"] for r in cut) and len(cut) == 20
    gone = decided.filter("not kept").select("doc_id").distinct()
    told = cuts.marked(docs, F.col("doc_id"), gone, "loses", 16)
    lost = {r["doc_id"] for r in gone.collect()}
    marked = {r["doc_id"] for r in told.filter("loses").collect()}
    assert lost <= marked and len(marked) < len(lost) + 60
    assert told.count() == docs.count()


def test_language_fit_takes_arrow_batches(spark):
    """No task holds the texts as a pandas table, and more texts than were asked for have room."""
    assert "pandas" not in vars(language_id) and "pd" not in vars(language_id)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        docs = spark.createDataFrame(rows(), SCHEMA)
        few = language_id.fit(docs.union(docs).union(docs), sample=10)
        full = language_id.fit(docs)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert few.languages == full.languages == ["xx", "yy"] and full.weights.shape == (language_id.CELLS, 1)
