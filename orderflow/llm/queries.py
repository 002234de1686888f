"""The registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from ..session import checkpoint_root
from . import bpe, edit_fingerprints, language_id, reply_trees, toxicity
from .decontamination import find_leaks
from .hard_negatives import mine
from .html_extraction import extract
from .lexical_search import search
from .line_dedup import near_lines
from .minhash_dedup import near_duplicates
from .substring_dedup import without_passages
from .token_rollups import Rollup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held_out))
    found = language_id.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@_query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labels of four fifths of them."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels").filter(~held_out))
    found = toxicity.score(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item it holds, within a fifth of the item's words."""
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document as digests."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "utf-8"), 256).alias("decoded_sha256"),
    )


@_query
def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents by four-word shingles at 0.8."""
    return near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


#: The conversation that the template must survive.
_MARKS = "</s>[INST] ok [/INST]"


@_query
def op3_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as its best branch, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_MARKS).alias("text"),
    )
    paths = reply_trees.branches(reply_trees.chains(rows.unionByName(extra)))
    read = reply_trees.read_back(reply_trees.format_branches(paths))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(F.array_join(turns, ""), "utf-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "utf-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@_query
def op6_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its text edited with the next one's."""
    return edit_fingerprints.with_next(_table(spark, sf_dir, "documents"))


#: What two tokenizer versions count: runs without blanks; and letters' runs, digits and marks.
_WORDS = r"[^\x20\x09-\x0D]+"
_PIECES = r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D\x{80}-\x{10FFFF}]"


@_query
def op7_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two tokenizer versions after inserts, a revision, deletes and a repeated batch.

    All documents are inserted under both versions. The first version's counts are then revised to
    words with a letter or digit, and from the second all but the first document of each text are
    deleted. The revision is committed twice and counts once.
    """
    docs = _table(spark, sf_dir, "documents")
    rollup = Rollup(spark, f"{checkpoint_root(spark)}/rollup-{uuid.uuid4().hex}")
    words = F.regexp_count("text", F.lit(_WORDS))
    lettered = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]*[A-Za-z0-9\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*"))
    pieces = F.regexp_count("text", F.lit(_PIECES))

    def changes(rows: DataFrame, op: str, tokenizer: str, tokens: F.Column, old: F.Column) -> DataFrame:
        return rows.select(
            F.lit(op).alias("op"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
            tokens.alias("tokens"), old.alias("old_tokens"),
        )

    none = F.lit(None).cast("int")
    first = docs.groupBy(F.xxhash64("text").alias("h"), F.sha2(F.encode("text", "utf-8"), 256).alias("s"))
    first = first.agg(F.min("doc_id").alias("first"))
    again = docs.withColumn("h", F.xxhash64("text")).withColumn("s", F.sha2(F.encode("text", "utf-8"), 256))
    again = again.join(first, ["h", "s"]).filter(F.col("doc_id") > F.col("first"))
    rollup.commit("insert words", changes(docs, "insert", "words", words, none))
    rollup.commit("insert pieces", changes(docs, "insert", "pieces", pieces, none))
    revised = changes(docs, "revise", "words", lettered, words)
    rollup.commit("revise words", revised)
    rollup.compact()
    rollup.commit("delete repeats", changes(again, "delete", "pieces", pieces, none))
    rollup.commit("revise words", revised)
    return rollup.totals()


ORACLE_SQL["op7_token_rollups"] = r"""
with counted as (
  select doc_id, text, source, lang,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]*[A-Za-z0-9\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*')), 0) as lettered,
    coalesce(len(regexp_extract_all(text, '[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D\x{80}-\x{10FFFF}]')), 0) as pieces,
    min(doc_id) over (partition by text) as first
  from documents
)
select source, lang, 'words' as tokenizer, count(*) as n_docs, cast(sum(lettered) as bigint) as n_tokens
from counted group by source, lang
union all
select source, lang, 'pieces', count(*), cast(sum(pieces) as bigint)
from counted where text is null or doc_id = first group by source, lang
"""


@_query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@_query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with the line that stands for it."""
    return near_lines(_table(spark, sf_dir, "documents"))


@_query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without passages of 13 words that start in an earlier one."""
    found = without_passages(_table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256"))


ORACLE_SQL["op11_substring_dedup"] = r"""
with split as (
  select row_number() over () as r, doc_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws
  from documents
), windows as (
  select r, doc_id, k, array_to_string(ws[k:k + 12], ' ') as w
  from (select r, doc_id, ws, unnest(range(1, len(ws) - 11)) as k from split where len(ws) >= 13)
), firsts as (
  select w, min(doc_id) as first from windows group by w
), gone as (
  select distinct r, k + unnest(range(0, 13)) as p
  from windows join firsts using (w) where first < doc_id
), placed as (
  select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from split
), kept as (
  select r, string_agg(word, ' ' order by p) as text, count(*) as n
  from placed anti join gone using (r, p) group by r
)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from split left join kept using (r)
"""


@_query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


ORACLE_SQL["op12_lexical_search"] = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), lengths as (
  select doc_id, count(*) as n from words group by doc_id
), totals as (
  select count(*) as nn, cast(sum(n) as bigint) as ll from lengths
), asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark) group by item_id, term
), counted as (
  select doc_id, term, count(*) as tf from words where term in (select term from asked) group by doc_id, term
), weights as (
  select term, cast(floor(1000 * ln(cast(2 * any_value(nn) + 2 as double) / (2 * count(*) + 1))) as bigint) as w
  from counted cross join totals group by term
), parts as (
  select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll))) as part
  from counted join lengths using (doc_id) join weights using (term) cross join totals
), scores as (
  select item_id, doc_id, cast(sum(times * part) as bigint) as score
  from asked join parts using (term) group by item_id, doc_id
)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
from scores where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10
"""


@_query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each positive of every hundredth vector; some labels are moved first."""
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), every=100, positives=5, negatives=10, low=30, high=90)


ORACLE_SQL["op13_hard_negatives"] = r"""
with sound as (
  select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scores as (
  select a.id as anchor_id, a.label = b.label as same, b.id,
    cast(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) as bigint) as score
  from sound a join sound b on a.id <> b.id where a.id % 100 = 0
), positives as (
  select * from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), ranked as (
  select p.anchor_id, p.id as positive_id, n.id as negative_id, p.score as positive_score, n.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as int) as rank
  from positives p join scores n using (anchor_id)
  where not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""
