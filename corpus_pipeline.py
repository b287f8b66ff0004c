"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; its result is written as Parquet below the shared directory
and read back as the next one's documents. All but the last return the columns
of ``documents``, whatever further ones there are and however they are named;
``n_chars``, where there is one, follows the text. No rows give no rows.

SQL can't express the tokenisers, hence no ``ORACLE_SQL``; the tests hold the
stages against plain restatements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hirelens.llm.bayes_minhash import near_duplicates
from hirelens.llm.common import ship, stored, table
from hirelens.llm.fertility import fertility_filter
from hirelens.llm.nnls_pack import pack
from hirelens.llm.secrets import redact, secret_spans, train_markov
from hirelens.llm.site_lines import drop_boilerplate


OWN = ("doc_id", "text", "lang", "source")


def _plain(docs: DataFrame) -> DataFrame:
    """``docs`` with names of its own for all columns but ``OWN``, so that none
    is taken for an operator's result or for a field of a struct."""
    return docs.toDF(*[c if c in OWN else f"further_{i}" for i, c in enumerate(docs.columns)])


def _like(result: DataFrame, docs: DataFrame) -> DataFrame:
    """``result`` of an operator on ``_plain(docs)`` with the columns of
    ``docs``; n_chars follows the text."""
    columns = [F.length("text").cast(docs.schema[i].dataType) if c == "n_chars" else F.col(p) for i, (c, p) in enumerate(zip(docs.columns, _plain(docs).columns))]
    return result.select(*columns).toDF(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or whose tokeniser fertility
    is out of their language's bands. Null and empty texts fail the base rules;
    repeated rows stay or go together."""
    ship(spark)
    return _like(fertility_filter(_plain(docs)).where("kept"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that too many of a source's documents contain. No document
    goes: a text whose lines all go is empty, a null text stays null."""
    ship(spark)
    return _like(drop_boilerplate(_plain(docs), host="source", text="text"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the
    smallest id; of rows that share it, the greatest by text, language, source
    and the others' JSON. Documents without words are in no group, nor are rows
    without an id; all of these stay."""
    ship(spark)
    plain = _plain(docs)
    labels = stored(near_duplicates(plain.select("doc_id", "text")), "labels")
    again = labels.where("kept AND n_shingles > 0 AND doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    out = labels.where("NOT kept").select("doc_id").union(again).distinct()
    further = [c for c in plain.columns if c not in OWN]
    order = [F.desc(c) for c in OWN[1:]] + [F.desc(F.to_json(F.struct(*further)))] * bool(further)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    one = plain.join(again, "doc_id", "left_semi").withColumn("place", place).where("place = 1").select(*plain.columns)
    return _like(plain.join(out, "doc_id", "left_anti").select(*plain.columns).union(one), docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; null and empty texts stay
    as they are."""
    ship(spark)
    plain = _plain(docs)
    return _like(redact(secret_spans(plain, train_markov(plain))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences with their token ids. A null or empty
    text has the end token alone; repeated rows are packed each."""
    ship(spark)
    return pack(_plain(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_dedup),
    ("secret scan", secret_scan),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
