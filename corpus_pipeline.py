"""A corpus pipeline of the text operators: each stage reads what its predecessor kept and returns the columns of documents.

toxicity        documents that the classifier calls toxic go
exact_dedup     of equal texts the one with the largest doc_id stays
jaccard_join    of each group of near duplicates (five words, 0.8) the one with the smallest doc_id stays
pii             personal data are replaced by pseudonyms of the same format
packing         the texts that are left are packed into sequences; a row per piece

A stage is called when its predecessor's result has been written and read again, so it begins by deleting the tables that
its predecessor settled on the way.

Rows are never lost for a null or repeated id: stages that drop rows number the rows first. Columns of other names are
carried through the first four stages.
"""

from __future__ import annotations

import contextvars
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweave.llm import exact_dedup, jaccard_join, packing, pii, toxicity
from loopweave.llm.common import numbered, settle_in_small_batches
from loopweave.llm.queries import PII_KEY, tokenizer_file, toxicity_model
from loopweave.scratch import drop, recorded, settle

#: The toxicity model and the tokenizer can't be said in SQL; the stages are tested one by one.
ORACLE_SQL = None

#: Documents of an Arrow batch in a stage that passes whole texts to Python.
BATCH_ROWS = 1024

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Tables that the stage before has settled, per thread.
_settled: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("settled", default=None)


def stage(fn: Stage) -> Stage:
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop(spark, _settled.get() or [])
        with recorded() as paths:
            out = fn(spark, docs, sf_dir)
        _settled.set(paths)
        return out

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # written here, where the size of an Arrow batch can be set: of default size, texts take much of an executor's memory
    return settle_in_small_batches(toxicity.keep_clean(docs, toxicity_model(spark, sf_dir)), BATCH_ROWS)


def _free(docs: DataFrame) -> str:
    """A column name for row numbers that the table doesn't have."""
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = _free(docs)
    rows = numbered(docs, row)
    found = exact_dedup.exact_dedup(rows, row_col=row)
    return rows.join(settle(found.where("not kept").select(row)), row, "left_anti").drop(row)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = _free(docs)
    rows = numbered(docs, row)
    found = jaccard_join.jaccard_components(rows, id_col=row)
    # a group's first row number stands for the group; the row with the smallest doc_id stays, nulls last
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    grouped = settle(found.where("n_shingles > 0").select(row, "component_id"))
    many = grouped.groupBy("component_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("component_id")
    members = settle(grouped.join(settle(many), "component_id"))
    ids = rows.select(row, "doc_id").join(members, row)
    stays = ids.groupBy("component_id").agg(F.min(place)[row].alias(row))
    gone = members.select(row).join(settle(stays.select(row)), row, "left_anti")
    return rows.join(settle(gone), row, "left_anti").drop(row)


@stage
def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = pii.pseudonymise(docs, PII_KEY)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("pii", hide_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = settle(step(spark, docs, sf_dir))
    return docs
