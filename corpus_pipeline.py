"""From raw documents to packed training sequences, in five stages.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result to the shared
folder and gives it to the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactframe.llm import queries as llm
from pactframe.llm import secrets
from pactframe.llm.common import col, table, written
from pactframe.llm.exact_dedup import ascii_lower, exact_dedup, sha256
from pactframe.llm.jaccard_join import jaccard_join
from pactframe.llm.packing import pack
from pactframe.llm.quality import quality_filter
from pactframe.scratch import checkpointed, scratch_path
from pactframe.sources.files import Folder


def _packed(docs: DataFrame, **more: Column) -> DataFrame:
    """Each row of `docs` as one value `row`, so that its columns' names meet no others."""
    given = F.struct(*map(col, docs.columns)).alias("row")
    return docs.select(given, *(value.alias(name) for name, value in more.items()))


def _ids_repeat(docs: DataFrame) -> bool:
    return not docs.groupBy(docs["doc_id"]).count().where("count > 1").isEmpty()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; all columns stay as they are.

    A null text is judged as an empty one, a long one as a whole, and copies alike; rows without ids are judged too. An
    empty table stays empty.
    """
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that with the largest id.

    Texts are equal if they are so without regard to the case of A-Z; a null text is an empty one. Rows that
    repeat id and text become one, whichever. Rows without an id stay, one of each text, if no row with one has
    their text. Other columns may have any names. An empty table stays empty.
    """
    kept = checkpointed(exact_dedup(docs).where("kept").select("id", "digest").distinct())
    if not _ids_repeat(docs):
        rows = _packed(docs, own=F.col("doc_id"))
        same = F.col("own").eqNullSafe(F.col("id"))
        return rows.join(kept.select("id"), same, "left_semi").select("row.*")
    # Rows of one id are told apart by text.
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _packed(docs, own=F.col("doc_id"), body=sha256(ascii_lower(text)))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("body") == F.col("digest"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["own", "body"]).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-equal texts: the one that names the class.

    Rows without an id, and texts without words, are classes of their own. Where ids repeat, rows are
    told apart by a number of their own, and the least row of the least id stays. Other columns may have any
    names. An empty table stays empty.
    """
    if _ids_repeat(docs.where("doc_id IS NOT NULL")):
        numbered = written(
            _packed(docs, own=F.col("doc_id"), text=F.col("text"), number=F.monotonically_increasing_id()), "numbered"
        )
        classes = jaccard_join(numbered.where("own IS NOT NULL"), "number").select("id", "class_id")
        kept = (
            numbered.join(classes, F.col("number") == F.col("id"))
            .groupBy("class_id")
            .agg(F.min(F.struct("own", "number")).alias("one"))
            .select("one.number")
        )
        found = numbered.join(kept, "number", "left_semi").select("row.*")
        return found.unionByName(numbered.where("own IS NULL").select("row.*"))
    kept = jaccard_join(docs).where("id <=> class_id").select("id")
    rows = _packed(docs, own=F.col("doc_id"))
    return rows.join(kept, F.col("own").eqNullSafe(F.col("id")), "left_semi").select("row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and lengths, if there is a column for them, counted anew.

    Null texts stay null, and so does their length. Repeated rows are masked alike, long texts as a whole; an empty
    table stays empty.
    """
    masked = secrets.redact_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences.

    Null and empty texts are one token, the end. Ids may be null or repeat: each row has pieces of its own. Columns
    but id and text are not read. An empty table gives no pieces.
    """
    return pack(docs, llm.vocabulary("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("secret scans", mask_secrets),
    ("best-fit packing", sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep. Each stage's result is removed once the next is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{number}")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            Folder(spark, before).delete("")
        before = path
    return docs
