"""The corpus pipeline: language ID, quality, near-duplicates, source mix, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
works on all documents that its predecessor kept.  ``run`` writes each
stage's result as Parquet to the shared folder and reads it back for the
next.  The rules that SQL cannot express (trained models, signatures, a
tokenizer) leave no SQL for the whole; tests hold it against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import arrow_batches, rows_with_ids, staged, table
from orrery.llm.language_id import UNDETERMINED, fit, predict_column, training_rows
from orrery.llm.minhash import near_duplicates
from orrery.llm.mixing import mix
from orrery.llm.packing import pack
from orrery.llm.quality import score_column
from orrery.llm.queries import quality_model, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_LANGUAGE_SCORE = 0.4  # pooled probability below which no language is accepted
TEXTS_AT_ONCE = 1000  # texts that a Python worker holds at once
ROW_GROUP = 16 << 20  # bytes of texts that a Parquet writer holds
LEAST_TAIL = 0.5  # of P(grade >= 2): good and not toxic


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined: they have a letter, and one label holds enough of the probability.

    Null, empty and letterless texts go; long texts are read whole; null keys,
    sources and labels are no reason to go; repeated rows are judged alike;
    a tie between labels goes to the first in code point order; other columns
    are dropped; an empty table gives an empty result.
    """
    net = fit(docs.filter(training_rows(F.col("doc_id"), F.col("lang"))))
    scored = docs.withColumn("_p", predict_column(net, F.col("text")))
    keep = (F.col("_p.lang") != UNDETERMINED) & (F.col("_p.score") >= LEAST_LANGUAGE_SCORE)
    with arrow_batches(spark, TEXTS_AT_ONCE):
        return staged(scored.filter(keep).select(*COLUMNS), "language", row_group=ROW_GROUP)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good and not toxic (grade 2) more likely than not.

    Where no document has a usable label nothing can be learned and all rows
    stay.  Null, empty and wordless texts have no feature and fare as the
    labelled rows do on average; long texts are read whole; null keys and
    repeated rows are judged by their text; other columns are dropped; an
    empty table gives an empty result.
    """
    labels = table(spark, sf_dir, "labels").filter("quality in (0, 1)").select("doc_id")
    if docs.select("doc_id").join(labels, "doc_id", "left_semi").isEmpty():
        return docs.select(*COLUMNS)
    model = quality_model(spark, docs, sf_dir)
    scored = docs.withColumn("_s", score_column(model, F.col("text")))
    with arrow_batches(spark, TEXTS_AT_ONCE):
        return staged(scored.filter(F.col("_s.tails")[1] >= LEAST_TAIL).select(*COLUMNS), "quality", row_group=ROW_GROUP)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that with the smallest doc_id, one without doc_id if none has any.

    Rows are compared as rows: a repeated doc_id with unlike texts keeps each
    of them, equal rows keep one.  Rows without a word (null, empty, white
    space) are like no other and stay; long texts are read whole; other
    columns are dropped; an empty table gives an empty result.
    """
    rows = staged(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")), "duplicate-rows", row_group=ROW_GROUP)
    classes = near_duplicates(rows, key="_row").select("_row", "class_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    keep = rows.select("_row", "doc_id").join(classes, "_row").groupBy("class_id").agg(F.min_by("_row", first).alias("_row"))
    return rows_with_ids(rows, keep.select("_row"), "_row").select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: whole epochs of its source, and once more if it is sampled.

    A null source is a source; rows without a word take no part; repeated
    rows and null keys are rows of their own; other columns are dropped; an
    empty table gives an empty result.
    """
    mixed = mix(docs.select(*COLUMNS), carry=COLUMNS[1:]).filter("taken > 0").withColumn("_copies", F.expr("int(taken div size)"))
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as pieces of 2048-token sequences (columns of query op2).

    Null and empty texts have the end id alone; long texts are cut; repeated
    rows and null keys are packed each; an empty table gives an empty result.
    """
    with arrow_batches(spark, TEXTS_AT_ONCE):
        return pack(docs, tokenizer_path(), payload={"ids_crc32": F.crc32("ids")})


STAGES = [("language ID", language_stage), ("quality classifier", quality_stage), ("MinHash near-dedup", duplicate_stage),
          ("mixing sources", mixing_stage), ("packing", packing_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower(), row_group=ROW_GROUP)
    return STAGES[-1][1](spark, docs, sf_dir)
