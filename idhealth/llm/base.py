"""Shared pieces: tables, written intermediate results, row keys."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: texts may be long, and a task holds a batch in the JVM and in Python.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Makes the session hand texts to tasks in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a session in one process (tests) gets a folder of its own where it is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return "file://" + _own_dir(spark.sparkContext.applicationId)


@functools.cache
def _own_dir(app: str) -> str:
    return tempfile.mkdtemp(prefix="spark-shared-")


def new_dir(spark: SparkSession, name: str) -> str:
    """A folder that doesn't exist yet; clean() deletes all that a session got."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _given.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_given: dict[str, list[str]] = {}


def clean(spark: SparkSession) -> int:
    """Deletes the intermediate tables, packs and archives of this application so far, and says how many. Results must have been read or written before."""
    paths = _given.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = new_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def text_key(column: str) -> Column:
    """Tells apart rows that share an id but not a text; rows equal in both are one case and get equal results."""
    return F.xxhash64(text_of(column))


#: Separators of words, and how A-Z are lower-cased; other letters keep their case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_words(text: Column, separators: str) -> Column:
    """What stands between runs of separators, in order; splitting is far cheaper than extracting every match."""
    return F.array_remove(F.split(text, separators), "")


def packed(df: DataFrame, **keys: Column) -> DataFrame:
    """Each row as one struct `row`, beside keys: whatever its columns are called, they don't clash with others."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in keys.items()])


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


#: Rows of short tables that may be broadcast; several of them may be held at once (about 20 MB each as hash relations).
BROADCAST_IDS = 200_000


def small_side(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """Marks a written table of short rows for broadcast if they are counted to be few enough; otherwise the join shuffles."""
    return F.broadcast(ids) if ids.count() <= most else ids


def few_bytes(table: DataFrame, size: Column, most: int = 64 << 20) -> DataFrame:
    """Marks a written table for broadcast if the bytes of its rows are summed to be few enough."""
    return F.broadcast(table) if (table.agg(F.sum(size + 32).alias("b")).first()["b"] or 0) <= most else table


def distinct_texts(rows: DataFrame) -> DataFrame:
    """Adds rep (least id that has the text) and tid, the text's own id: rep, or for a further text of one id a hash above all ids (2**62).

    rows: doc_id (long, not null), digest and more. Copies are counted and written before they are joined, so that Spark
    can split the rows of a text with very many copies.
    """
    reps = written(rows.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("digest", "rep"), "copies")
    known = rows.join(small_side(reps), "digest", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    several = known.groupBy("rep").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least <> most").select("rep", "least")
    known = known.join(small_side(written(several, "several")), "rep", "left")
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("digest"), 2)
    return known.withColumn("tid", F.when(F.col("least").isNull() | (F.col("digest") == F.col("least")), F.col("rep")).otherwise(own)).drop("least")


def collapsed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For docs (doc_id long, not null; text): (tid, text) of each distinct text, and (doc_id, digest, rep, tid) of all rows.

    The texts stay where they are: copies and texts of repeated ids are marked by a join with their keys.
    """
    base = docs.select("doc_id", F.md5(F.encode("text", "UTF-8")).alias("digest"), "text")
    known = written(distinct_texts(base.select("doc_id", "digest")), "texts")
    again = small_side(written(known.where("doc_id <> rep").select("doc_id", "digest").distinct(), "texts-again"))
    odd = small_side(written(known.where("tid <> rep").select("doc_id", "digest", "tid").distinct(), "texts-odd"))
    own = base.join(again, ["doc_id", "digest"], "left_anti").join(odd, ["doc_id", "digest"], "left").select(F.coalesce("tid", "doc_id").alias("tid"), "text")
    if known.where("doc_id = rep").groupBy("doc_id", "digest").count().where("count > 1").take(1):
        own = own.dropDuplicates(["tid"])
    return own, known
