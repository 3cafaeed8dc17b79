"""Queries over files that lists name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.operators.counters import merge_counts
from idhealth.sources import filelists, readers
from idhealth.sources.shared import folder

from .catalog import query, read


@query("listed_summaries", "SELECT l_returnflag AS registry, l_linenumber::VARCHAR AS key, count(*) AS count FROM lineitem GROUP BY ALL")
def listed_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items counted by supplier into summary files, whose names stand in a list for each flag, whose names stand in one list: found, read and added up again."""
    home = folder(spark, "summaries")
    counts = read(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.col("l_returnflag").alias("registry"), F.col("l_linenumber").cast("string").alias("key")).agg(F.count("*").alias("count"))
    counts.select("registry", F.lit(1).alias("key_type"), "key", "count", F.lit(None).cast("string").alias("end"), F.col("registry").alias("flag")).write.partitionBy("flag").csv(f"{home}/files")
    name = filelists.decoded(F.col("_metadata.file_path")).alias("value")
    spark.read.text(f"{home}/files").select(name).distinct().withColumn("flag", F.regexp_extract("value", "/flag=([^/]*)/", 1)).write.partitionBy("flag").text(f"{home}/lists")
    spark.read.text(f"{home}/lists").select(name).distinct().write.text(f"{home}/top")
    files = filelists.listed_files(spark, f"{home}/top")
    found = filelists.read_listed(spark, files, {"summary": (r"\.csv$", readers.read_summary)})
    return merge_counts(found.get("summary", counts).select("registry", "key", "count"))  # no rows: no files
