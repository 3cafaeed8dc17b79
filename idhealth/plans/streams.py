"""Streaming queries: events are read as a file stream, run to its end and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idhealth.functions.times import micros
from idhealth.sources.shared import folder
from idhealth.streaming import averages, stages

from .catalog import query, read


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet*"  # a pattern: the stream takes a file as well as a folder
    return spark.readStream.schema(read(spark, sf_dir, "events").schema).parquet(path)


def ran(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    out = folder(spark, name)
    stages.run_once(df, f"{out}/data", f"{out}/state")
    return spark.read.schema(df.schema).parquet(f"{out}/data")


@query("stream_thresholds", """
WITH d AS (SELECT user_id, ts, date_trunc('day', ts) AS day, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // (6 * 3600000000) AS q FROM events),
s AS (SELECT user_id, day, q, min(ts) AS t FROM d GROUP BY ALL), f AS (SELECT user_id, min(day) AS day FROM d GROUP BY 1),
r AS (SELECT s.*, row_number() OVER (PARTITION BY s.user_id ORDER BY t) AS n FROM s)
SELECT user_id AS node, count(*) FILTER (n > 1 OR q > 0) AS emitted FROM r GROUP BY 1
""")
def stream_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter of a day in which a client sends after its first one is announced once."""
    s = events(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp"))
    out = ran(spark, stages.thresholds(s, "user_id", "t", 6), "thresholds")
    nodes = read(spark, sf_dir, "events").select(F.col("user_id").alias("node")).distinct()
    return nodes.join(out.groupBy("node").agg(F.count("*").alias("emitted")), "node", "left").fillna({"emitted": 0})


@query("stream_counts", "WITH e AS (SELECT *, epoch_us(ts) // 86400000000 AS d FROM events) SELECT event_type, d AS day, count(*) AS count, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM e WHERE d < (SELECT max(d) FROM e) GROUP BY ALL")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the days that are final: all but the last."""
    s = events(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp"))
    out = ran(spark, stages.windowed_counts(s, "t", ["event_type"], 24), "counts")
    day = F.floor(micros(F.col("start")) / 86_400_000_000).alias("day")
    return out.select("event_type", day, "count", micros(F.col("first_ts")).alias("first_us"), micros(F.col("last_ts")).alias("last_us"))


@query("stream_node_series", "WITH e AS (SELECT event_type, user_id, epoch_us(ts) // 86400000000 AS d FROM events) SELECT event_type, d AS day, count(*) AS rows, sum(coalesce(n_nationkey, 0))::BIGINT AS n_nationkey FROM e JOIN (SELECT c_custkey, n_nationkey FROM customer JOIN nation ON c_nationkey = n_nationkey) ON user_id = c_custkey WHERE d < (SELECT max(d) - 1 FROM e) GROUP BY ALL")
def stream_node_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events joined with their customer's nation, summed by day and event type; days that are surely final."""
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("long").alias("n_nationkey"))
    s = events(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp"))
    out = ran(spark, stages.node_series(stages.analyzed(s, c, "user_id"), "t", "event_type", ["n_nationkey"], 24), "series")
    day = F.floor(micros(F.col("start")) / 86_400_000_000)
    last = F.broadcast(read(spark, sf_dir, "events").agg((F.max(F.floor(micros(F.col("ts")) / 86_400_000_000)) - 1).alias("last")))  # one row
    return out.withColumn("day", day).crossJoin(last).where("day < last").select("event_type", "day", "rows", "n_nationkey")


@query("stream_capped_rows", "WITH e AS (SELECT user_id, epoch_us(ts) // 3600000000 AS h FROM events) SELECT user_id, sum(least(n, 2))::BIGINT AS kept FROM (SELECT user_id, h, count(*) AS n FROM e GROUP BY ALL) GROUP BY user_id")
def stream_capped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a cap of two a client and hour keeps."""
    s = events(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("t"))
    return ran(spark, stages.capped_rows(s, "user_id", "t", 2), "capped-rows").groupBy("user_id").agg(F.count("*").alias("kept"))


@query("stream_capped", "WITH e AS (SELECT user_id, epoch_us(ts) // 3600000000 AS h FROM events) SELECT user_id, h AS hour, count(*) AS seen, least(count(*), 2) AS kept FROM e WHERE h < (SELECT max(h) - 1 FROM e) GROUP BY ALL")
def stream_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = events(spark, sf_dir).withColumn("t", F.col("ts").cast("timestamp"))
    out = ran(spark, stages.capped(s, "user_id", "t", 2), "capped")
    hour = F.floor(micros(F.col("start")) / 3_600_000_000)
    last = F.broadcast(read(spark, sf_dir, "events").agg((F.max(F.floor(micros(F.col("ts")) / 3_600_000_000)) - 1).alias("last")))  # one row
    return out.withColumn("hour", hour).crossJoin(last).where("hour < last").select("user_id", "hour", "seen", "kept")


_TYPES = ("click", "view")


@query("stream_averages", f"""
WITH x AS (SELECT event_id, user_id::VARCHAR AS node, epoch_us(ts) AS us, epoch_us(ts) // 86400000000 AS d, event_type FROM events),
l AS (SELECT *, 'all' AS label FROM x UNION ALL SELECT *, event_type FROM x WHERE event_type IN {_TYPES}),
e AS (SELECT label, d AS day, us, node, event_id, us % 86400000000 AS t FROM l UNION ALL SELECT l.label, l.d - j, l.us, l.node, l.event_id, 86399999999 FROM l, (VALUES (1), (2), (3)) k(j) WHERE EXISTS (SELECT 1 FROM l AS o WHERE o.label = l.label AND o.d = l.d - j AND o.node = l.node)),
s AS (SELECT *, row_number() OVER (PARTITION BY label, day ORDER BY us, node, event_id) AS n FROM e),
w AS (SELECT a.label, a.day, a.n, b.node, max(b.t) AS t FROM s a JOIN s b ON a.label = b.label AND a.day = b.day AND b.n <= a.n GROUP BY ALL),
m AS (SELECT label, day, n, min(t) AS t, count(*) AS nodes FROM w GROUP BY ALL),
g AS (SELECT *, (t >= 21600000000)::INT + (t >= 43200000000)::INT + (t >= 64800000000)::INT + (t >= 83519000000)::INT AS level FROM m),
p AS (SELECT *, coalesce(max(level) OVER (PARTITION BY label, day ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT label, day, t AS at_us, level = 4 AS final, nodes FROM p WHERE level > before
""")
def stream_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients as nodes, event types as countries: what is ready to be averaged of every day, for two types and for all."""
    s = events(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("t"), F.col("user_id").alias("node"), F.col("event_type").alias("cc"), F.lit(None).cast("string").alias("city"), F.col("event_id").cast("string").alias("path"))
    out = ran(spark, averages.pattern_averages(s, "t", [("all", None, None), *((t, t, None) for t in _TYPES)], 6, keep_days=3), "averages")
    return out.select("label", "day", "at_us", "final", F.size("nodes").cast("long").alias("nodes"))


@query("stream_replayed", "SELECT user_id, epoch_us(ts) // 86400000000 AS day, count(*) AS rows FROM events GROUP BY ALL")
def stream_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written batch by batch under their type; the first batch is then written again, as after a failure, and counts once."""
    out = folder(spark, "replayed")
    s = events(spark, sf_dir).select("user_id", "event_type", F.floor(micros(F.col("ts")) / 86_400_000_000).alias("day"))
    stages.run_replayable(s, f"{out}/data", f"{out}/state", ["event_type"])
    again = read(spark, sf_dir, "events").select("user_id", "event_type", F.floor(micros(F.col("ts")) / 86_400_000_000).alias("day"))
    stages.replayable(f"{out}/data", ["event_type"])(again, 0)
    return spark.read.parquet(f"{out}/data").groupBy("user_id", "day").agg(F.count("*").alias("rows"))
