"""Writers. Sorted outputs are range-partitioned by Spark; nothing goes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from idhealth.functions.slices import metric_label, six_decimals


def write_summary(df: DataFrame, path: str, version: int, label: str = "TOOLS_VERSION") -> None:
    """Counters sorted by registry and key; the first line of each file tells the version."""
    body = df.orderBy("registry", "key").select(F.concat_ws(",", "registry", F.col("key_type").cast("string"), "key", F.col("count").cast("string"), F.lit("")).alias("value"))
    head = f"{label},0,0,{version},"

    def with_head(batches):
        import pyarrow as pa

        first = True
        for b in batches:
            if first and b.num_rows:
                yield pa.record_batch([pa.array([head], b.schema.field(0).type)], schema=b.schema)
                first = False
            yield b

    body.mapInArrow(with_head, "value string").write.text(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """metric, date, version, key, value lines with six decimals, a folder for each family and date."""
    line = F.concat_ws(",", "metric", F.date_format("date", "yyyy-MM-dd"), "version", F.concat(F.lit(" "), metric_label(F.col("key"))), F.concat(F.lit(" "), six_decimals(F.col("value"))), F.lit(""))
    family = F.regexp_extract("metric", r"^(M\d+)", 1)
    out = df.select(line.alias("value"), family.alias("family"), F.date_format("date", "yyyy-MM-dd").alias("day"))
    out.repartitionByRange("family", "day", "value").sortWithinPartitions("family", "day", "value").write.partitionBy("family", "day").text(path)


def write_records(df: DataFrame, path: str, address: str) -> None:
    """Wide address records: vectors as columns, sorted by the length of the address and then its bytes."""
    flat = []
    for f in df.schema:
        if f.dataType.typeName() == "array":
            n = df.agg(F.max(F.size(f.name)).alias("n")).first()["n"] or 0
            flat += [F.get(F.col(f.name), F.lit(i)).alias(f"{f.name}_{i}") for i in range(n)]
        else:
            flat.append(F.col(f.name))
    df.select(*flat).orderBy(F.length(address), address).write.csv(path)


def write_sum3(df: DataFrame, path: str) -> None:
    """Slice rows appended under date and node."""
    df.write.mode("append").partitionBy("date", "address").option("header", "true").csv(path)


def write_partitioned(df: DataFrame, path: str, key: str, sort: Sequence[str] = ()) -> None:
    """A folder for each key; a key's rows may be in several files."""
    (df.sortWithinPartitions(key, *sort) if sort else df).write.partitionBy(key).option("header", "true").csv(path)


def publish(vectors: DataFrame, path: str, metric: str, values: str) -> None:
    """A JSON object for each series."""
    vectors.select(F.to_json(F.struct(F.col(metric).alias("metric"), F.col(values).alias("values"))).alias("value")).write.text(path)


def write_report(df: DataFrame, path: str, order: Sequence) -> None:
    df.orderBy(*order).write.option("compression", "gzip").option("header", "true").csv(path)
