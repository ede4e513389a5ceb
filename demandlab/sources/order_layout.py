"""Order headers and lines stored in buckets of the order id, sorted within each.

Jobs that read them through ``catalog_tables`` join the two where they lie: the lines,
by far the larger table, are never shuffled, and the headers only where they were
routed to datasets before. Both tables have the same number of buckets, one file each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandlab.sources.tables import Tables

# What one bucket of lines should hold, as stored.
BUCKET_BYTES = 256 << 20


def buckets_for(spark: SparkSession, stored_bytes: int) -> int:
    """How many buckets the lines need: a power of two with ``BUCKET_BYTES`` each.

    No fewer than ``spark.sql.shuffle.partitions``, since Spark shuffles both sides of a
    join again when the stored one has fewer parts than that.
    """
    wanted = max(-(-stored_bytes // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return 1 << (wanted - 1).bit_length()


def _store(df: DataFrame, table: str, key: str, buckets: int, location: str | None) -> None:
    # The shuffle uses the hash of the buckets, so each task writes one file.
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, key).sortBy(key)
    (writer.option("path", location) if location else writer).saveAsTable(table)


def store_orders(
    tables: Tables,
    header_table: str,
    line_table: str,
    buckets: int,
    locations: tuple[str | None, str | None] = (None, None),
) -> Tables:
    """Write headers and lines in buckets and return the tables with these in place of the given ones.

    Tables of these names are replaced, so a run that failed is simply run again; they must
    not be the ones that ``tables`` reads. Rows without an order id share one bucket.
    """
    spark = tables.order_line.sparkSession
    _store(tables.order_header, header_table, "id", buckets, locations[0])
    _store(tables.order_line, line_table, "order_id", buckets, locations[1])
    return tables.replacing(order_header=spark.table(header_table), order_line=spark.table(line_table))
