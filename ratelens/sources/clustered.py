"""Stored tables laid out for what is asked of them: lookups by key, and joins by key.

``write_lookup`` sorts by the key and adds Bloom filters, so that one key, text or number, is found in
few row groups. ``write_bucketed`` deals the rows into buckets by the key, so that tables dealt alike
are joined bucket by bucket, without an exchange.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.functions.convert import ref
from ratelens.sources.publish import publish, read_note, settle, write_note

BUCKETS = "_buckets.json"


def write_lookup(df: DataFrame, path: str, key: str, keys_a_file: int = 1_000_000,
                 row_group_bytes: int = 16 << 20) -> None:
    """Parquet sorted by the key, with a Bloom filter of the key for each row group.

    Row groups far from the key are passed over by their ends, those that only enclose it by the
    filter. ``keys_a_file`` sizes the filters: about a byte and a half a key. Rows that share a key
    of their own may lie in several files: the sort spreads a hot key by the partition it comes from.
    """
    placed = df.repartitionByRange(ref(key), F.spark_partition_id()).sortWithinPartitions(ref(key))
    publish(df.sparkSession, lambda place: placed.write.options(**{
        f"parquet.bloom.filter.enabled#{key}": "true", f"parquet.bloom.filter.expected.ndv#{key}": str(keys_a_file),
        "parquet.block.size": str(row_group_bytes)}).parquet(place), path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Parquet in ``buckets`` buckets by the key, each sorted by it.

    For aggregates, which have a key once or a few times; a key's rows are all in one bucket. Tables
    to be joined need the same number of buckets and the same type of key.
    """
    spark = df.sparkSession
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def write(place: str) -> None:
        name = f"bucketed_{uuid.uuid4().hex}"
        dealt = df.repartition(buckets, ref(key))
        dealt.write.bucketBy(buckets, key).sortBy(key).option("path", place).saveAsTable(name)
        spark.sql(f"drop table {name}")                          # its files stay: it is external
        write_note(spark, place, BUCKETS, json.dumps({"key": key, "buckets": buckets, "schema": schema}))
    publish(spark, write, path)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed`` that Spark knows to be dealt into buckets.

    Only tables of a catalogue have buckets, so the folder is named in the session's catalogue.
    """
    settle(spark, path)
    note = json.loads(read_note(spark, path, BUCKETS))
    name, key = f"bucketed_{uuid.uuid4().hex}", note["key"]
    place = path.replace("'", "\\'")
    spark.sql(f"create table {name} ({note['schema']}) using parquet clustered by (`{key}`) sorted by (`{key}`) "
              f"into {note['buckets']} buckets location '{place}'")
    return spark.table(name)
