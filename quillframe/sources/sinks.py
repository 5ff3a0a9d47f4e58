"""Writers: headerless CSV, text, files of bounded length, compaction, bucketed layout."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillframe.session import reliable, scratch_path


def write_csv_plain(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with neither header nor row labels."""
    df.write.option("header", False).option("sep", sep).csv(path)


def write_text(df: DataFrame, path: str) -> None:
    df.write.option("lineSep", "\n").text(path)


def write_split(df: DataFrame, path: str, rows: int) -> None:
    """No output file holds more than ``rows`` rows."""
    df.write.option("maxRecordsPerFile", rows).parquet(path)


def compact(df: DataFrame, path: str, key: str, rows_per_file: int, compression: str = "zstd") -> None:
    """Merge small files into one folder per key with files of about ``rows_per_file`` rows.

    A large key is spread over as many tasks as it needs files, a small one stays in one. The rows are written once
    before they are numbered: a task that runs again must deal them out as before.
    """
    df = reliable(df)
    sizes = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    placed = df.withColumn("_row", F.monotonically_increasing_id())  # by position: copies spread as well
    sizes = sizes.withColumnRenamed(key, "_key")
    salted = placed.join(sizes, placed[key].eqNullSafe(sizes["_key"])).drop("_key").withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_files")))
    (salted.repartition(key, "_salt").drop("_row", "_files", "_salt")
     .write.partitionBy(key).option("compression", compression).parquet(path))


def pack_files(listing: DataFrame, target: int) -> DataFrame:
    """(file, size, group, bin): small files of each group put together so that no bin passes ``target`` bytes.

    Files up to half the target are taken in the order of a hash and their names; the bin is the number of half targets before
    a file's start, so a bin holds half a target and the rest of its last file at most. A larger file has a bin of its own.
    Sizes are added up per hash first, so the files of one group, however many, are not summed in one task.
    """
    half = max(1, target // 2)
    rows = listing.select("file", "size", "group").withColumn("stretch", F.pmod(F.xxhash64("file"), F.lit(64)))
    small = rows.where(F.col("size") <= half)
    sums = small.groupBy("group", "stretch").agg(F.sum("size").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("group").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(F.col("group").alias("_group"), F.col("stretch").alias("_stretch"), before.alias("_before"))
    inside = F.sum("size").over(Window.partitionBy("group", "stretch").orderBy("file").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = small.withColumn("_inside", inside).join(offsets, F.col("group").eqNullSafe(F.col("_group")) & (F.col("stretch") == F.col("_stretch")))
    packed = placed.select("file", "size", "group", F.floor((F.col("_before") + F.col("_inside")) / half).cast("string").alias("bin"))
    return packed.unionByName(rows.where(F.col("size") > half).select("file", "size", "group", F.md5("file").alias("bin")))


def compact_lines(spark: SparkSession, source: str, out: str, group: str, target: int = 1 << 30) -> DataFrame:
    """Merge the text files below ``source`` into files of at most ``target`` bytes (and a line), one folder per group.

    ``group`` is a pattern whose first bracket names the group in a file's path, such as its date; files it does not find go to
    ``other``. What goes together is decided by the listing alone; a file above half the target is cut where its bytes reach
    half targets, which a recomputed task finds at the same places. Returns the plan: file, size, group, bin.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", F.col("length").alias("size"))
    name = F.regexp_extract("path", group, 1)
    listing = found.where("size > 0").select(F.col("path").alias("file"), "size", F.when(name == "", "other").otherwise(name).alias("group"))
    plan_path = scratch_path(spark, "packed")
    pack_files(listing, target).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    half = max(1, target // 2)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done = None, 0
        for batch in batches:
            paths, starts = batch.column("path").to_pylist(), batch.column("at").to_pylist()
            sizes = pc.binary_length(batch.column("value").cast(pa.binary())).to_pylist()
            pieces = []
            for path, at, size in zip(paths, starts, sizes):
                if (path, at) != block:
                    block, done = (path, at), 0
                pieces.append((at + done) // half)
                done += size + 1
            yield pa.RecordBatch.from_arrays([batch.column("value"), batch.column("path"), pa.array(pieces, pa.int64())], names=["value", "path", "piece"])

    lines = spark.read.option("recursiveFileLookup", "true").text(source).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    keyed = plan.select(F.col("file").alias("_file"), "group", "bin", (F.col("size") > half).alias("_large"))
    part = F.when(F.col("_large"), F.concat_ws("-", "bin", "piece")).otherwise(F.col("bin"))
    joined = lines.mapInArrow(cut, "value string, path string, piece bigint").join(keyed, F.col("path") == F.col("_file")).select("value", "group", part.alias("part"))
    joined.repartition("group", "part").sortWithinPartitions("group", "part").write.partitionBy("group", "part").text(out)
    return plan


def buckets_for(df: DataFrame, least: int, rows: int = 1_000_000) -> int:
    """Buckets of about ``rows`` rows, ``least`` of them at least: what a task sorts does not grow with the table."""
    return max(least, -(-df.count() // rows))


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, sort: list[str] | None = None,
                   rows_per_file: int = 10_000_000) -> None:
    """Table co-located on ``key`` and sorted inside its files, so joins on the key need no shuffle.

    A bucket with more rows than fit one file is written by as many tasks as it needs files. The rows are written once
    before they are numbered, as in ``compact``.
    """
    df = reliable(df)
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # the rule bucketed tables use
    tagged = df.withColumn("_bucket", bucket).withColumn("_row", F.monotonically_increasing_id())
    sizes = tagged.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_files"))
    salted = (tagged.join(F.broadcast(sizes), "_bucket")  # one row per bucket
              .withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_files"))))
    (salted.repartition(buckets, "_bucket", "_salt").select(*df.columns).write.bucketBy(buckets, key)
     .sortBy(*(sort or [key])).option("path", path).mode("overwrite").saveAsTable(table))
