"""Rows of one split with a near duplicate in another: word shingles of texts, directions of vectors.

Equal sets and equal vectors are put together before anything is compared, and the question is only whether a row has some
partner in a split, so a family of copies never meets itself pair by pair: each member first meets one hub per band, bucket
and split, and only what no hub confirms meets the rest of its buckets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillframe.operators import neighbours
from quillframe.session import scratch_path

#: At a similarity of 0.8 a pair shares no band of 3 extremes out of 24 with a chance of 4e-8.
BANDS, BAND_ROWS = 24, 3


def _bound(c: Column, f) -> Column:
    """f of a column that is computed once, although f names it for every element of an array."""
    return F.transform(F.array(c), f)[0]


def shingles(text: Column, words: int = 5) -> Column:
    """Sorted distinct 64-bit hashes of runs of ``words`` words (a-z, 0-9, case ignored); a shorter text is one run."""
    found = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")
    runs = _bound(found, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - words + 1, F.lit(1))),
                                               lambda i: F.when(F.size(w) > 0, F.xxhash64(F.array_join(F.slice(w, i, words), " ")))))
    return F.nullif(F.array_sort(F.array_distinct(F.array_compact(runs))), F.array().cast("array<bigint>"))


def band_hashes(hashes: Column) -> Column:
    """One number per band from the smallest and largest values of the set under BANDS * BAND_ROWS / 2 hash functions."""
    def extremes(seed: Column) -> Column:
        return _bound(F.transform(hashes, lambda h: F.xxhash64(h, seed)), lambda m: F.array(F.array_min(m), F.array_max(m)))

    low = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(BANDS * BAND_ROWS // 2)), extremes))
    return _bound(low, lambda m: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice(m, b * BAND_ROWS + 1, F.lit(BAND_ROWS)))))


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The (key, part, other) of pairs (key, part, other, near) whose full sets are similar enough; each two sets meet once."""
    pairs = pairs.withColumn("low", F.least("key", "near")).withColumn("high", F.greatest("key", "near"))
    checked = (pairs.select("low", "high").distinct()
               .join(sets.select(F.col("key").alias("low"), F.col("hashes").alias("_a")), "low")
               .join(sets.select(F.col("key").alias("high"), F.col("hashes").alias("_b")), "high"))
    common = F.size(F.array_intersect("_a", "_b"))
    close = checked.where(common >= threshold * (F.size("_a") + F.size("_b") - common) - 1e-9).select("low", "high")
    return pairs.join(close, ["low", "high"]).select("key", "part", "other").distinct()


def _sketched(text: Column, words: int) -> Column:
    """Key, size and bands of a text's shingle set, null without words."""
    return _bound(shingles(text, words), lambda h: F.when(h.isNotNull(), F.struct(
        F.xxhash64(h).alias("key"), F.size(h).alias("size"), band_hashes(h).alias("bands"))))


def near_texts(df: DataFrame, part: str, text: str, threshold: float = 0.8, words: int = 5) -> DataFrame:
    """(part, other, rows): rows of ``part`` with a text in ``other`` whose shingle sets have this Jaccard similarity or more.

    Rows without a part, and texts that are null or hold no word, are near to nothing; repeated rows all count. Candidates
    share a band of extremes (at lower thresholds than 0.8 more pairs escape all bands); the full sets decide. What is
    dealt out is a key, a size and the bands of each set; the sets are larger than their texts, so those that share a band
    with another set of another split are made again from one text each, and no others.
    """
    texts = df.where(F.col(part).isNotNull()).select(F.col(part).alias("part"), F.col(text).alias("text"), F.unhex(F.md5(text)).alias("source"))
    rows = _kept(texts.select("part", "source", _sketched(F.col("text"), words).alias("set")), "rows").where("set IS NOT NULL").select("part", "source", "set.*")
    members = _kept(rows.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.min("source").alias("source"),
                                                    F.first("bands").alias("bands")), "parts")
    counted = members.select("key", "part", "n")
    parts = counted.groupBy("key").agg(F.collect_set("part").alias("parts"))  # one entry per split
    same = counted.join(parts, "key").select("key", "part", F.explode("parts").alias("other")).where("part <> other")
    placed = members.select("key", "part", "size", F.explode("bands").alias("bucket"))
    # Only buckets that hold different sets and different splits have pairs.
    mixed = placed.groupBy("bucket").agg(*(f(c).alias(f"{n}_{c}") for c in ("part", "key") for n, f in (("min", F.min), ("max", F.max))))
    mixed = mixed.where("min_part <> max_part AND min_key <> max_key").select("bucket")
    banded = _kept(placed.join(mixed, "bucket"), "bands")
    wanted = members.join(banded.select("key").distinct(), "key").groupBy("key").agg(F.min("source").alias("source"))
    # Copies of a text become one in each task before they are dealt out.
    once = texts.groupBy("source").agg(F.first("text").alias("text"))
    sets = _kept(once.join(wanted, "source").select("key", shingles(F.col("text"), words).alias("hashes")), "sets")
    hubs = banded.groupBy("bucket", F.col("part").alias("other")).agg(F.min(F.struct(F.col("key").alias("near"), F.col("size").alias("near_size"))).alias("hub"))
    comparable = (F.least("size", "near_size") >= threshold * F.greatest("size", "near_size") - 1e-9) & (F.col("key") != F.col("near"))
    met = (banded.join(hubs.select("bucket", "other", "hub.*"), "bucket").where(F.col("part") != F.col("other")))
    found = ["key", "part", "other"]
    tried = _kept(met.where(comparable).select(*found, "near").distinct().join(same, found, "left_anti"), "tried")
    sure = _kept(same.unionByName(_confirmed(tried, sets, threshold)), "sure")
    # What no hub confirmed meets the rest of its buckets.
    open_ = met.select(*found).distinct().join(sure, found, "left_anti")
    others = banded.select("bucket", F.col("part").alias("other"), F.col("key").alias("near"), F.col("size").alias("near_size"))
    left = (banded.join(open_, ["key", "part"]).join(others, ["bucket", "other"]).where(comparable).select(*found, "near").distinct()
            .join(tried, [*found, "near"], "left_anti"))
    return (sure.unionByName(_confirmed(left, sets, threshold)).distinct().join(counted, ["key", "part"])
            .groupBy(F.col("part").alias(part), "other").agg(F.sum("n").alias("rows")))


def near_vectors(df: DataFrame, part: str, vec: str, parts: list[str], cosine: float = 0.98, rows: int = 4096) -> DataFrame:
    """(part, other, rows): rows of ``part`` with a vector in ``other`` at this cosine or more; ``parts`` names the splits.

    Each split gets an index of cells, which the vectors of the other splits search within the one distance that the
    cosine allows. Null and zero vectors and those with null or non-finite elements are near to nothing.
    """
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = df.where(F.col(part).isNotNull() & finite).select(F.col(part).alias("part"), F.col(vec).cast("array<double>").alias("v"))
    # Both zeros are one number, so that equal vectors fall together.
    counted = usable.withColumn("v", F.transform("v", lambda x: x + 0.0)).groupBy("v", "part").agg(F.count(F.lit(1)).alias("n"))
    distinct = counted.groupBy("v").agg(F.collect_list(F.struct("part", "n")).alias("held"))  # one entry per split
    unit = neighbours.unit_vectors(distinct.withColumn("id", F.xxhash64("v")), "v")
    nodes = _kept(unit.select("id", "v", "held"), "nodes")
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    found = []
    for other in parts:
        here = F.exists("held", lambda h: h["part"] == other)
        away = F.exists("held", lambda h: h["part"] != other)
        index = neighbours.build_index(nodes.where(here), "id", "v", rows=rows)
        if index is not None:
            near = neighbours.search_index(index, nodes.where(away), "id", "v", 1, exclude_self=False, rows=rows, within=reach)
            found.append(near.select("id", F.lit(other).alias("other")))
    if not found:
        return df.sparkSession.createDataFrame([], f"{part} string, other string, rows bigint")
    held = nodes.select("id", F.explode("held").alias("h")).select("id", "h.part", "h.n")
    return (reduce(DataFrame.unionByName, found).join(held, "id").where(F.col("part") != F.col("other"))
            .groupBy(F.col("part").alias(part), "other").agg(F.sum("n").alias("rows")))
