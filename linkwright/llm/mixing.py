"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Each document has an exponential key -ln(u) / w: u in (0, 1) is fixed by its id, w is its
quality weight, so better documents tend to come first. A source's budget of words is met by
whole epochs over the source and then by a prefix of the source in key order; the last
document of the prefix is taken up to the budget.

The prefix sum never sorts a source. Keys fall into ``BUCKETS`` ranges, sizes are summed per
source and range (combined before the shuffle), and only the one range in which a source's
budget ends is sorted. The prefix over ranges has at most ``BUCKETS`` rows per source, the
division of the targets one row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linkwright.llm.common import stage, word_count

BUCKETS = 4096
SYMBOLS = r"[^#*$%&|<>]+"


def quality_weight(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: falls with the signs ``#*$%&|<>`` per word."""
    signs = F.coalesce(F.length(F.regexp_replace(text, SYMBOLS, "")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(4.0) * signs / (size + 1))


def exponential_key(id_col: Column, weight: Column) -> Column:
    """-ln(u) / weight, with u from the first 52 bits of the id's MD5."""
    head = F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10)
    return -F.log((head.cast("double") + 0.5) / float(1 << 52)) / weight


def water_fill(sources: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """Targets of ``sources`` (source, source_size): ``(source, source_size, target)``.

    Sources by code point (NULL last) take the weights in turn and share the sum of all sizes;
    no target is above ``cap`` times its source, and the excess is shared again by weight.
    Filling by rising cap per weight reaches the end state at once: a source is capped as
    long as the level of those not capped yet reaches its cap.
    """
    turn = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    s = (sources.withColumn("weight", F.get(cycle, (F.row_number().over(turn) - 1) % len(weights)))
         .withColumn("most", F.lit(cap) * F.col("source_size"))
         .withColumn("level", F.col("most") / F.col("weight")))
    before = W.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    s = (s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
         .withColumn("share", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("level", F.max(F.col("left") / F.col("share")).over(everything)))
    return s.select("source", "source_size",
                    F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (5, 2, 1), cap: int = 3, quality: Column | None = None) -> DataFrame:
    """Words taken of each document: ``(doc_id, source, size, source_size, target, taken)``, one row per input row.

    ``size`` is the number of words (NULL text: 0), ``taken`` counts repeats. A source's taken
    words are its target rounded to a word. NULL is a source of its own, the last. A source
    without words has target 0; wordless documents are taken 0 times. Equal rows and equal keys
    are ordered by id and size, so reruns agree. ``quality`` (a column of ``docs``, positive)
    replaces :func:`quality_weight`. An empty table gives an empty result.
    """
    size = word_count(F.col(text_col))
    weight = quality if quality is not None else quality_weight(F.col(text_col), size)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       size.alias("size"), exponential_key(F.col(id_col), weight).alias("key"))
    rows = stage(rows.withColumn("bucket", F.floor(F.lit(BUCKETS) * F.col("key") / (1 + F.col("key"))).cast("int")),
                 "mixing-keys")

    ranges = stage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mixing-ranges")
    targets = water_fill(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    plan = (targets.withColumn("_words", F.round("target").cast("long"))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("_words") / F.col("source_size")))
                        .otherwise(0).cast("long"))
            .withColumn("rest", F.col("_words") - F.col("epochs") * F.col("source_size")))
    upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    cuts = (ranges.withColumn("upto", F.sum("words").over(upto))
            .join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
            .where(F.col("upto") > F.col("rest"))
            .groupBy("_source").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("start")),
                                             "bucket").alias("cut")))
    plan = stage(plan.withColumnRenamed("source", "_source").alias("p").join(
        cuts.withColumnRenamed("_source", "_cut"), F.col("_source").eqNullSafe(F.col("_cut")), "left")
        .select("_source", "source_size", "target", "epochs", "rest",
                F.col("cut.bucket").alias("cut"), F.col("cut.start").alias("start")), "mixing-plan")

    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    out = ["doc_id", "source", "size", "source_size", "target"]
    whole = joined.where("cut is null or bucket <> cut").select(
        *out, (F.col("epochs") * F.col("size")
               + F.when(F.col("bucket") < F.col("cut"), F.col("size")).otherwise(0)).alias("taken"))
    order = W.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("size").over(order), F.lit(0))
    part = joined.where("bucket = cut").select(
        *out, (F.col("epochs") * F.col("size")
               + F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))).alias("taken"))
    return whole.unionByName(part)
