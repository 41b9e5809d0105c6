"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key. The rows of a source are range-sorted by that
key over slices (equal ranges of the key space, as many as the rows ask for), so
that a source of any size is spread over many tasks; a running sum inside each
slice plus the slices' own totals gives each row the words before it, and the
source is cut at its exact budget. A budget above the source's size takes whole
epochs first and cuts the last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import text_hash, text_of, written

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words (runs of other than ASCII white space); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3) -> DataFrame:
    """Targets of a table (source, source_size) that has one row per source.

    Sources in code-point order, null last, take the weights in turn and divide
    ``share`` of all words by weight. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight until none is above.
    That fixed point is found in one pass: in the order of size over weight, the
    sources up to some place are at their limit, and all others get one rate."""
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = sizes.withColumn("weight", F.element_at(cycle, (place % len(weights) + 1).cast("int")).cast("long"))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.sum("source_size").over(all_rows)
    total = total if share == 1.0 else F.floor(total * share)
    ranked = (weighed.withColumn("_total", total)
              .withColumn("_capped", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
              .withColumn("_weights", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("_place", F.row_number().over(order)))
    free = (F.col("_total") - F.col("_capped")) * F.col("weight") <= F.col("source_size") * most * F.col("_weights")
    first = F.min(F.when(free, F.struct("_place", (F.col("_total") - F.col("_capped")).alias("left"), F.col("_weights").alias("by")))).over(all_rows)
    ranked = ranked.withColumn("_rate", first)
    open_target = (F.col("_rate.left") * F.col("weight")).cast("double") / F.col("_rate.by").cast("double")
    target = F.when(F.col("_place") < F.coalesce(F.col("_rate._place"), F.lit(1 << 30)), (F.col("source_size") * most).cast("double")).otherwise(open_target)
    return ranked.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """Hash-random key: hex text, from the id (from the text if it is null)."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), text_of(text)))))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: str = "mix",
                slice_rows: int = 20_000, columns: tuple[str, ...] = ()) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, text_hash, source, size, source_size, target and taken (plus
    ``columns`` of the input), one row per input row. ``taken`` counts repeats:
    whole epochs times the size, plus the part before the cut of the last epoch.
    Each source's taken words add up to its target rounded down. Null texts have
    no words, null sources are one source, repeated rows are rows of their own
    (they share a key, and their order doesn't matter), an empty table gives no
    rows; other columns are ignored. Reruns agree: keys depend on rows only."""
    key = random_key(F.col("doc_id"), F.col("text"), seed)
    rows = written(docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), "source", n_words(F.col("text")).alias("size"), key.alias("_key"), *columns))
    # One count sets the number of slices; it changes the plan's width, not its result.
    slices = max(1, rows.count() // slice_rows)
    place = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * slices / F.lit(1 << 32)).cast("int")
    rows = rows.withColumn("_slice", place)
    slice_sizes = written(rows.groupBy("source", "_slice").agg(F.sum("size").alias("_words")))
    targets = source_targets(slice_sizes.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, share, most)
    earlier = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slice_sizes.select("source", "_slice", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_offset"))
    plan = offsets.join(targets.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    plan = plan.select(F.col("source").alias("_source"), F.col("_slice").alias("_of"), "_offset", "source_size", "target")
    inside = Window.partitionBy("source", "_slice").orderBy("_key", "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = summed.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_slice") == F.col("_of")))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size") - F.col("_offset") - F.col("_before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return joined.select("doc_id", "text_hash", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *columns)
