"""Mixing sources to target weights by entropy balancing, with DataFrame
operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import WORD, discard, materialize, read

#: Of each source and size, so many parts are ranked apart.
SALTS = 64
#: Newton's iteration ends when no source misses its target by more words than this
#: or this share of it; most steps (each halves an interval at least).
WORDS, SHARE, STEPS = 0.5, 1e-9, 100
#: Longest step of a multiplier, which tilts the largest documents by e to it.
JUMP = 4.0


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``_rank``, from 0, by ``source`` in code point order, null last: counts of
    ranges are cumulated, and rows are ranked in their range."""
    by_name = F.col("source").asc_nulls_last()
    parts = materialize(sources.repartitionByRange(by_name).withColumn("_p", F.spark_partition_id()))
    counts = sorted(map(tuple, parts.groupBy("_p").count().collect()))  # a row a range
    before = {p: sum(n for _, n in counts[:i]) for i, (p, _) in enumerate(counts)}
    offset = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0), F.lit(0))
    rank = F.row_number().over(Window.partitionBy("_p").orderBy(by_name)) - 1 + F.element_at(offset, F.col("_p"))
    return parts.withColumn("_rank", rank).drop("_p")


def water_filled(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Adds ``target`` to a table with ``source`` and ``source_size``: ``share``
    of all sizes dealt by weight, with no target above ``most`` times its
    source; the excess goes to the others by weight until none is above."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked(sources).withColumn("_w", F.element_at(cycle, (F.col("_rank") % len(weights) + 1).cast("int")))
    weighed = materialize(weighed.withColumn("_cap", F.col("source_size") * float(most)).drop("_rank"))
    total = (weighed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # each round fills a source more, or is the last
        over = F.col("_cap") <= F.lit(level) * F.col("_w")
        left = weighed.agg(F.count_if(over), F.sum(F.when(over, F.col("_cap")).otherwise(0.0).cast("decimal(38,6)")).cast("double"), F.sum(F.when(over, 0.0).otherwise(F.col("_w")))).first()
        if left[0] == full or not left[2]:
            return weighed.withColumn("target", F.when(over, F.col("_cap")).otherwise(F.lit(level) * F.col("_w"))).drop("_w", "_cap")
        level, full = (total - left[1]) / left[2], left[0]


def tilts(groups: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """The sources with ``scale`` and ``tilt``: the rate of a document is
    exp(tilt * size / scale), ``most`` at most (see ``rate``).

    Balancing minimises the relative entropy of the documents' rates to 1,
    sum(rate * ln(rate) - rate + 1), subject to sum(size * rate) = target in each
    source and rate <= most. The convex dual in the multipliers has the gradient
    sum(size * rate) - target and the curvature sum(size * size / scale * rate)
    over rates below ``most``. Each step of Newton's iteration is one aggregation
    over the counts of documents by source and size; the root stays bracketed,
    and where a step leaves its bracket, that is halved. Sources without words
    have no tilt; full ones (target = most * size) have rate ``most``: null.
    """
    sized = materialize(groups.filter("size > 0").select("_s", "size", "_n"))
    of_source = sized.groupBy("_s").agg(F.max("size").cast("double").alias("scale"), F.sum((F.col("_n") * F.col("size")).cast("decimal(28,0)") * F.col("size")).cast("double").alias("_second"))
    start = F.log(F.col("target") / F.col("source_size")) * F.col("scale") * F.col("source_size") / F.col("_second")
    open_ = (F.col("source_size") > 0) & (F.col("target") > 0) & (F.col("target") < F.col("source_size") * float(most) * (1 - 1e-12))
    none = F.lit(None).cast("double")
    state = sources.join(of_source, "_s", "left").withColumn("tilt", F.when(open_, F.least(F.lit(JUMP), F.greatest(F.lit(-JUMP), start)))).drop("_second")
    state = materialize(state.withColumns({"_low": none, "_high": none, "_miss": none}))
    for _ in range(STEPS):
        each = sized.join(state.filter("tilt is not null").select("_s", "tilt", "scale"), "_s")
        free = F.exp(F.col("tilt") * F.col("size") / F.col("scale"))
        mass = F.col("_n") * F.col("size") * F.least(free, F.lit(float(most)))
        slope = F.when(free < most, mass * F.col("size") / F.col("scale")).otherwise(0.0)
        # Sums of decimals do not depend on the order of rows: reruns agree.
        exact = lambda x: F.sum(x.cast("decimal(38,6)")).cast("double")
        sums = each.groupBy("_s").agg(exact(mass).alias("_mass"), exact(slope).alias("_slope"))
        found = state.join(sums, "_s", "left").withColumn("_miss", F.col("_mass") - F.col("target"))
        found = found.withColumn("_low", F.when(F.col("_miss") < 0, F.col("tilt")).otherwise(F.col("_low"))).withColumn("_high", F.when(F.col("_miss") > 0, F.col("tilt")).otherwise(F.col("_high")))
        newton = F.col("tilt") - F.col("_miss") / F.col("_slope")
        bounded = F.least(F.col("tilt") + JUMP, F.greatest(F.col("tilt") - JUMP, F.coalesce(newton, F.col("tilt") - F.signum("_miss") * JUMP)))
        inside = (F.col("_low").isNull() | (bounded > F.col("_low"))) & (F.col("_high").isNull() | (bounded < F.col("_high")))
        done = F.abs("_miss") <= F.greatest(F.lit(WORDS), F.col("target") * SHARE)
        next_ = F.when(done, F.col("tilt")).when(inside, bounded).otherwise((F.col("_low") + F.col("_high")) / 2)
        last, state = state, materialize(found.withColumn("_done", F.coalesce(done, F.lit(True))).withColumn("tilt", next_).drop("_mass", "_slope"))
        discard(last)
        if not state.filter("not _done").take(1):
            break
        last, state = state, state.drop("_done")
        state.written_to = last.written_to
    return state.drop("_low", "_high", "_miss", "_done")


def rate(size: Column, source_size: Column, target: Column, scale: Column, tilt: Column, most: float) -> Column:
    """The tilted rate of a document; 0 where its source has no target."""
    tilted = F.least(F.exp(tilt * size / scale), F.lit(float(most)))
    return F.when((target <= 0) | (source_size <= 0), 0.0).when(tilt.isNull(), float(most)).otherwise(tilted)


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.0,
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, ``source``, ``size`` (words), ``source_size``,
    ``target`` (of its source), ``rate`` (the tilted rate), ``copies``, ``taken``.

    Sources in code point order (null last) take the weights in turn. Rates
    come from the entropy balance (see ``tilts``): where a source is to grow, its
    larger documents grow more, up to ``most``. Rounding to copies is exact to
    the size of one small document a source: each group of equal sizes in a
    source gets a whole number of copies (its cumulative rate rounded), and the
    words then missing or over are made up from the source's smallest documents. Which
    documents of such a group get the extra copy goes by a hash of the id, so
    reruns agree. A copy count never exceeds ``most``.

    A hot source or size is no single task: counts are taken by (source, size,
    salt), and only these counts are cumulated by source; documents are ranked
    within one salt. Empty and null texts have size 0 and one copy, taking
    nothing; repeated and null ids are ranked like others.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    id_ = F.col(id_col).cast("long")
    rows = materialize(docs.select(id_.alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"), F.xxhash64(id_, F.lit(7)).alias("_h")))
    rows = rows.withColumn("_salt", F.pmod("_h", F.lit(SALTS))).withColumn("_s", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))

    cells = rows.groupBy("_s", "source", "size", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    cells = materialize(cells)
    groups = cells.groupBy("_s", "source", "size").agg(F.sum("_n").alias("_n"))
    sources = groups.groupBy("_s", "source").agg(F.sum(F.col("_n") * F.col("size")).alias("source_size"))
    sources = tilts(groups, water_filled(sources, weights, share, most), most)
    of_size = rate(F.col("size"), F.col("source_size"), F.col("target"), F.col("scale"), F.col("tilt"), most)

    tilted = groups.join(sources.drop("source"), "_s").withColumn("rate", of_size).filter("size > 0")
    # 1. Largest sizes first: the cumulative rate, rounded, so that no group is off by more than half a copy.
    down = Window.partitionBy("_s").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.round(F.sum(F.col("_n") * F.col("rate")).over(down), 6)
    most_copies = (F.floor(F.lit(float(most))) * F.col("_n")).cast("long")
    tilted = tilted.withColumn("_upto", F.floor(upto + 0.5)).withColumn(
        "_copies", F.least(most_copies, F.col("_upto") - F.coalesce(F.lag("_upto").over(Window.partitionBy("_s").orderBy(F.col("size").desc())), F.lit(0)))
    )
    # 2. The words still missing (or over) come from the smallest sizes.
    of_source = Window.partitionBy("_s")
    tilted = tilted.withColumn("_miss", F.col("target") - F.sum(F.col("_copies") * F.col("size")).over(of_source))
    room = F.when(F.col("_miss") >= 0, most_copies - F.col("_copies")).otherwise(F.col("_copies"))
    up = Window.partitionBy("_s").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.col("_room") * F.col("size")).over(up), F.lit(0))
    change = F.least(F.col("_room"), F.greatest(F.lit(0), F.round((F.abs("_miss") - used) / F.col("size")))).cast("long")
    tilted = tilted.withColumn("_room", room).withColumn("_copies", F.col("_copies") + F.signum("_miss").cast("long") * change)

    # Each document's rank in its group: the counts of the salts before, and its rank in its salt.
    salts = Window.partitionBy("_s", "size").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_n").over(salts), F.lit(0))).select("_s", "size", "_salt", "_before")
    plan = offsets.join(tilted.select("_s", "size", "_n", "_copies"), ["_s", "size"])
    in_salt = Window.partitionBy("_s", "size", "_salt").orderBy("_h", F.col("doc_id").asc_nulls_last())
    dealt = rows.withColumn("_rank", F.row_number().over(in_salt)).join(plan, ["_s", "size", "_salt"], "left")
    extra = F.when(F.col("_before") + F.col("_rank") <= F.col("_copies") % F.col("_n"), 1).otherwise(0)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("_copies") / F.col("_n")) + extra).cast("long")
    out = dealt.join(sources.drop("source"), "_s").withColumns({"rate": of_size, "copies": copies, "target": F.col("target").cast("double")})
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")
