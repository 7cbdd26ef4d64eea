"""Mixing sources to target weights by capped water-filling.

Every source gets its weight's share of all words. Targets stop at ``max_epochs`` times the source's
words; what they leave is shared among the others by weight, again and again until no target is above
its cap. Each round raises one number, the words per unit of weight; rounds are one aggregation over
the table of sources, and every round but the last caps another source.

A target of f times a source's words takes every document floor(f) times, and the documents of a seeded
hash order once more until the fraction is reached. The place in that order where the words suffice is
found by counting words in ``BUCKETS`` hash ranges per source, then again within the range where the
fraction falls: sums per (source, range), so a source that holds a third of all rows is no larger a
group than any other. Documents are taken whole. Long, middling and short documents are taken one class
after the other, and each makes up for what the longer ones took too much or too little, so that the
words taken miss the target by half a short document, or half of what 1 / BUCKETS**2 of the source holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.keys import apart, number_rows
from rowloom.session import materialize

BUCKETS = 512
# size classes, largest first, as multiples of the source's mean size; what a class misses is left to the next
CLASSES = (2.0, 0.5, 0.0)


def n_words(text: Column) -> Column:
    """Words without ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0))).cast("bigint"), F.lit(0).cast("bigint"))


def fill_targets(sources: DataFrame, max_epochs: float) -> DataFrame:
    """``target`` of each row of (source_size, weight): the capped share of all sizes."""
    cap = F.col("source_size") * float(max_epochs)
    capped, known = -1, 0.0
    while True:
        full = F.col("weight") * F.lit(known) >= cap
        now = sources.agg(
            F.count(F.when(full, 1)).alias("capped"), F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"), F.sum("source_size").alias("total"),
        ).first()
        if now.capped == capped or now.open == 0 or not now.total:
            break
        capped, known = now.capped, (now.total - now.held) / now.open
    level = F.col("weight") * F.lit(known)
    return sources.withColumn("target", F.when(level >= cap, cap).otherwise(level))


def mix(
    docs: DataFrame, source: str = "source", text: str = "text", weights: tuple[float, ...] = (1.0, 2.0, 3.0), max_epochs: float = 3.0,
    seed: int = 7, keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``source``, ``size``, ``source_size``, ``target`` and ``copies``.

    Sources sort by code point, null last as a source of its own, and weigh ``weights`` in turn. ``copies``
    is how often the mix takes the document: at most ``max_epochs`` times, 0 included. Empty and null texts
    have size 0 and are taken like the others. Rows that are alike in every way are numbered, so that each has
    a place of its own; which of them has which number does not matter.
    """
    columns = keep if keep is not None else docs.columns
    alike = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns if docs.schema[c].dataType.typeName() != "map"], F.col(f"`{text}`"))
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{source}`").cast("string").alias("source"), n_words(F.col(f"`{text}`")).alias("size"), alike.alias("alike"))
    sized = _apart(materialize(sized, "mix-sizes"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    sources = number_rows(sources, "rank", [F.col("source").asc_nulls_last()], start=0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    sources = materialize(sources.select("source", "source_size", "n_rows", weight.alias("weight")), "mix-sources")
    targets = fill_targets(sources, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = targets.select(F.col("source").alias("s"), "source_size", "target", "n_rows", F.floor(rate).cast("int").alias("whole"), (rate - F.floor(rate)).alias("share"), F.lit(0.0).alias("carry"))
    for i in range(len(CLASSES)):
        plan = materialize(_limit(sized, plan, i), "mix-plan")
    limit = F.element_at(F.array(*[F.col(f"limit_{i}") for i in range(len(CLASSES))]), _size_class() + 1)
    copies = F.col("whole") + F.when(F.col("place") < limit, 1).otherwise(0)
    return sized.join(plan, sized["source"].eqNullSafe(plan["s"])).select("row", "source", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def _apart(sized: DataFrame) -> DataFrame:
    """Rows with their place in the order; rows that are alike, if there are any, get places apart."""
    places = F.lit(BUCKETS * BUCKETS)
    again = sized.groupBy("alike").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("alike").alias("a"))
    again = materialize(again, "mix-alike")
    single = sized.withColumn("place", F.pmod("alike", places)).drop("alike")
    if again.isEmpty():
        return single
    same = sized["alike"] == again["a"]
    single = sized.join(again, same, "left_anti").withColumn("place", F.pmod("alike", places)).drop("alike")
    numbered = number_rows(sized.join(again, same, "left_semi"), "copy", ["alike"], ["alike"])
    numbered = numbered.withColumn("place", F.pmod(F.xxhash64("alike", "copy"), places)).drop("alike", "copy")
    return materialize(single.unionByName(numbered), "mix-places")


def _size_class() -> Column:
    """Number of the first of ``CLASSES`` times the source's mean size that the size reaches."""
    column = F.lit(len(CLASSES) - 1)
    for i in range(len(CLASSES) - 2, -1, -1):
        column = F.when(F.col("size") * F.col("n_rows") >= F.col("source_size") * CLASSES[i], i).otherwise(column)
    return column


def _limit(sized: DataFrame, plan: DataFrame, number: int) -> DataFrame:
    """The plan with ``limit_<number>``, the place up to which documents of a size class are taken once more.

    ``carry`` brings the words that larger classes took too few, and takes along what this one does.
    """
    members = sized.join(plan.select(F.col("s").alias("p"), "source_size", "n_rows"), sized["source"].eqNullSafe(F.col("p"))).filter(_size_class() == number)
    words = members.groupBy("source", F.floor(F.col("place") / BUCKETS).alias("bucket")).agg(F.sum("size").alias("words"))
    total = words.groupBy(F.col("source").alias("t")).agg(F.sum("words").alias("all"))
    wanted = F.col("share") * F.coalesce("all", F.lit(0)) + F.col("carry")
    plan = plan.join(total, plan["s"].eqNullSafe(total["t"]), "left").withColumn("wanted", wanted)
    plan = plan.withColumn("need", F.greatest(F.lit(0.0), F.least(F.col("wanted"), F.coalesce("all", F.lit(0)).cast("double")))).drop("t", "all")
    coarse = _crossing(words, plan)
    inside = members.join(coarse.select(F.col("s").alias("c"), "bucket"), members["source"].eqNullSafe(apart("c")) & (F.floor(F.col("place") / BUCKETS) == F.col("bucket")))
    fine = inside.groupBy("source", F.pmod("place", F.lit(BUCKETS)).alias("bucket")).agg(F.sum("size").alias("words"))
    fine = _crossing(fine, coarse.select("s", F.col("rest").alias("need"), F.col("bucket").alias("upper")), "upper")
    more = F.col("rest") * 2 >= F.col("words")
    fine = fine.select(F.col("s").alias("f"), (F.col("upper") * BUCKETS + F.col("bucket") + more.cast("int")).alias("limit"), (F.col("rest") - F.when(more, F.col("words")).otherwise(0)).alias("short"))
    plan = plan.join(fine, plan["s"].eqNullSafe(fine["f"]), "left")
    carry = F.col("wanted") - F.col("need") + F.coalesce("short", F.lit(0.0))
    return plan.withColumns({"carry": carry, f"limit_{number}": F.coalesce("limit", F.lit(0))}).drop("wanted", "need", "f", "limit", "short")


def _crossing(words: DataFrame, plan: DataFrame, *more: str) -> DataFrame:
    """For each source the bucket in which the running sum of words passes ``need``, and the ``rest`` needed from it."""
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows per source at most
    running = words.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0)))
    joined = running.join(plan.select("s", "need", *more), running["source"].eqNullSafe(F.col("s")))
    crosses = (F.col("need") > 0) & (F.col("before") < F.col("need")) & (F.col("need") <= F.col("before") + F.col("words"))
    return joined.filter(crosses).select("s", *more, "bucket", "words", (F.col("need") - F.col("before")).alias("rest"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered from 1 in ``repetition``; then the columns of ``docs``.

    A column of ``docs`` that is called ``repetition`` gives way to the number.
    """
    taken = mix(docs, **options).filter(F.col("copies") > 0)
    repeated = taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("repetition"))
    return repeated.select("repetition", *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "repetition"])
