"""Mixing sources to target weights by entropy balancing, in column expressions only.

Every document gets a rate, the expected number of its copies. Among all rates that give each source its target of
words, entropy balancing takes those closest to 1 in relative entropy. Their form is known: ``exp(lambda * x)``, cut at
``most``, where x is the document's size over the source's mean size and lambda the source's dual variable. Newton
iterations on the convex dual find lambda: each is one aggregation over the table of (source, size, documents), in which
documents of equal rate are one row, so it stays small however many rows a source has. A bracket is kept beside
the iterate, and a step that leaves it is replaced by its middle, so the iteration can't diverge.

Rates become copies without randomness: whole copies are dealt to the (source, size) classes by running totals, which
keeps the error of a source below half of its longest document, and passes over ever smaller classes take up what is
left. Within a class, the documents that get one copy more are those that come first by hash of the id; the rank is
found from counts per hash bucket and a rank within the bucket, so a class with a third of all rows is dealt in buckets
of bounded size.

Defined results: a null text has size 0, is taken 0 times its size, and has one copy or none like others of size 0; a
null source is a source, last in order; repeated rows are dealt copies one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltworks.llm.words import word_count
from siltworks.session import stored

MOST = 3
#: Steps after which an open gap raises; halving the bracket alone needs some seventy.
NEWTON_STEPS = 200
REPAIRS = 6
#: Documents of one class that are ranked in one task.
RANKED = 20_000


def targets(sizes: DataFrame, weights: Sequence[int], most: int = MOST) -> DataFrame:
    """Target words of each source: shares by weight of all words, none above ``most`` times the source's own.

    ``sizes`` has ``_source`` and ``source_size``, one row each. Sources take the weights in turn, by code point with
    null last. With the sources in order of ``most * size / weight``, those that are cut come first; the level that
    the others share is what is left over the sum of their weights, and the first source not above it ends the cut.
    """
    everything = Window.orderBy(F.col("_source").asc_nulls_last())
    turn = (F.row_number().over(everything) - 1) % len(weights)
    rows = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("double"))
    rows = rows.withColumn("_cap", (most * F.col("source_size")).cast("double"))
    order = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rows = rows.withColumn("_level", left / F.sum("_weight").over(rest))
    # The level falls at each uncut source that is passed, so the first such source has the right one.
    open_level = F.when(F.col("_cap") / F.col("_weight") >= F.col("_level"), F.col("_level"))
    level = F.first(open_level, ignorenulls=True).over(every)
    return rows.select(
        "_source", "source_size", F.least("_cap", F.coalesce(F.col("_weight") * level, F.col("_cap"))).alias("target")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def balance(classes: DataFrame, goal: DataFrame, most: int = MOST, steps: int = NEWTON_STEPS) -> DataFrame:
    """Adds ``rate`` to classes of ``_source``, ``size``, ``n``; ``goal`` has ``_source``, ``source_size``, ``target``.

    Each step is one distributed aggregation of the dual's first and second derivative per source. The state, one row
    per source, is written to the shared folder after each step, so lineage stays short. Sources whose target is all
    that they may give, or their size, need no step. Steps end when every gap is closed or its bracket is as narrow as numbers are.
    """
    mean = classes.groupBy("_source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("_mean"))
    state = goal.withColumnRenamed("_source", "_of").join(mean, _same("_of", "_source")).drop("_source")
    low = F.log(F.greatest(F.col("target"), F.lit(1e-9)) / F.greatest(F.col("source_size"), F.lit(1)))
    # At lambda = 0 every rate is 1; the bracket holds the root on the side the target asks for.
    more = F.col("target") >= F.col("source_size")
    # With all that a source may give, every document with words is taken as often as it may be.
    full = F.col("target") >= most * F.col("source_size") * (1 - 1e-12)
    state = state.select(
        "_of", "target", F.greatest("_mean", F.lit(1e-9)).alias("_mean"), F.when(full, 1e9).otherwise(0.0).alias("_lambda"), full.alias("_full"),
        F.when(more, 0.0).otherwise(4 * low - 64.0).alias("_low"), F.when(more, 4 * F.abs(low) + 64.0).otherwise(0.0).alias("_high"),
    )
    state = stored(state, "dual")
    x = F.col("size") / F.col("_mean")
    exponent = F.least(F.col("_lambda") * x, F.lit(709.0))
    rate = F.least(F.exp(exponent), F.lit(float(most)))
    for _ in range(steps):
        words_of = F.col("n") * F.col("size") * rate
        joined = classes.join(state, _same("_source", "_of"))
        slope = F.when(F.exp(exponent) < most, words_of * x).otherwise(0.0)
        sums = joined.groupBy("_source").agg(F.sum(words_of).alias("_f"), F.sum(slope).alias("_df"))
        state = state.join(sums, _same("_of", "_source")).drop("_source")
        gap = F.col("_f") - F.col("target")
        state = state.withColumns(
            {"_low": F.when(gap < 0, F.col("_lambda")).otherwise(F.col("_low")), "_high": F.when(gap > 0, F.col("_lambda")).otherwise(F.col("_high"))}
        )
        newton = F.col("_lambda") - gap / F.col("_df")
        inside = (F.col("_df") > 0) & (newton > F.col("_low")) & (newton < F.col("_high"))
        narrow = F.col("_high") - F.col("_low") <= 1e-14 * F.greatest(F.abs("_high"), F.abs("_low"))
        near = F.col("_full") | narrow | (F.abs(gap) <= 1e-9 * F.greatest(F.col("target"), F.lit(1.0)))
        step = F.when(near, F.col("_lambda")).when(inside, newton).otherwise((F.col("_low") + F.col("_high")) / 2)
        state = stored(state.select("_of", "target", "_mean", step.alias("_lambda"), "_full", "_low", "_high", near.alias("_near")), "dual")
        if state.filter(~F.col("_near")).isEmpty():
            break
        state = state.drop("_near")
    else:
        raise ArithmeticError(f"the dual has open gaps after {steps} steps")
    state = state.select("_of", "_mean", "_lambda", "target")
    return classes.join(state, _same("_source", "_of")).withColumn("rate", rate).drop("_of", "_mean", "_lambda")


def round_classes(rated: DataFrame, most: int = MOST, repairs: int = REPAIRS) -> DataFrame:
    """Whole copies ``copies`` for each class of ``_source``, ``size``, ``n``, ``rate``, ``target``.

    Running totals go from long to short documents. Each repair moves what is still missing or too much into the
    largest class that fits into it. A source has as many classes as it has different sizes, not rows.
    """
    down = Window.partitionBy("_source").orderBy(F.col("size").desc())
    running = F.round(F.sum(F.col("n") * F.col("rate")).over(down))
    before = F.coalesce(F.lag("_run").over(down), F.lit(0.0))
    rows = rated.withColumn("_run", running).withColumn("copies", (F.col("_run") - before).cast("long"))
    rows = rows.withColumn("copies", F.greatest(F.lit(0), F.least("copies", most * F.col("n"))).cast("long")).drop("_run")
    rows = stored(rows.select("_source", "size", "n", "target", "copies"), "classes")
    for _ in range(repairs):
        off = rows.groupBy("_source").agg((F.max("target") - F.sum(F.col("size") * F.col("copies"))).alias("_off"))
        off = off.withColumnRenamed("_source", "_of")
        room = F.when(F.col("_off") > 0, most * F.col("n") - F.col("copies")).otherwise(F.col("copies"))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("_off")) & (room > 0)
        many = F.least(room, F.floor(F.abs("_off") / F.col("size"))) * F.signum("_off")
        chosen = (
            rows.join(off, _same("_source", "_of"))
            .filter(fits)
            .groupBy("_of")
            .agg(F.max_by(F.struct(F.col("size").alias("_size"), many.cast("long").alias("_many")), "size").alias("_best"))
            .select("_of", "_best._size", "_best._many")
        )
        moved = F.coalesce(F.when(F.col("size") == F.col("_size"), F.col("_many")), F.lit(0))
        rows = rows.join(chosen, _same("_source", "_of"), "left").withColumn("copies", F.col("copies") + moved)
        rows = stored(rows.select("_source", "size", "n", "target", "copies"), "classes")
    return rows.drop("target")


def _ranked(sized: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """``sized`` with the copies of each document."""
    rows = sized.join(
        classes.withColumnsRenamed({"_source": "_of", "size": "_size"}), _same("_source", "_of") & (F.col("size") == F.col("_size"))
    ).drop("_of", "_size")
    extra = F.col("copies") % F.col("n")
    rows = rows.withColumn("_hash", F.xxhash64(F.col(key).cast("string"), "_same", F.lit("mix")))
    # The hash in order of buckets: those of a class divide the range evenly.
    share = (F.col("_hash").cast("double") / 2.0**64) + 0.5
    bucket = F.floor(share * F.ceil(F.col("n") / RANKED)).cast("long")
    rows = rows.withColumn("_bucket", F.greatest(F.lit(0), bucket))
    where = ["_source", "size", "_bucket"]
    in_order = Window.partitionBy("_source", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.filter(F.col("n") > RANKED).groupBy(*where).count()
    counted = counted.select(
        F.col("_source").alias("_of"), F.col("size").alias("_size"), F.col("_bucket").alias("_in"),
        F.coalesce(F.sum("count").over(in_order), F.lit(0)).alias("_before"),
    )
    rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*where).orderBy("_hash", key, "_same")))
    rows = rows.join(
        counted, _same("_source", "_of") & (F.col("size") == F.col("_size")) & (F.col("_bucket") == F.col("_in")), "left"
    )
    first = F.col("_rank") + F.coalesce("_before", F.lit(0)) <= extra
    each = F.floor(F.col("copies") / F.col("n")) + F.when(first, 1).otherwise(0)
    return rows.withColumn("_each", each.cast("long")).drop("_of", "_size", "_in", "_before", "_rank", "_bucket", "_hash")


def _planned(docs: DataFrame, weights: Sequence[int], key: str, source: str, text: str, most: int) -> DataFrame:
    """What ``plan_mix`` gives, with ``_same``, a hash of the text."""
    same = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    sized = docs.select(F.col(key), F.col(source).alias("_source"), word_count(text).alias("size"), same.alias("_same"))
    sized = stored(sized, "sizes")
    classes = stored(sized.groupBy("_source", "size").agg(F.count("*").alias("n")), "size-classes")
    per_source = classes.groupBy("_source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = stored(targets(per_source, weights, most), "targets")
    dealt = round_classes(balance(classes, goal, most), most)
    names = goal.withColumnRenamed("_source", "_of")
    rows = _ranked(sized, dealt, key).join(names, _same("_source", "_of"))
    return rows.select(key, "_same", "size", "source_size", "target", F.col("_each").alias("copies"))


def plan_mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    most: int = MOST,
) -> DataFrame:
    """One row per document: ``key``, ``size`` in words, ``source_size``, ``target`` of its source, and ``copies``.

    Starts jobs, which write small tables to the shared folder: the sizes, and one row per source and size.
    """
    return _planned(docs, weights, key, source, text, most).drop("_same")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixed corpus: each document as often as it has copies, with the columns of the input.

    A document is known by key and text, so texts that share a key have copies of their own. Rows that repeat both, of one source
    or of several, all get the most copies that one of them has.
    """
    plan = _planned(docs, weights, key, source, text, MOST)
    copies = plan.groupBy(F.col(key).alias("_key"), "_same").agg(F.max("copies").alias("_copies")).filter("_copies > 0")
    own = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.join(copies, F.col(key).eqNullSafe(F.col("_key")) & (own == F.col("_same"))).drop("_key", "_same")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*docs.columns)
