"""Mixing sources to target weights by entropy balancing.

Each document gets the rate closest (in relative entropy to "once each", with a
ceiling) to its base such that every source's words meet their target. The
solution is an exponential tilt by document size,

    rate = limit * e^x / (limit - 1 + e^x),   x = lambda(source) * size / mean size,

with one multiplier per source that solves the convex dual. Newton steps,
kept inside a bracket, run as aggregates over counts by (source, size); their
sums are decimals, so reruns agree to the last digit. Rates are then rounded
into copies: within a source, sizes are walked from the largest down and what
rounding left over or took too much is passed on, so the words taken end within
about one small document of the target. Equal documents differ by one copy at
most; who gets the extra copy is decided by a hash.

Nothing is gathered but one row per (source, size): a source with a third of
all rows has no more of them than its longest document has words. A (source,
size) class of any number of rows is numbered in slices of ``SLICE`` rows.

Defined cases: NULL or empty texts have size 0, rate 1 and take no words; NULL
is a source of its own, the last; a source of no words has target 0; repeated
rows are documents of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .common import free_name, text_key, word_count

WEIGHTS = (5, 2, 1)
SHARE, LIMIT = 1.5, 2.0
#: Relative error of a source's words at which its multiplier is final, and the most Newton rounds.
CLOSE, ROUNDS = 1e-9, 100
#: Rows of a class that are numbered together.
SLICE = 1 << 16


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources by code point, NULL last, weigh ``weights`` in turn. Targets share
    ``share`` times all words by weight and stop at ``limit`` times the own
    words; the excess goes to the others. That is a common level per weight:
    sources fill up in the order of their ceiling per weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).withColumn("top", F.col("source_size") * limit)
    filling = Window.orderBy(F.col("top") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    rest = F.sum("source_size").over(whole) * share - F.coalesce(F.sum("top").over(before), F.lit(0.0))
    levels = weighed.withColumn("level", rest / F.sum("weight").over(after))
    open_level = F.when(F.col("top") > F.col("level") * F.col("weight"), F.col("level"))
    level = F.first(open_level, ignorenulls=True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found = levels.withColumn("common", level)
    return found.select("source", "source_size", F.least("top", F.coalesce(F.col("common") * F.col("weight"), F.col("top"))).alias("target"))


def tilted(multiplier: Column, scaled: Column, limit: float) -> Column:
    """The rate of a document; far tilts end at 0 and the limit."""
    x = F.greatest(F.lit(-600.0), F.least(F.lit(600.0), multiplier * scaled))
    return F.lit(limit) / (1.0 + (limit - 1.0) * F.exp(-x))


def balance(classes: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(source, multiplier) per source, from stored rows (source, size, n, mean, source_size, target).

    A source whose target is its ceiling needs no tilt of its own: NULL. Rounds
    of Newton steps go on until every source is close; a step that leaves the
    bracket is replaced by its middle.
    """
    exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")
    heads = classes.where("source_size > 0").groupBy("source").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    far = 1e9
    state = stored(heads.where(F.col("target") < F.col("source_size") * limit * (1 - 1e-12)).select(
        "source", "target", F.lit(0.0).alias("at"), F.lit(-far).alias("low"), F.lit(far).alias("high"), F.lit(False).alias("done")), "balance")
    for _ in range(ROUNDS):
        if state.where("not done").isEmpty():
            break
        open_, now = state.where("not done"), classes.select(F.col("source").alias("of"), "size", "n", (F.col("size") / F.col("mean")).alias("scaled"))
        rows = now.join(open_, F.col("of").eqNullSafe(F.col("source"))).withColumn("rate", tilted(F.col("at"), F.col("scaled"), limit))
        words = F.col("n") * F.col("size") * F.col("rate")
        sums = rows.groupBy("source", "target", "at", "low", "high").agg(
            exact(words).alias("words"), exact(words * F.col("scaled") * (1 - F.col("rate") / limit)).alias("slope"))
        over = F.col("words") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("at")), F.when(over, F.col("at")).otherwise(F.col("high"))
        step = F.col("at") - (F.col("words") - F.col("target")) / F.greatest("slope", F.lit(1e-9))
        # A first bracket is wide: walk out by doubling before halving it.
        reach = 2.0 * F.abs(F.col("at")) + 1.0
        step = F.greatest(F.col("at") - reach, F.least(F.col("at") + reach, step))
        middle = (F.col("new_low") + F.col("new_high")) / 2
        moved = sums.withColumns({"new_low": low, "new_high": high, "step": step}).select(
            "source", "target",
            F.when(F.abs(F.col("words") - F.col("target")) <= F.col("target") * CLOSE, F.col("at"))
            .when((F.col("step") > F.col("new_low")) & (F.col("step") < F.col("new_high")), F.col("step")).otherwise(middle).alias("at"),
            F.col("new_low").alias("low"), F.col("new_high").alias("high"),
            ((F.abs(F.col("words") - F.col("target")) <= F.col("target") * CLOSE) | (F.col("new_high") - F.col("new_low") <= 1e-15 * F.abs(F.col("at")))).alias("done"))
        state = stored(state.where("done").union(moved), "balance")
    return state.select("source", F.col("at").alias("multiplier"))


def class_copies(classes: DataFrame, multipliers: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(source, size, n, copies): copies that the rows of each class share."""
    own = multipliers.select(F.col("source").alias("of"), "multiplier")
    rate = F.coalesce(tilted(F.col("multiplier"), F.col("size") / F.col("mean"), limit), F.lit(limit))
    rated = classes.join(own, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "size", "n", F.when(F.col("size") == 0, 1.0).otherwise(rate).alias("rate"))

    def share_out(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending")])
        left, copies = 0.0, []
        for size, n, rate in zip(*(table.column(c).to_pylist() for c in ("size", "n", "rate"))):
            wanted = n * rate * size + left
            take = min(int(limit * n), max(0, int(wanted / size + 0.5))) if size else n
            left = wanted - take * size
            copies.append(take)
        return table.drop_columns(["rate"]).append_column("copies", pa.array(copies, pa.int64()))

    return rated.groupBy("source").applyInArrow(share_out, classes.select("source", "size", "n").schema.add("copies", "long"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, key, source, size, source_size, target, copies) of every row."""
    rows = stored(docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "mix-rows")
    counts = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sources = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("rows"))
    means = sources.select("source", F.when(F.col("source_size") > 0, F.col("source_size") / F.col("rows")).otherwise(1.0).alias("mean"))
    goal = targets(sources.select("source", "source_size"), weights, share, limit)
    heads = stored(goal.alias("g").join(means.alias("m"), F.col("g.source").eqNullSafe(F.col("m.source"))).select("g.source", "source_size", "target", "mean"), "mix-sources")
    of_head = heads.withColumnRenamed("source", "of")
    classes = stored(counts.join(of_head, F.col("source").eqNullSafe(F.col("of"))).drop("of"), "mix-classes")
    shared = stored(class_copies(classes, balance(classes, limit), limit), "mix-copies")
    base, extra = F.floor(F.col("copies") / F.col("n")), F.col("copies") % F.col("n")
    plan = shared.select(F.col("source").alias("of"), F.col("size").alias("of_size"), "n", base.alias("base"), extra.alias("extra"))
    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size"))).drop("of", "of_size")
    draw = F.xxhash64("id", "key")
    sliced = placed.withColumns({"draw": draw, "slice": F.pmod(draw, F.ceil(F.col("n") / SLICE))})
    ends = sliced.groupBy("source", "size", "slice").agg(F.count(F.lit(1)).alias("m"))
    ahead = F.coalesce(F.sum("m").over(Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = stored(ends.select(F.col("source").alias("of"), F.col("size").alias("of_size"), F.col("slice").alias("of_slice"), ahead.alias("ahead")).where("ahead > 0"), "mix-offsets")
    numbered = sliced.withColumn("k", F.row_number().over(Window.partitionBy("source", "size", "slice").orderBy("draw", "id", "key")))
    at = numbered.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("of_size")) & (F.col("slice") == F.col("of_slice")), "left")
    copies = F.col("base") + (F.col("k") + F.coalesce("ahead", F.lit(0)) <= F.col("extra")).cast("long")
    taken = at.select("id", "key", "source", "size", copies.alias("copies"))
    return taken.join(heads.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "id", "key", "source", "size", "source_size", "target", "copies")


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every document as often as its copies say, with a column ``copy`` from 1."""
    plan = mix(docs, weights, share, limit, id_col, text_col, source_col)
    # Rows of one id and text are in one class, so their copies differ by one at most.
    keyed = stored(plan.groupBy("id", "key", "source").agg(F.count(F.lit(1)).alias("n"), F.min("copies").alias("low"), F.sum("copies").alias("total")), "mix-plan")
    key, turn, copy = (free_name(docs, n) for n in ("mix_key", "mix_turn", "copy"))
    rows = docs.withColumn(key, text_key(F.col(text_col)))

    def dealt(rows: DataFrame, plan: DataFrame, copies: Column) -> DataFrame:
        own = plan.select(F.struct("*").alias(turn + "_plan"))
        p = lambda c: F.col(f"{turn}_plan.{c}")
        found = rows.join(own, F.col(id_col).eqNullSafe(p("id")) & (F.col(key) == p("key")) & F.col(source_col).eqNullSafe(p("source")))
        return found.withColumn(copy, F.explode(F.sequence(F.lit(0), copies))).where(F.col(copy) > 0).select(*docs.columns, F.col(copy).cast("int").alias(copy))

    p = lambda c: F.col(f"{turn}_plan.{c}")
    once = dealt(rows, keyed.where("n = 1"), p("total"))
    repeated = keyed.where("n > 1")
    if repeated.isEmpty():
        return once
    numbered = rows.withColumn(turn, F.row_number().over(Window.partitionBy(id_col, key, source_col).orderBy(F.lit(0))))
    more = p("low") + (F.col(turn) <= p("total") - p("low") * p("n")).cast("long")
    return once.union(dealt(numbered, repeated, more))
