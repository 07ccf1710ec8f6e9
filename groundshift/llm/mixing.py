"""Mix sources to target weights by weighted fair queueing.

Every source serves its documents in a shuffled order, again from the start
once all are served, at most ``epochs`` times. A copy's virtual finish time is
the number of words its source has served with it, divided by the source's
target. Copies are taken in order of finish time until the total budget is
spent, so all sources reach their targets together, at time 1.

Nulls: a null text has size 0, a null source is a source of its own, ordered
last, a null id is mixed like any other. Documents of size 0 take nothing.
Rows that agree in id and text have equal places in the order and are counted
each. An empty table gives an empty mix. Other columns are ignored by
``mix_sizes`` and kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.llm.scratch import columns, fresh, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Digits of the shuffle key by which running sums are split, so that a source is never one task.
SLICE_DIGITS = 3
#: Ranges of finish time up to time 1; later ones fill as many again.
RANGES = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(doc_id: Column, text: Column, seed: str) -> Column:
    """A place in the shuffle that depends on the row alone, so reruns agree."""
    return F.md5(F.concat_ws("|", F.lit(seed), doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights: Sequence[float], budget_share: float, epochs: int) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``weights`` repeat along the sources by code point. Targets share the budget
    by weight; a target stops at ``epochs`` times its source's size and the rest
    is shared again. That is a water level: with the sources in order of cap by
    weight, each has a level at which all before it are full and the rest takes
    what is left, and the highest of these levels is the one that spends all.
    """
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    rows = rows.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))
    rows = rows.withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(float(budget_share))
    rows = rows.withColumn("left", total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    rows = rows.withColumn("pull", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("level", F.max(F.col("left") / F.col("pull")).over(everything))
    target = F.least(F.col("level") * F.col("weight"), F.col("cap"))
    return rows.select("source", "source_size", target.alias("target"))


def mix_sizes(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    budget_share: float = 1.0,
    epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """``doc_id, mix_key, size, source, source_size, target, copies, finish`` of every row of ``docs``.

    ``copies`` is how often the mix takes the row, ``finish`` the finish time of
    its first copy. Running sums are made in slices of the shuffle key, with the
    sums of earlier slices added, so a hot source spreads over many tasks. The
    global order is cut by ranges of finish time: the totals of the ranges tell
    which range holds the end of the budget, and only that range is sorted.
    """
    rows = stored(
        docs.select(
            F.col("doc_id"),
            F.col("source"),
            n_words(F.col("text")).alias("size"),
            shuffle_key(F.col("doc_id"), F.col("text"), seed).alias("mix_key"),
        ).withColumn("slice", F.substring("mix_key", 1, SLICE_DIGITS)),
        "mix-sizes",
    )
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    targets = stored(source_targets(rows, weights, budget_share, epochs), "mix-targets")
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("source", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    served = Window.partitionBy("source", "slice").orderBy("mix_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.withColumn("run", F.sum("size").over(served))
    run = (
        run.alias("a")
        .join(slices.alias("b"), same & (F.col("a.slice") == F.col("b.slice")))
        .select("a.doc_id", "a.source", "a.size", "a.mix_key", (F.col("a.run") + F.col("b.base")).alias("run"))
    )
    timed = (
        run.alias("a")
        .join(targets.alias("b"), same)
        .select("a.*", "b.source_size", "b.target", F.when(F.col("target") > 0, F.col("run") / F.col("target")).alias("finish"))
    )
    timed = stored(timed, "mix-times")

    def copy(epoch) -> Column:
        """Finish time of one copy, null if its source has reached its target before the copy begins."""
        end = F.col("source_size") * epoch + F.col("run")
        return F.when((F.col("size") > 0) & (end - F.col("size") < F.col("target")), end / F.col("target"))

    def in_range(finish: Column) -> Column:
        return F.floor(F.least(finish, F.lit(2.0)) * RANGES)

    every = timed.select("*", F.explode(F.array(*[copy(e) for e in range(epochs)])).alias("at")).where(F.col("at").isNotNull())
    budget = targets.agg(F.sum("target")).first()[0] or 0.0
    totals = every.groupBy(in_range(F.col("at")).alias("range")).agg(F.sum("size").alias("n"))
    upto = totals.select("range", "n", F.sum("n").over(Window.orderBy("range")).alias("upto"))
    # at most 2 * RANGES + 1 rows, of which the first that passes the budget is read
    cut = upto.where(F.col("upto") > budget).orderBy("range").first()
    if cut is None:
        taken = copy(0).isNotNull().cast("int")
        for e in range(1, epochs):
            taken = taken + copy(e).isNotNull().cast("int")
    else:
        order = [F.col("at"), F.col("source").asc_nulls_first(), F.col("mix_key"), F.col("size")]
        last = (
            every.where(in_range(F.col("at")) == cut["range"])
            .withColumn("spent", F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
            .where(F.col("spent") > budget - (cut["upto"] - cut["n"]))
            .orderBy("spent")
            .first()
        )

        def before_cut(at: Column) -> Column:
            """Whether a copy comes before the first one that no longer fits."""
            inner = F.struct(F.col("source"), F.col("mix_key"), F.col("size"))
            edge = F.struct(F.lit(last["source"]).cast("string"), F.lit(last["mix_key"]), F.lit(last["size"]).cast("long"))
            return F.coalesce((at < last["at"]) | ((at == last["at"]) & (inner < edge)), F.lit(False))

        taken = before_cut(copy(0)).cast("int")
        for e in range(1, epochs):
            taken = taken + before_cut(copy(e)).cast("int")
    return timed.select("doc_id", "mix_key", "size", "source", "source_size", "target", taken.alias("copies"), "finish")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes it, in order of finish time."""
    key, nth, finish, epoch = fresh(docs, "mix_key", "mix_nth", "mix_finish", "mix_epoch")
    plan = mix_sizes(docs, **options)
    plan = plan.withColumn("nth", F.row_number().over(Window.partitionBy("mix_key", "source").orderBy("finish")))
    a = docs.withColumn(key, shuffle_key(F.col("doc_id"), F.col("text"), options.get("seed", "mix")))
    a = a.withColumn(nth, F.row_number().over(Window.partitionBy(key, "source").orderBy(key))).alias("a")
    b = plan.where(F.col("copies") > 0).alias("b")
    on = (F.col(f"a.{key}") == F.col("b.mix_key")) & (F.col(f"a.{nth}") == F.col("b.nth"))
    rows = a.join(b, on & F.col("a.source").eqNullSafe(F.col("b.source"))).select(
        *[F.col("a.`" + c.replace("`", "``") + "`") for c in docs.columns],
        F.col("b.mix_key").alias(key),
        F.col("b.finish").alias(finish),
        (F.col("b.source_size") / F.col("b.target")).alias(nth),
        F.explode(F.expr("sequence(0, b.copies - 1)")).alias(epoch),
    )
    return rows.orderBy(F.col(finish) + F.col(epoch) * F.col(nth), key).select(*columns(docs))
