"""Mixing sources to target weights by entropy balancing.

Each document gets the rate r = min(max_copies, exp(lambda_s * x)), x its size over the mean
size of its source: of all rates whose expected words meet the sources' targets, these
are closest to 1 in relative entropy. The convex dual has one multiplier for each token
constraint; its Newton iterations are one aggregation each over the (source, size) counts,
which hold all that gradient and Hessian need. Rates are then rounded into copies: in a
source, ordered by size, the fractions are carried from cell to cell, so that the words
taken stay within about one document of the target, and the rest is evened out by single
documents. Which documents of a cell get the extra copy follows a hash of their id.

Only SQL functions run. Rows are narrow (no text), a cell of any size is numbered by range
partitions, and no window holds more than the distinct sizes in one block.

Defined results: NULL texts have size 0, NULL sources form one source that comes last,
documents of size 0 take nothing, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.numbering import SEQ, number_rows
from .common import ROW, Workspace, keyed, pinned, words

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
TOLERANCE, MAX_STEPS = 1e-7, 60
EVENING_ROUNDS = 3
#: Distinct sizes that one task carries fractions over.
BLOCK = 256


def source_targets(ws: Workspace, cells: DataFrame, weights=WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """source, idx, n_docs, source_size, weight, target: shares by weight, none above cap * size."""
    totals = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    totals = number_rows(totals.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"],
                         ws.folder("ordered"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    totals = ws.keep(totals.select(
        "source", F.col(SEQ).alias("idx"), "n_docs", "source_size",
        F.element_at(listed, (F.col(SEQ) % len(weights) + 1).cast("int")).alias("weight")), "sources")
    whole = totals.agg(F.sum("source_size")).first()[0] or 0
    level, limit = 0.0, F.col("source_size") * float(cap)
    while True:
        above = F.col("weight") * F.lit(level) > limit
        got = totals.agg(F.sum(F.when(above, limit)).alias("capped"),
                         F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        new = (whole - (got["capped"] or 0.0)) / got["open"] if got["open"] else level
        if new <= level:
            break
        level = new
    target = F.least(limit, F.col("weight") * F.lit(level))
    return ws.keep(totals.withColumn("target", target), "targets")


def solve_rates(ws: Workspace, cells: DataFrame, sources: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """cells with the rate of their documents."""
    x = F.col("size") * F.col("n_docs") / F.col("source_size")
    need = F.col("target") * F.col("n_docs") / F.col("source_size")
    full = F.col("target") >= cap * F.col("source_size")
    state = ws.keep(sources.where("source_size > 0").select(
        "idx", "n_docs", "source_size", need.alias("need"), full.alias("full"),
        F.lit(0.0).alias("lam"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
        F.lit(1.0).alias("miss")), "state")
    used = cells.where("size > 0")
    for _ in range(MAX_STEPS):
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(700.0)))
        free = tilt < cap
        sums = (used.join(state.where("not full"), "idx")
                .select("idx", "n", x.alias("x"), F.least(tilt, F.lit(float(cap))).alias("r"), free.alias("free"))
                .groupBy("idx").agg(
                    F.sum(F.col("n") * F.col("x") * F.col("r")).alias("got"),
                    F.sum(F.when(F.col("free"), F.col("n") * F.col("x") * F.col("x") * F.col("r"))
                          .otherwise(0.0)).alias("slope")))
        gap = F.col("got") - F.col("need")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        step = state.join(sums, "idx").select(
            "idx", "n_docs", "source_size", "need", "full", lo.alias("lo"), hi.alias("hi"), "lam",
            (F.abs(gap) / F.col("need")).alias("miss"),
            F.when(F.col("slope") > 0, F.col("lam") - gap / F.col("slope")).alias("newton"))
        inside = (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
        halved = (F.when(F.col("hi") == float("inf"), 2 * F.abs(F.col("lo")) + 1)
                  .when(F.col("lo") == float("-inf"), -2 * F.abs(F.col("hi")) - 1)
                  .otherwise((F.col("lo") + F.col("hi")) / 2))
        done = F.col("miss") <= TOLERANCE
        step = step.select("idx", "n_docs", "source_size", "need", "full",
                           F.when(done, F.col("lam")).when(inside, F.col("newton")).otherwise(halved).alias("lam"),
                           "lo", "hi", "miss")
        state = ws.keep(step.unionByName(state.where("full").withColumn("miss", F.lit(0.0))), "state", like=sources)
        if (state.agg(F.max("miss")).first()[0] or 0.0) <= TOLERANCE:
            break
    rate = F.when(F.col("full"), F.lit(float(cap))).otherwise(
        F.least(F.exp(F.least(F.col("lam") * x, F.lit(700.0))), F.lit(float(cap))))
    rates = cells.join(state.select("idx", "n_docs", "source_size", "full", "lam"), "idx", "left")
    return rates.select("idx", "size", "n", F.when(F.col("size") > 0, F.coalesce(rate, F.lit(0.0)))
                        .otherwise(0.0).alias("rate"))


def round_rates(ws: Workspace, rated: DataFrame, sources: DataFrame, cap: int = MAX_COPIES) -> DataFrame:
    """idx, size, n, copies (of every document of the cell), extra (so many get one more)."""
    block = F.expr(f"size div {BLOCK}")
    split = rated.select("idx", "size", "n", F.floor("rate").cast("long").alias("copies"), block.alias("block"),
                         (F.col("n") * (F.col("rate") - F.floor("rate"))).alias("part"))
    split = ws.keep(split, "split")
    before = Window.partitionBy("idx").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = split.groupBy("idx", "block").agg(F.sum("part").alias("block_part")).select(
        "idx", "block", F.coalesce(F.sum("block_part").over(before), F.lit(0.0)).alias("carried"))
    inside = Window.partitionBy("idx", "block").orderBy(F.desc("size"))
    upto = F.col("carried") + F.sum("part").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    summed = split.join(blocks, ["idx", "block"]).withColumn("upto", upto)
    previous = F.coalesce(F.lag("upto").over(inside), F.col("carried"))
    extra = F.floor(F.col("upto") + 0.5) - F.floor(previous + 0.5)
    cells = ws.keep(summed.withColumn("extra", extra.cast("long")).select(
        "idx", "size", "n", "copies",
        F.greatest(F.lit(0), F.least(F.col("extra"), F.when(F.col("copies") < cap, F.col("n")).otherwise(0)))
        .cast("long").alias("extra")), "rounded", like=split)
    for _ in range(EVENING_ROUNDS):
        taken = cells.groupBy("idx").agg(
            F.sum(F.col("size") * (F.col("n") * F.col("copies") + F.col("extra"))).alias("taken"))
        rest = ws.keep(sources.join(taken, "idx").select(
            "idx", (F.col("target") - F.col("taken")).alias("rest")), "rest", like=sources)
        # The one document, added or left out, that brings the source closest to its target.
        sign = F.when(F.col("rest") > 0, 1).otherwise(-1)
        able = F.when(sign > 0, (F.col("extra") < F.col("n")) & (F.col("copies") < cap)).otherwise(F.col("extra") > 0)
        left = F.abs(F.abs(F.col("rest")) - F.col("size"))
        best = (cells.where("size > 0").join(rest, "idx").where(able & (left < F.abs(F.col("rest"))))
                .groupBy("idx").agg(F.min(F.struct(left.alias("left"), F.col("size"), sign.alias("sign"))).alias("b"))
                .select("idx", F.col("b.size").alias("size"), F.col("b.sign").alias("change")))
        cells = ws.keep(cells.join(best, ["idx", "size"], "left").select(
            "idx", "size", "n", "copies",
            (F.col("extra") + F.coalesce(F.col("change"), F.lit(0))).cast("long").alias("extra")), "evened", like=cells)
    return cells


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = MAX_COPIES, ws: Workspace | None = None) -> DataFrame:
    """One row a document: its row key, doc_id, size, source_size, target, copies, taken."""
    ws = ws or Workspace(docs.sparkSession, "mixing")
    narrow = ws.keep(keyed(
        pinned(ws, docs), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size")), "sizes")
    counts = ws.keep(narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    sources = source_targets(ws, counts, weights, cap)
    named = sources.select(F.col("source").alias("_source"), "idx")
    same = F.col("source").eqNullSafe(F.col("_source"))
    cells = ws.keep(counts.join(named, same).select("idx", "size", "n"), "cells")
    rounded = round_rates(ws, solve_rates(ws, cells, sources, cap), sources, cap)
    rounded = ws.keep(rounded.join(sources.select("idx", "source_size", "target"), "idx"), "plan")
    placed = number_rows(
        narrow.join(named, same).select(ROW, "doc_id", "idx", "size", F.xxhash64("doc_id").alias("_hash")),
        ["idx", "size"], ["_hash", "doc_id", ROW], ws.folder("numbered"))
    copies = F.col("copies") + F.when(F.col(SEQ) < F.col("extra"), 1).otherwise(0)
    return (placed.join(rounded.drop("n"), ["idx", "size"])
            .select(ROW, "doc_id", "size", "source_size", "target", copies.alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def repeat_by_mix(docs: DataFrame, **columns) -> DataFrame:
    """The documents, each as often as ``mix`` takes it, with all their columns."""
    ws = Workspace(docs.sparkSession, "mixing")
    columns_in, docs = docs.columns, pinned(ws, docs)
    taken = ws.keep(mix(docs, ws=ws, **columns).where("copies > 0").select(
        ROW, F.col("copies").alias("__tidegate_copies")), "taken")
    return (docs.join(taken.hint("merge"), ROW)
            .withColumn("__tidegate_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__tidegate_copies"))))
            .select(*columns_in))
