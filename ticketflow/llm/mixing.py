"""Mixing sources to target weights by temperature, in DataFrame operations only.

Source weights are the token shares raised to an exponent and normalised. The
exponent is bisected: the largest that meets a target entropy or keeps every
source within a repetition limit of the least repeated one. Weights become token
budgets, realised in blocks: every pass over a source is a fresh pseudo-random
permutation of its documents, taken whole while the budget lasts and, in the
last pass, up to the document that fills it.

A source's running token sum is taken in two levels (slices of the permutation,
then only the slice in which the budget ends), so a source that holds most rows
is never sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketflow.llm.common import materialize

# Bisection steps that one job evaluates, as a grid of 2**steps - 1 exponents.
GRID_STEPS = 4
JOBS = 10
# Slices of a source's permutation: leading hex digits of its hash.
SLICE_DIGITS = 3
# Whole passes that one row draws at once; more are dealt over tasks in parts of this many.
PASSES = 10_000


def n_tokens(text: Column) -> Column:
    """Whitespace-separated words; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")), F.lit(0)).cast("long")


def source_tokens(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))


def bisect_exponent(sources: DataFrame, target_entropy: float | None = None,
                    max_repeats: float | None = None) -> float:
    """The largest exponent in [0, 1] that meets the target.

    Entropy (as a share of that of equal weights) falls and repetition falls as
    the exponent grows: an entropy target bounds the exponent from above, a
    repetition limit from below. An entropy that token shares already reach, or
    no source with tokens, gives 1.
    Each job evaluates a grid of exponents in one aggregate over the sources.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either a target entropy or a repetition limit")
    known = sources.where("tokens > 0")
    total, n, most, least = known.agg(F.sum("tokens"), F.count(F.lit(1)), F.max("tokens"), F.min("tokens")).first()
    if not n or most == least:
        return 1.0

    def fits(exponents: list[float]) -> list[bool]:
        # true while the exponent is small enough (entropy) or too small (repetition)
        if max_repeats is not None:
            return [(most / least) ** (1 - a) > max_repeats for a in exponents]
        share = F.col("tokens") / F.lit(total)
        sums = []
        for i, a in enumerate(exponents):
            w = F.pow(share, F.lit(a))
            sums += [F.sum(w).alias(f"z{i}"), F.sum(w * F.log(w)).alias(f"l{i}")]
        row = known.agg(*sums).first()
        entropy = lambda i: math.log(row[f"z{i}"]) - row[f"l{i}"] / row[f"z{i}"]
        return [entropy(i) >= target_entropy * math.log(n) for i in range(len(exponents))]

    lo, hi = 0.0, 1.0
    if fits([1.0])[0]:
        return 1.0
    cells = 1 << GRID_STEPS
    for _ in range(JOBS):
        grid = [lo + (hi - lo) * i / cells for i in range(1, cells)]
        ok = sum(fits(grid))
        lo, hi = lo + (hi - lo) * ok / cells, lo + (hi - lo) * (ok + 1) / cells
    return lo if max_repeats is None else hi


def budgets(sources: DataFrame, exponent: float, budget_tokens: int | None = None) -> DataFrame:
    """``(source, tokens, weight, budget)``; budgets are whole tokens.

    Without a budget the mixture is the smallest in which no source is cut,
    that is, in which the source with the fewest repetitions is taken once.
    A source without tokens has weight and budget 0.
    """
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    share = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(total), F.lit(exponent)))
    raw = sources.withColumn("raw", F.coalesce(share, F.lit(0.0)))
    sums = raw.agg(F.sum("raw").alias("z"), F.max(F.col("tokens") / F.when(F.col("raw") > 0, F.col("raw"))).alias("whole"))
    z, whole = sums.first()
    scale = F.lit((whole or 0.0) if budget_tokens is None else budget_tokens / z if z else 0.0)
    budget = F.floor(F.round(F.col("raw") * scale, 6)).cast("long")
    return raw.select("source", "tokens", (F.col("raw") / F.lit(z or 1.0)).alias("weight"), budget.alias("budget"))


def _permutation(seed: int) -> Column:
    """Place of a document in a pass over its source: a hash, then the id and text."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("h")))


def whole_passes(planned: DataFrame, most: int, seed: int, passes: int = PASSES) -> DataFrame:
    """``(doc_id, source, n_tokens, epoch, place)`` of the ``whole`` passes over each
    document; no source has more than ``most``."""
    kept = ["doc_id", "source", "h", "n_tokens", "whole"]
    rows = planned.where("whole > 0").select(*kept)
    first = F.lit(0).cast("long")
    if most > passes:
        parts = F.explode(F.sequence(first, F.floor((F.col("whole") - 1) / passes).cast("long"))).alias("part")
        dealt = rows.where(F.col("whole") > passes).select(*kept, parts).repartition("part", "source", "doc_id", "h")
        rows = rows.where(F.col("whole") <= passes).withColumn("part", first).unionByName(dealt)
        first = F.col("part") * passes
    last = F.least(F.col("whole"), first + passes) - 1
    return (rows.select(*kept, F.explode(F.sequence(first, last)).alias("epoch"))
            .select("doc_id", "source", "n_tokens", "epoch", _permutation(seed).alias("place")))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
        budget_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """``(doc_id, source, n_tokens, epoch, place)``: a row for each time a document is drawn.

    ``epoch`` counts the passes over the source from 0 and ``place`` orders a
    pass. A null source is a source of its own; documents without tokens cost
    nothing and are drawn in every whole pass; rows that repeat a document are
    drawn each. If nothing has tokens, each document is drawn once; no
    documents, no rows.
    """
    own = materialize(docs.select("doc_id", "source", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("h"),
                                  n_tokens(F.col("text")).alias("n_tokens")), "mix-lengths")
    sources = materialize(source_tokens(own), "mix-sources")
    exponent = bisect_exponent(sources, target_entropy, max_repeats)
    plan = budgets(sources, exponent, budget_tokens).select(
        F.col("source").alias("plan_source"), "budget", "tokens",
        F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("long").alias("whole"),
        F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"))
    plan = materialize(plan, "mix-plan")
    planned = own.join(plan, own["source"].eqNullSafe(plan["plan_source"])).select(
        "doc_id", "source", "h", "n_tokens", "whole", "rest")
    most = plan.agg(F.max("whole")).first()[0] or 0
    full = whole_passes(planned, most, seed)
    last = (planned.where("rest > 0").withColumn("epoch", F.col("whole"))
            .select("doc_id", "source", "h", "n_tokens", "epoch", "rest", _permutation(seed).alias("place"))
            .withColumn("slice", F.substring("place", 1, SLICE_DIGITS)))
    slices = last.groupBy("source", "slice").agg(F.sum("n_tokens").alias("t"), F.first("rest").alias("rest"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = (slices.withColumn("before", F.coalesce(F.sum("t").over(before), F.lit(0)))
           .where(F.col("before") < F.col("rest"))
           .select(F.col("source").alias("c_source"), F.col("slice").alias("c_slice"), "before",
                   (F.col("before") + F.col("t") < F.col("rest")).alias("all_of_it")))
    in_cut = last.join(cut, last["source"].eqNullSafe(cut["c_source"]) & (last["slice"] == cut["c_slice"]))
    columns = ["doc_id", "source", "n_tokens", "epoch", "place"]
    inside = Window.partitionBy("source").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = (in_cut.where("not all_of_it")
            .withColumn("filled", F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .where(F.col("filled") < F.col("rest")))
    return (full.select(*columns).unionByName(in_cut.where("all_of_it").select(*columns))
            .unionByName(edge.select(*columns)))
