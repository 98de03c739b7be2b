"""Budgeted site selection: a greedy heuristic, not an exact solver. Capacities are not enforced.

Serial greedy takes the best candidate, updates, and repeats: one job per pick.
Gains only shrink as sites are taken, and only through shared cells, so every
candidate that is the best one in all the cells it would improve can be taken in
the same round. Serial greedy takes exactly these sites, in order of gain, so
sorting the picks by gain restores its order and a budget is a prefix of it.
Study areas (``area_id``) never share cells and advance together.

Rounds work on live edges only: those of cells that are still open or could still come nearer. After a round the edges of
the cells that were served shrink or go, and only candidates with such an edge are summed again. An area whose live edges fit a
task (``LOCAL_EDGES``) is finished there by the serial rule, all such areas in parallel, instead of in a long tail of small rounds.
Where cells have positions, larger areas are first cut into parts too far apart to share a candidate; each part then counts as an area of its own.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators import spatial
from geoloom.operators.checkpoints import materialise
from geoloom.operators.components import connected_components
from geoloom.operators.service import BUILD_COST
from geoloom.operators.skew import ranked, repeated, spread

GAIN_DIGITS = 6
#: Edges of an area that one task finishes (about 50 bytes each).
LOCAL_EDGES = 1_000_000
AREA_CELL, AREA_SUB, PART = ["area_id", "cell_id"], ["area_id", "sub_id"], ["area_id", "_part"]


def _local_best(live: DataFrame, scores: DataFrame) -> DataFrame:
    """Candidates that outrank every other candidate in each of their cells."""
    marked = live.select("area_id", "cell_id", "sub_id").join(scores, AREA_SUB).withColumn("_rank", F.struct("score", (-F.col("sub_id")).alias("o")))
    best = F.max("_rank").over(W.partitionBy(*AREA_CELL))
    return marked.withColumn("_best", best).groupBy(*AREA_SUB).agg(
        F.max("score").alias("score"), F.every(F.col("_rank") == F.col("_best")).alias("_top")).filter("_top").drop("_top")


def _scores(live: DataFrame, phase: str, build_cost: float) -> DataFrame:
    value = F.sum("demand_kw") if phase == "cover" else F.sum(F.col("demand_kw") * (F.col("cur") - F.col("dist_m"))) - F.lit(build_cost)
    scores = live.groupBy(*AREA_SUB).agg(F.round(value, GAIN_DIGITS).alias("score"))
    return scores if phase == "cover" else scores.filter("score > 0")


def finish_area(phase: str, build_cost: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Serial greedy over the live edges of one area, or of a part of it."""
    def finish(edges: pd.DataFrame) -> pd.DataFrame:
        edges = edges.sort_values(["sub_id", "cell_id"], kind="stable")
        ids, sub = np.unique(edges["sub_id"].to_numpy(), return_inverse=True)
        cells, cell = np.unique(edges["cell_id"].to_numpy(), return_inverse=True)
        dist, demand = edges["dist_m"].to_numpy(float), edges["demand_kw"].to_numpy(float)
        begin = np.searchsorted(sub, np.arange(len(ids) + 1))
        by_cell = np.argsort(cell, kind="stable")
        cell_begin = np.searchsorted(cell[by_cell], np.arange(len(cells) + 1))
        cur = np.full(len(cells), np.inf)
        if phase == "gain":
            cur[cell] = edges["cur"].to_numpy(float)
        value = demand.copy() if phase == "cover" else demand * np.maximum(cur[cell] - dist, 0)
        alive = np.ones(len(cell), bool)  # the cell is open, or could come nearer

        def runs(starts, ends):
            n = ends - starts
            return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())

        def summed(some):
            at = runs(begin[some], begin[some + 1])
            cuts = np.cumsum(begin[some + 1] - begin[some])[:-1]
            total = np.round(np.add.reduceat(value[at], np.append(0, cuts)) - (0.0 if phase == "cover" else build_cost), GAIN_DIGITS)
            return np.where(np.logical_or.reduceat(alive[at], np.append(0, cuts)), total, -np.inf)

        score = summed(np.arange(len(ids)))
        picks: list[tuple] = []
        while True:
            best = int(score.argmax())  # the first of the largest: ids are in order
            if score[best] == -np.inf or (phase == "gain" and score[best] <= 0):
                break
            picks.append((ids[best], float(score[best])))
            own = np.arange(begin[best], begin[best + 1])
            changed = cell[own][(np.isinf(cur[cell[own]]) if phase == "cover" else dist[own] < cur[cell[own]])]
            cur[cell[own]] = np.minimum(cur[cell[own]], dist[own])
            at = by_cell[runs(cell_begin[changed], cell_begin[changed + 1])]
            value[at] = 0.0 if phase == "cover" else demand[at] * np.maximum(cur[cell[at]] - dist[at], 0)
            alive[at] = phase == "gain" and dist[at] < cur[cell[at]]
            again = np.unique(sub[at])
            score[again] = summed(again)
        area = edges["area_id"].iloc[0]
        return pd.DataFrame({"area_id": area, "sub_id": [p[0] for p in picks], "score": [p[1] for p in picks]}, columns=["area_id", "sub_id", "score"])
    return finish


def _with_parts(cells: DataFrame, eligible: DataFrame) -> DataFrame:
    """``area_id, cell_id, demand_kw`` and ``_part``; cells of different parts share no candidate.

    Cells that share one lie within twice the longest distance of a pair, so in the same bin of that side or in touching ones: the
    parts are the components of occupied bins. One part where cells have no positions, or where all pairs fit a task.
    """
    whole = cells.select("area_id", "cell_id", "demand_kw", F.lit(0).cast("bigint").alias("_part"))
    if not {"x", "y"} <= set(cells.columns):
        return whole
    n, longest = eligible.filter("kind = 'candidate'").agg(F.count(F.lit(1)), F.max("dist_m")).first()
    if n <= LOCAL_EDGES or not cells.filter("x IS NULL OR y IS NULL").isEmpty():
        return whole
    side = max(2 * longest * (1 + 1e-9), 1.0)
    placed = spatial.with_bin(cells.select("area_id", "cell_id", "demand_kw", "x", "y"), side)
    number = lambda x, y: x * F.lit(1 << 32) + y
    bx, by = (F.col(c) for c in spatial.BIN)
    bins = materialise(placed.select("area_id", number(bx, by).alias("_bin"), *spatial.BIN).distinct())
    ahead = F.array(*[number(bx + i, by + j) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))])
    beside = repeated(bins.select("area_id", F.col("_bin").alias("a"), F.explode(ahead).alias("b")))
    touching = beside.join(bins.select("area_id", F.col("_bin").alias("b")), ["area_id", "b"])
    parts = connected_components(bins, touching, "_bin", ["area_id"]).select("area_id", *spatial.BIN, F.col("component").alias("_part"))
    return placed.join(parts, ["area_id", *spatial.BIN]).select("area_id", "cell_id", "demand_kw", "_part")


def _phase(live: DataFrame, phase: str, build_cost: float) -> list[DataFrame]:
    """Picks ``(area_id, sub_id, score)`` of one phase, round by round."""
    picks: list[DataFrame] = []
    fields = ", ".join(f"{c} {live.schema[c].dataType.simpleString()}" for c in AREA_SUB)
    live, scores = materialise(live), None
    while True:
        sizes = live.groupBy(*PART).agg(F.count(F.lit(1)).alias("n"))
        small, large = (sizes.agg(F.count_if(F.col("n") <= LOCAL_EDGES), F.count_if(F.col("n") > LOCAL_EDGES)).first())
        if small:
            fits = materialise(sizes.filter(F.col("n") <= LOCAL_EDGES).select(*PART))
            inside = spread(live.join(fits, PART, "left_semi"), *PART)
            done = inside.groupBy(*PART).applyInPandas(finish_area(phase, build_cost), f"{fields}, score double")
            picks.append(materialise(done))
            if not large:
                return picks
            live = materialise(live.join(fits, PART, "left_anti"))
            scores = scores.join(live.select(*AREA_SUB).distinct(), AREA_SUB, "left_semi") if scores is not None else None
        if not large:
            return picks
        scores = materialise(_scores(live, phase, build_cost) if scores is None else scores)
        taken = materialise(_local_best(live.join(scores.select(*AREA_SUB), AREA_SUB, "left_semi") if phase == "gain" else live, scores))
        if taken.isEmpty():
            return picks
        picks.append(taken)
        served = materialise(live.join(taken.select(*AREA_SUB), AREA_SUB, "left_semi").groupBy(*AREA_CELL).agg(F.min("dist_m").alias("_new")))
        touched = live.join(served.select(*AREA_CELL), AREA_CELL, "left_semi").select(*AREA_SUB).distinct()
        if phase == "cover":
            live = materialise(live.join(served.select(*AREA_CELL), AREA_CELL, "left_anti"))
        else:
            nearer = live.join(served, AREA_CELL, "left").withColumn("cur", F.least("cur", "_new")).drop("_new")
            live = materialise(nearer.filter("dist_m < cur"))
        touched = materialise(touched)
        renewed = _scores(live.join(touched, AREA_SUB, "left_semi"), phase, build_cost)
        scores = scores.join(touched, AREA_SUB, "left_anti").unionByName(renewed)


def greedy_siting(cells: DataFrame, eligible: DataFrame, budget: int | None = 50,
                  build_cost: float = BUILD_COST) -> DataFrame:
    """Picks ``(area_id, candidate_id, phase, step, score)`` in greedy order.

    ``cells``: ``area_id, cell_id, demand_kw``, if known also ``x, y`` in the metres of ``dist_m``, which then is the
    straight distance; ``eligible``: ``cell_id, kind, sub_id, dist_m``, all pairs or those of :func:`~geoloom.operators.service.deciding_in_range`.

    Cover phase: until each cell with an eligible server has an open one, take the
    candidate that covers most uncovered demand. Gain phase: take the candidate with
    the largest ``sum(demand * max(0, current - dist)) - build_cost`` while positive.
    ``budget=None`` keeps every pick. An area whose cover phase alone is over budget is
    infeasible, see :func:`siting_status`.
    """
    demand = _with_parts(cells, eligible)
    pairs = eligible.join(demand, "cell_id")
    # Copies of a key pair cannot occur: one distance per (cell, server).
    options = materialise(pairs.filter("kind = 'candidate'").select("area_id", "_part", "cell_id", "sub_id", "dist_m", "demand_kw"))
    existing = pairs.filter("kind = 'existing'").groupBy(*AREA_CELL).agg(F.min("dist_m").alias("cur"))
    covers = _phase(options.join(existing.select(*AREA_CELL), AREA_CELL, "left_anti"), "cover", build_cost)
    current = existing
    if covers:
        covers = [reduce(DataFrame.unionByName, covers)]
        opened = options.join(covers[0].select(*AREA_SUB), AREA_SUB, "left_semi").groupBy(*AREA_CELL).agg(F.min("dist_m").alias("cur"))
        current = existing.unionByName(opened).groupBy(*AREA_CELL).agg(F.min("cur").alias("cur"))
    gains = _phase(options.join(current, AREA_CELL).filter("dist_m < cur"), "gain", build_cost)
    picks = [d.withColumn("phase", F.lit(phase)) for phase, found in (("cover", covers), ("gain", gains)) for d in found]
    if not picks:
        empty = options.limit(0)
        return empty.select("area_id", F.col("sub_id").alias("candidate_id"), F.lit("").alias("phase"),
                            F.lit(0).cast("bigint").alias("step"), F.lit(0.0).alias("score"))
    late: Column = (F.col("phase") == "gain").cast("int")
    every = reduce(DataFrame.unionByName, picks).withColumn("_order", F.struct(late.alias("a"), (-F.col("score")).alias("b"), F.col("sub_id").alias("c")))
    out = ranked(every, "_order", "step", by=["area_id"])
    if budget is not None:
        out = out.filter(F.col("step") <= budget)
    return out.select("area_id", F.col("sub_id").alias("candidate_id"), "phase", "step", "score")


def siting_status(cells: DataFrame, picks: DataFrame, budgets: list[int]) -> DataFrame:
    """``(area_id, max_new, status, n_built)``; ``n_built`` is NULL when the cover phase is over budget.

    ``picks`` come from :func:`greedy_siting` with ``budget=None``.
    """
    areas = cells.select("area_id").distinct().withColumn("max_new", F.explode(F.array(*[F.lit(b) for b in budgets])))
    need = picks.groupBy("area_id").agg(F.count_if(F.col("phase") == "cover").alias("cover"),
                                        F.count(F.lit(1)).alias("n"))
    sized = areas.join(need, "area_id", "left").withColumns(
        {"cover": F.coalesce("cover", F.lit(0)), "n": F.coalesce("n", F.lit(0))})
    ok = F.col("cover") <= F.col("max_new")
    return sized.select("area_id", "max_new", F.when(ok, "FEASIBLE").otherwise("INFEASIBLE").alias("status"),
                        F.when(ok, F.least(F.col("n"), F.col("max_new").cast("bigint"))).alias("n_built"))


def budget_sweep(cells: DataFrame, eligible: DataFrame, reachable: DataFrame, picks: DataFrame,
                 budgets: tuple[int, ...] = (10, 25, 50, 75, 100), gap_m: float = 10000.0,
                 cell_size_m: float = 3000.0) -> DataFrame:
    """Metrics per area and budget from one greedy run; infeasible rows have NULL metrics.

    Budgets are prefixes of the same pick order: each candidate pair is repeated only
    for the budgets that include its pick.
    """
    status = siting_status(cells, picks, list(budgets))
    steps = picks.select(F.col("candidate_id").alias("sub_id"), "step")
    limits = F.array(*[F.lit(b) for b in budgets])
    existing = eligible.filter("kind = 'existing'").withColumn("max_new", F.explode(limits))
    opened = eligible.filter("kind = 'candidate'").join(steps, "sub_id").withColumn(
        "max_new", F.explode(F.filter(limits, lambda b: b >= F.col("step")))).drop("step")
    best = existing.unionByName(opened).groupBy("max_new", "cell_id").agg(
        F.min(F.struct("dist_m", "kind", "sub_id")).alias("b"))
    served = best.select("max_new", "cell_id", "b.dist_m", (F.col("b.kind") == "candidate").alias("new"))
    flagged = cells.select("area_id", "cell_id", "demand_kw").join(
        reachable.select("cell_id", F.lit(True).alias("near")), "cell_id", "left").withColumn(
        "max_new", F.explode(limits)).join(repeated(served), ["max_new", "cell_id"], "left")
    dist, near = F.coalesce("dist_m", F.lit(0.0)), F.coalesce("near", F.lit(False))
    new = F.coalesce("new", F.lit(False))
    rows = flagged.groupBy("area_id", "max_new").agg(
        (100.0 * F.try_divide(F.count_if(near & (dist > gap_m)), F.count_if(near))).alias("coverage_gap_pct"),
        F.try_divide(F.sum(F.when(near, F.col("demand_kw") * dist)), F.sum(F.when(near, F.col("demand_kw")))
                     ).alias("avg_service_dist_m"),
        F.max(F.when(near, dist)).alias("max_service_dist_m"),
        F.coalesce(F.sum(F.when(new, F.col("demand_kw"))), F.lit(0.0)).alias("load_shifted_kw"),
        (F.count_if(new) * (cell_size_m / 1000) ** 2).alias("new_area_km2"))
    metrics = ["coverage_gap_pct", "avg_service_dist_m", "max_service_dist_m", "load_shifted_kw", "new_area_km2"]
    joined = status.join(rows, ["area_id", "max_new"], "left")
    return joined.withColumns({m: F.when(F.col("n_built").isNotNull(), F.col(m)) for m in metrics})
