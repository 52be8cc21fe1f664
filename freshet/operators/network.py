"""River networks: downstream look-up, validity, coverage of regions, routing downstream."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def routing_table(metadata: DataFrame) -> DataFrame:
    """Metadata renamed and cast to routing parameters, in riverIndex order within regions."""
    return metadata.select(
        "region", "riverIndex", F.col("riverId").cast("int").alias("river_id"), F.col("nextRiverId").cast("int").alias("next_river_id"), F.col("musk_k").cast("double").alias("k"), F.col("musk_x").cast("double").alias("x")
    )


def downstream(rivers: DataFrame) -> DataFrame:
    """(region, river, next, index) with the index of the river drained into; -1 marks an outlet."""
    other = rivers.select(F.col("region").alias("r2"), F.col("river").alias("to"), F.col("index").alias("next_index"))
    return rivers.join(other, (F.col("region") == F.col("r2")) & (F.col("next") == F.col("to")), "left").select("region", "river", "next", "index", "next_index")


def network_checks(rivers: DataFrame) -> DataFrame:
    """By region: rivers, outlets, and how many rows break each rule (contiguous index, unique ids, closed,
    topological, valid parameters)."""
    linked = downstream(rivers)
    flows = F.col("next") != -1
    by_link = linked.groupBy("region").agg(
        F.count("river").alias("n_rivers"), F.count_if(~flows).alias("n_outlets"), F.count_if(flows & F.col("next_index").isNull()).alias("n_open"),
        F.count_if(flows & (F.col("next_index") <= F.col("index"))).alias("n_unordered"), (F.max("index") - F.min("index") + 1 - F.count_distinct("index")).alias("n_gaps"), (F.count("river") - F.count_distinct("river")).alias("n_repeated"),
    )
    bad = ~((F.col("k") > 0) & (F.col("k") < float("inf")) & F.col("x").between(0.0, 0.5))
    by_row = rivers.groupBy("region").agg(F.count_if(F.coalesce(bad, F.lit(True))).alias("n_invalid"))
    return by_link.join(by_row, "region")


def require(checks: DataFrame) -> DataFrame:
    """The same rows; a region that breaks a rule raises an error when it is read."""
    broken = F.col("n_open") + F.col("n_unordered") + F.col("n_gaps") + F.col("n_repeated") + F.col("n_invalid")
    return checks.withColumn("ok", F.when(broken == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid network in region "), F.col("region").cast("string"))).cast("boolean")))


def region_spans(rivers: DataFrame) -> DataFrame:
    """Regions by first river; covered when each begins where the one before ends."""
    spans = rivers.groupBy("region").agg(F.min("index").alias("first"), F.count("index").alias("n"))
    w = Window.orderBy("first")
    return spans.select("region", "first", "n", (F.col("first") == F.coalesce(F.lag(F.col("first") + F.col("n")).over(w), F.lit(0))).alias("covered"))


def missing_region_years(present: DataFrame) -> DataFrame:
    """(region, year) pairs absent though the region and the year occur."""
    every = present.select("region").distinct().crossJoin(F.broadcast(present.select("year").distinct()))
    return every.join(present, ["region", "year"], "left_anti")


def upstream_sums(rivers: DataFrame, save: Callable[[DataFrame, str], DataFrame], values: tuple[str, ...] = ("area",), max_rounds: int = 40) -> tuple[DataFrame, DataFrame, int]:
    """(sums, cycles, rounds): of every river the sums of ``values`` over itself and all rivers that drain into it, and
    how many these are (n_upstream); the rivers of cycles and those that drain into one; and the rounds it took.

    ``rivers`` has river, next (-1 or null: outlet) and the values (null counts as 0). Path doubling: after round k a
    river knows the river 2^k steps downstream, and its sums reach 2^k steps upstream, so a chain of n rivers takes
    log2(n) rounds. A round hands each river's sums to the river its jump leads to, as partial sums before the shuffle,
    and joins the jumps with themselves; ``save(frame, name)`` writes a frame and gives it back, which cuts lineage.
    Where many rivers jump to one, that river's jump meets them by a skewed join that adaptive execution splits. Rivers
    that drain into a river that is not there end there. Rivers whose jumps do not end are on a cycle or above one: they
    have no sums.
    """
    ids = rivers.select(F.col("river").alias("next")).distinct()
    known = rivers.where("next <> -1").join(ids, "next", "left_semi").select("river", "next")
    state = rivers.select("river", *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values], F.lit(1).cast("long").alias("n_upstream")).join(known.withColumnRenamed("next", "jump"), "river", "left")
    state, n, sums = save(state, "round0"), rivers.count(), [*values, "n_upstream"]
    for turn in range(1, max_rounds + 1):
        handed = state.where("jump is not null").groupBy(F.col("jump").alias("river")).agg(*[F.sum(v).alias(f"_{v}") for v in sums])
        ahead = state.where("jump is not null").select("river", "jump").join(state.select(F.col("river").alias("jump"), F.col("jump").alias("_jump")), "jump").select("river", "_jump")
        grown = state.join(handed, "river", "left").join(ahead, "river", "left")
        state = save(grown.select("river", *[(F.col(v) + F.coalesce(F.col(f"_{v}"), F.lit(0))).alias(v) for v in sums], F.col("_jump").alias("jump")), f"round{turn}")
        left = state.where("jump is not null").count()
        if not left or 2**turn >= 2 * max(n, 1):
            break
    return state.where("jump is null").drop("jump"), state.where("jump is not null").select("river"), turn


def cycles(rivers: DataFrame, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rivers of each cycle: (river, cycle), a cycle named by its smallest river. Among the rivers that never reach an
    outlet, those on a cycle are where jumps beyond all chains lead to."""
    _, endless, turns = upstream_sums(rivers.select("river", "next"), save, ())
    jumps = save(rivers.select("river", "next").join(endless, "river", "left_semi").select("river", F.col("next").alias("jump"), F.col("river").alias("least")), "jumps0")
    for turn in range(1, turns + 1):
        other = jumps.select(F.col("river").alias("jump"), F.col("jump").alias("_jump"), F.col("least").alias("_least"))
        jumps = save(jumps.join(other, "jump").select("river", F.col("_jump").alias("jump"), F.least("least", "_least").alias("least")), f"jumps{turn}")
    on = jumps.select(F.col("jump").alias("river")).distinct()
    return jumps.join(on, "river").select("river", F.col("least").alias("cycle"))


def route(inflow: DataFrame, rivers: DataFrame, step_hours: float = 1.0, state: DataFrame | None = None) -> DataFrame:
    """Muskingum routing of (region, river, step, inflow) along each closed region's network.

    ``rivers``: region, river, next, index, k (hours), x. With D = 2k(1-x) + dt: C1 = (dt-2kx)/D,
    C2 = (dt+2kx)/D, C3 = (2k(1-x)-dt)/D and Q[t+1] = C1 I[t+1] + C2 I[t] + C3 Q[t]; I is what comes from
    upstream, and a step's lateral inflow is added to Q. Negative coefficients are kept as they are. Channels
    start empty, or from ``state`` (region, river, q). Regions are independent; within one, rivers go in index
    order and all steps of a river are one recursion.
    """
    start = state if state is not None else rivers.sparkSession.createDataFrame([], "region int, river long, q double")
    nodes = rivers.join(start.select("region", "river", F.col("q").alias("q0")), ["region", "river"], "left")

    def one(key, net: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        net = net.sort_values("index")
        steps = np.sort(rows["step"].unique())
        at = {r: i for i, r in enumerate(net["river"])}
        lateral = np.zeros((len(net), len(steps)))
        known = rows[rows["river"].isin(at)]
        np.add.at(lateral, (known["river"].map(at).to_numpy(int), np.searchsorted(steps, known["step"])), known["inflow"].fillna(0).to_numpy(float))
        q, upstream = np.zeros_like(lateral), np.zeros_like(lateral)
        for i, (nxt, k, x, q0) in enumerate(zip(net["next"], net["k"], net["x"], net["q0"].fillna(0))):
            d = 2 * k * (1 - x) + step_hours
            c1, c2, c3 = (step_hours - 2 * k * x) / d, (step_hours + 2 * k * x) / d, (2 * k * (1 - x) - step_hours) / d
            last, before = q0, 0.0
            for t in range(len(steps)):
                last = c1 * upstream[i, t] + c2 * before + c3 * last + lateral[i, t]
                before = upstream[i, t]
                q[i, t] = last
            if nxt in at:
                upstream[at[nxt]] += q[i]
        return pd.DataFrame({"region": key[0], "river": np.repeat(net["river"].to_numpy(), len(steps)), "step": np.tile(steps, len(net)), "q": q.ravel()})

    lateral_rows = inflow.select(*[F.col(c).alias(c) for c in ("region", "river", "step", "inflow")])
    grouped = nodes.select(*[F.col(c).alias(c) for c in nodes.columns]).groupBy("region").cogroup(lateral_rows.groupBy("region"))
    return grouped.applyInPandas(one, "region int, river long, step int, q double")


def final_state(routed: DataFrame) -> DataFrame:
    """The state from which the next year goes on: each river's flow at its last step."""
    return routed.groupBy("region", "river").agg(F.max_by("q", "step").alias("q"))


def layout(rivers: DataFrame) -> DataFrame:
    """(river, region, river_index, next): the place of every river in the world, region after region; regions are
    few, so their sizes are ordered in one task."""
    sizes = rivers.groupBy("region").count()
    offsets = sizes.select("region", F.coalesce(F.sum("count").over(Window.orderBy("region").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return rivers.join(F.broadcast(offsets), "region").select("river", "region", (F.col("first") + F.col("index")).alias("river_index"), "next")


def places(rows: DataFrame, key: str, parts: int = 64) -> DataFrame:
    """(key, place): every row's number from 0 in the order of ``key``, a number, without ordering all rows in one task:
    ranges of keys between approximate quantiles are numbered side by side, from where the ranges before end."""
    cuts = rows.approxQuantile(key, [i / parts for i in range(1, parts)], 0.01) if parts > 1 else []
    ranged = rows.select(key, sum((F.when(F.col(key) >= c, 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0)).alias("_part"))
    numbered = ranged.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1)
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    sizes = ranged.groupBy("_part").count().select("_part", before.alias("_before"))
    return numbered.join(F.broadcast(sizes), "_part").select(key, (F.col("_before") + F.col("_at")).cast("long").alias("place"))


def one_sided(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """(key, side) of the keys that only one of two tables has."""
    a, b = first.select(key).distinct(), second.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("first")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("second")))


def uneven(rows: DataFrame, by: str, value: str) -> DataFrame:
    """(by, n, values) of the groups whose rows do not all have one ``value``."""
    found = rows.groupBy(by).agg(F.array_sort(F.collect_set(value)).alias("values"))
    return found.where(F.size("values") > 1).select(by, F.size("values").alias("n"), "values")


def record_starts(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """(year, n, first, late, allowed): when each year of a record begins. Only the first year may start late."""
    grouped = rows.groupBy(F.year(ts).alias("year")).agg(F.countDistinct(key).alias("n"), F.min(F.date_trunc("hour", ts)).alias("first"))
    late = F.col("first") != F.make_timestamp("year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    first_year = F.min("year").over(Window.partitionBy(F.lit(0)))  # a row a year
    return grouped.select("year", "n", "first", late.alias("late"), (~late | (F.col("year") == first_year)).alias("allowed"))


def resume_after(years: DataFrame, states: DataFrame) -> DataFrame:
    """(region, done, resume): how many years from a region's first are finished without a gap, and the year to go
    on with. A year counts as finished only once its state is there; states without flows do not count."""
    finished = years.select("region", "year").distinct().join(states.select("region", "year").distinct(), ["region", "year"], "left_semi").withColumn("finished", F.lit(True))
    every = years.select("region", "year").distinct().join(finished, ["region", "year"], "left")
    first_open = every.groupBy("region").agg(F.min("year").alias("first"), F.max("year").alias("last"), F.min(F.when(F.col("finished").isNull(), F.col("year"))).alias("open"))
    run = Window.partitionBy("region").orderBy("year")
    gap = every.withColumn("_gap", F.lead("year").over(run) - F.col("year")).groupBy("region").agg(F.min(F.when(F.col("_gap") > 1, F.col("year") + 1)).alias("gap"))
    resume = F.least("open", "gap", F.col("last") + 1)
    return first_open.join(gap, "region").select("region", (resume - F.col("first")).alias("done"), resume.alias("resume"))
