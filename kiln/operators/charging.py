"""EV charging schedule on a 5-minute grid, totals, smoothing, peak pricing
(N5-N9, A1-A6, J1-J2, J10, P13, X1, X4).

The per-vehicle running state (state of charge decides charge or discharge
at every step) is a fold over the vehicle's session steps with
``F.aggregate`` and a struct accumulator: one row in, one array out, no
Python, no shuffle. Sessions are at most a few dozen steps, so the array
stays small. Powers are then exploded to (user, ts, power) rows.

Money and energy totals are summed as exact decimals (every power is a
multiple of 0.001 kW), so results do not depend on partitioning or summation
order; rounding is half-even as in the reference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.common import attach_row, global_index
from kiln.operators.timeseries import floor_minutes, regular_grid

STEP_MIN = 5
STEP_H = 5 / 60
# Fixed values of the pricing rule: base rate per kWh, peak multiplier,
# discharge discount per kWh.
BASE_RATE, PEAK_MULT, DISCHARGE_DISCOUNT = 0.20, 1.5, 0.10
# Fixed values of the schedule: linear rate ramp from 5 to 30 kW; the
# unoptimised baseline draws 30 kW until full.
RATE_LO, RATE_HI, BASELINE_KW = 5.0, 30.0, 30.0
POWER = "decimal(12,3)"


@dataclass(frozen=True)
class Grid:
    """First and last 5-minute slot, in microseconds since the epoch. Both are literals in the plans, so a bound on an
    event time reaches the scan."""

    start_us: int
    end_us: int

    @property
    def start(self) -> Column:
        return F.timestamp_micros(F.lit(self.start_us))

    @property
    def end(self) -> Column:
        return F.timestamp_micros(F.lit(self.end_us))


def grid_bounds(events: DataFrame, ts_col: str = "ts", hours: int = 24) -> Grid:
    """The day up to the last 5-minute slot of the data (one aggregation; an empty table gives the epoch)."""
    last = events.agg(F.unix_micros(F.max(ts_col)).alias("us")).first().us or 0
    slot = STEP_MIN * 60 * 1_000_000
    end = last // slot * slot
    return Grid(end - hours * 3_600_000_000, end)


def grid_load(events: DataFrame, grid: Grid, ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """(ts, load_without_ev) on every grid point: event values summed per
    slot (exact decimal), zero-filled. Only the last day of events is read."""
    after = F.timestamp_micros(F.lit(grid.end_us + STEP_MIN * 60 * 1_000_000))
    inside = events.select(ts_col, value_col).filter((F.col(ts_col) >= grid.start) & (F.col(ts_col) < after))
    slots = (inside.groupBy(floor_minutes(ts_col, STEP_MIN).alias("ts"))
             .agg(F.sum(F.col(value_col).cast("decimal(18,2)")).alias("load")))
    points = events.sparkSession.range(1).select(F.explode(regular_grid(grid.start, grid.end, STEP_MIN)).alias("ts"))
    return (points.join(slots, "ts", "left")
            .select("ts", F.coalesce("load", F.lit(0).cast("decimal(18,2)")).alias("load_without_ev")))


def usable_vehicles(vehicles: DataFrame, model_col: str = "model", hours_col: str = "hours",
                    default_hours: float = 1.0) -> DataFrame:
    """P3 + P5: vehicles without a model go; a missing availability counts as one hour."""
    return vehicles.where(F.col(model_col).isNotNull()).withColumn(
        hours_col, F.coalesce(F.col(hours_col), F.lit(default_hours)))


def number_users(vehicles: DataFrame, order_cols: list[str]) -> DataFrame:
    """user1, user2, ... in a total order (the distributed ``global_index``)."""
    ranked = global_index(vehicles, order_cols, out="_i")
    return ranked.withColumn("user", F.concat(F.lit("user"), F.col("_i").cast("string"))).drop("_i")


def _rate(k: Column, n: Column) -> Column:
    ramp = F.lit(RATE_LO) + k * (F.lit(RATE_HI - RATE_LO) / (n - 1))
    return F.when(n == 1, F.lit(RATE_LO)).otherwise(F.bround(ramp, 1))


def schedule(vehicles: DataFrame, grid: Grid) -> DataFrame:
    """N6-N9 per vehicle: (user, ts, power, power_unopt, k) for session
    steps on the grid, plus the end state via ``vehicle_state``.

    n = ceil(hours * 60 / 5) session steps from ``start`` (right-open);
    rate(k) ramps 5 -> 30 kW (half-even to 0.1); while the stored energy is
    below capacity the car charges at rate(k), otherwise it discharges
    rate(k) * health. Steps after the grid end change nothing.
    """
    n = F.ceil(F.col("hours") * 60 / STEP_MIN).cast("int")
    on_grid = F.floor((F.unix_seconds(grid.end) - F.unix_seconds("start")) / (STEP_MIN * 60)).cast("int")
    v = (vehicles.withColumn("_n", n)
         .withColumn("_kmax", F.least(F.col("_n") - 1, on_grid))
         .withColumn("_cap", F.col("capacity_kwh").cast("double"))
         .withColumn("_h", F.col("health_pct") / F.lit(100.0))
         .withColumn("_soc0", (F.col("soc_start_pct") / F.lit(100.0)) * F.col("_cap")))

    def step(acc, k):
        r = _rate(k, F.col("_n"))
        charging = acc["soc"] < F.col("_cap")
        soc = F.when(charging, acc["soc"] + r * F.lit(STEP_H)) \
            .otherwise(acc["soc"] - r * F.col("_h") * F.lit(STEP_H))
        p = F.when(charging, r).otherwise(-r * F.col("_h"))
        return F.struct(soc.alias("soc"), F.array_append(acc["p"], p).alias("p"))

    init = F.struct(F.col("_soc0").alias("soc"), F.array().cast("array<double>").alias("p"))
    folded = v.withColumn("_f", F.aggregate(
        F.when(F.col("_kmax") >= 0, F.sequence(F.lit(0), F.col("_kmax")))
        .otherwise(F.array().cast("array<int>")), init, step))
    return folded


def vehicle_rows(folded: DataFrame) -> DataFrame:
    """Exploded schedule: (user, k, ts, power exact, baseline power)."""
    # an outer explode: an inner one lets the optimizer infer a filter on the
    # array and push the whole fold into it a second time
    rows = folded.select(
        "user", "_soc0", "_cap", "start",
        F.posexplode_outer("_f.p").alias("k", "_p")).where("k IS NOT NULL")
    # N8 closed form: the j-th on-grid step draws 30 kW iff soc0 + 2.5 j < cap.
    base = F.when(F.col("_soc0") + F.col("k") * F.lit(BASELINE_KW * STEP_H) < F.col("_cap"),
                  F.lit(BASELINE_KW)).otherwise(F.lit(0.0))
    return rows.select(
        "user", "k",
        (F.col("start") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k") * STEP_MIN)).alias("ts"),
        F.col("_p").cast(POWER).alias("power"),
        base.alias("power_unopt"))


def vehicle_state(folded: DataFrame) -> DataFrame:
    """A3 + X4: (user, energy_kwh, end_soc_pct)."""
    pos = F.aggregate(F.filter("_f.p", lambda x: x > 0), F.lit(0).cast("decimal(18,3)"),
                      lambda a, x: (a + x.cast(POWER)).cast("decimal(18,3)"))
    end_pct = F.least(F.col("_f.soc") / F.col("_cap") * 100, F.lit(100.0))
    return folded.select("user",
                         F.bround(pos.cast("double") * F.lit(STEP_H), 1).alias("energy_kwh"),
                         F.bround(end_pct, 1).alias("end_soc_pct"))


def user_power(rows: DataFrame) -> DataFrame:
    """Per-user schedule as published: discharges rounded half-even to 0.1."""
    p = F.when(F.col("power") < 0, F.bround("power", 1)).otherwise(F.col("power"))
    return rows.select("user", "ts", p.cast(POWER).alias("power"))


def totals(rows: DataFrame, load: DataFrame) -> DataFrame:
    """A1 + A2 + J1 on every grid point; totals from unrounded powers,
    rounded last."""
    ev = rows.groupBy("ts").agg(F.sum("power").alias("ev"),
                                F.sum("power_unopt").alias("ev_unopt"))
    j = load.join(ev, "ts", "left")
    ev_c = F.coalesce("ev", F.lit(0).cast(POWER))
    un_c = F.coalesce("ev_unopt", F.lit(0.0))
    return j.select(
        "ts",
        F.bround(ev_c, 1).cast("double").alias("total_ev_load"),
        F.bround(un_c, 1).alias("total_ev_load_unopt"),
        F.bround("load_without_ev", 1).cast("double").alias("load_without_ev"),
        F.bround(ev_c + F.col("load_without_ev"), 1).cast("double").alias("load_with_ev"),
        F.bround(un_c + F.col("load_without_ev").cast("double"), 1).alias("load_with_ev_unopt"))


def peak_flags(tot: DataFrame) -> DataFrame:
    """A5 + P13: peak iff load without EV >= mean + sample std."""
    thr = tot.agg((F.avg("load_without_ev") + F.stddev_samp("load_without_ev")).alias("_thr"))
    return (attach_row(tot.select("ts", "load_without_ev"), thr)
            .select("ts", F.when(F.col("load_without_ev") >= F.col("_thr"), "peak")
                    .otherwise("off-peak").alias("period")))


def _half_even_div(num: Column, den: int) -> Column:
    """Exact integer num / den rounded half-even (den > 0)."""
    r = F.pmod(num, F.lit(den))
    q = (num - r).cast("long") / F.lit(den)
    q = F.floor(q).cast("long")
    bump = (F.when(r * 2 > den, F.lit(1))
            .when(r * 2 == den, F.pmod(q, F.lit(2)))
            .otherwise(F.lit(0)))
    return q + bump


def charges_compat(smoothed: DataFrame, flags: DataFrame, state: DataFrame, total: DataFrame) -> DataFrame:
    """A6 with the published table's artefacts: each user's energy and end state of charge are summed as two more
    off-peak rows, and the total load (``total``: ts, power) is billed as one more user."""
    def bill(j: DataFrame) -> DataFrame:
        kwh = F.col("power") * F.lit(STEP_H)
        rate = F.when(F.col("period") == "peak", BASE_RATE * PEAK_MULT).otherwise(BASE_RATE)
        cost = F.when(kwh > 0, kwh * rate).otherwise(kwh * F.lit(DISCHARGE_DISCOUNT))
        # summed as decimals of nine places, so that the order of summation doesn't matter
        exact = F.sum(F.round(cost, 9).cast("decimal(20,9)"))
        return j.groupBy("user").agg(F.round(exact, 2).cast("double").alias("final_cost"))

    on_grid = smoothed.select("user", "ts", F.col("smoothed").alias("power")).unionByName(
        total.select(F.lit("Total EV Load").alias("user"), "ts", "power")).join(F.broadcast(flags), "ts", "left")
    extra = state.select("user", F.explode(F.array("energy_kwh", "end_soc_pct")).alias("power"),
                         F.lit("off-peak").alias("period"))
    return bill(on_grid.select("user", "power", "period").unionByName(extra))


def charges(smoothed: DataFrame, flags: DataFrame) -> DataFrame:
    """Per user, charging cost (peak x1.5) minus discharge discount,
    rounded half-even to cents, computed exactly.

    The input is the 3-row rolling mean (``window_sum`` exact, divisor
    ``window_rows`` in 1..3). With w6 = 6 * mean = window_sum * (6 / rows),
    cost = (3 * peak_w6 + 2 * offpeak_w6 - discharge_w6) / 720 exactly
    (0.2 * 1.5 * 5/60 = 1/40, 0.2 * 5/60 = 1/60, 0.1 * 5/60 = 1/120), so the
    result does not depend on summation order. ``flags`` has one row per
    grid point and is broadcast.
    """
    j = smoothed.join(F.broadcast(flags), "ts", "left")
    w6 = (F.col("window_sum") * (F.lit(6) / F.col("window_rows")).cast("int")).cast("decimal(20,3)")
    s = F.col("window_sum")
    peak = F.col("period") == "peak"
    agg = j.groupBy("user").agg(
        F.sum(F.when((s > 0) & peak, w6).otherwise(F.lit(0))).alias("_pk"),
        F.sum(F.when((s > 0) & ~peak, w6).otherwise(F.lit(0))).alias("_op"),
        (-F.sum(F.when(s < 0, w6).otherwise(F.lit(0)))).alias("_dis"))
    milli = ((F.col("_pk") * 3 + F.col("_op") * 2 - F.col("_dis")) * 1000).cast("long")
    cents = _half_even_div(milli, 7200)  # cents = milli * 100 / (720 * 1000)
    return agg.select("user", (cents / F.lit(100.0)).alias("final_cost"))
