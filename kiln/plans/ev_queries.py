"""Registered EV-charging and load-series queries.

Derived inputs: the grid is the last day of ``events`` in 5-minute steps
(load without EV = event values per slot); vehicles are derived from
``customer`` (capacity 40 + key % 60, start SOC (7 key) % 100, health
70 + key % 31, start grid_start + 5 min * (key % 289), 1 + key % 8 hours; every
41st has no model and drops out, every 37th has no hours and gets one).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.lineage import Scratch
from kiln.operators import charging as ch
from kiln.operators import timeseries as ts
from kiln.operators.common import spread
from kiln.plans import query
from kiln.sources.tables import load


def ntz(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


def vehicles_from_customers(customer, grid):
    """Fixture: one vehicle per customer, every 41st without a model and every 37th without hours."""
    k = F.col("c_custkey")
    return customer.select(
        "c_custkey", F.when(k % 41 != 0, F.lit("EV")).alias("model"),
        (F.lit(40) + k % 60).cast("int").alias("capacity_kwh"),
        ((k * 7) % 100).cast("int").alias("soc_start_pct"),
        (F.lit(70) + k % 31).cast("int").alias("health_pct"),
        (grid.start + F.make_dt_interval(F.lit(0), F.lit(0), (k % 289) * ch.STEP_MIN)).alias("start"),
        F.when(k % 37 != 0, (F.lit(1) + k % 8).cast("double")).alias("hours"))


class EV:
    """Frames shared by the EV queries of one call."""

    def __init__(self, spark, sf_dir):
        events = load(spark, sf_dir, "events")
        self.work = Scratch(spark, "charging")
        self.grid = ch.grid_bounds(events)
        self.load = ch.grid_load(events, self.grid)
        cars = ch.usable_vehicles(vehicles_from_customers(spread(load(spark, sf_dir, "customer")), self.grid))
        self.vehicles = ch.number_users(cars, ["start", "c_custkey"])
        self.folded = ch.schedule(self.vehicles, self.grid)
        self.rows = ch.vehicle_rows(self.folded)

    def write_rows(self):
        """Fold once: write the schedule for the several uses that follow."""
        self.rows = self.work.write(self.rows, "rows")
        return self

    def user_power(self):
        return ch.user_power(self.rows)

    def totals(self):
        return ch.totals(self.rows, self.load)

    def smoothed(self):
        return ts.rolling_mean_sparse(self.user_power(), ["user"], "ts", "power", self.grid.start, self.grid.end,
                                      rows=3, out="smoothed")

    def costs(self):
        return ch.charges(self.smoothed(), ch.peak_flags(self.totals()))


SQL_EV = """
bnd AS (SELECT time_bucket(INTERVAL 5 MINUTE, max(ts)) - INTERVAL 24 HOUR AS grid_start,
               time_bucket(INTERVAL 5 MINUTE, max(ts)) AS grid_end FROM events),
grid AS (SELECT unnest(generate_series(grid_start, grid_end, INTERVAL 5 MINUTE)) AS ts FROM bnd),
slots AS (SELECT time_bucket(INTERVAL 5 MINUTE, e.ts) AS ts, sum(e.value::DECIMAL(18,2)) AS load
          FROM events e, bnd WHERE e.ts >= grid_start AND e.ts < grid_end + INTERVAL 5 MINUTE GROUP BY 1),
gl AS (SELECT grid.ts, coalesce(slots.load, 0::DECIMAL(18,2)) AS load_without_ev
       FROM grid LEFT JOIN slots USING (ts)),
veh AS (SELECT c_custkey, (40 + c_custkey % 60)::INTEGER AS capacity_kwh,
               ((c_custkey * 7) % 100)::INTEGER AS soc_start_pct, (70 + c_custkey % 31)::INTEGER AS health_pct,
               grid_start + to_minutes(((c_custkey % 289) * 5)::BIGINT) AS start,
               CASE WHEN c_custkey % 37 = 0 THEN 1.0::DOUBLE ELSE (1 + c_custkey % 8)::DOUBLE END AS hours,
               grid_start, grid_end FROM customer, bnd WHERE c_custkey % 41 <> 0),
vu AS (SELECT *, 'user' || row_number() OVER (ORDER BY start, c_custkey) AS user,
              ceil(hours * 60 / 5)::INTEGER AS n,
              least(ceil(hours * 60 / 5)::INTEGER - 1,
                    floor((epoch(grid_end) - epoch(start)) / 300)::INTEGER) AS kmax,
              capacity_kwh::DOUBLE AS cap, health_pct::DOUBLE / 100.0::DOUBLE AS h,
              (soc_start_pct::DOUBLE / 100.0::DOUBLE) * capacity_kwh::DOUBLE AS soc0 FROM veh),
fold AS (
  WITH RECURSIVE f(user, k, soc) AS (
    SELECT user, 0, soc0 FROM vu
    UNION ALL
    SELECT f.user, f.k + 1,
           CASE WHEN f.soc < v.cap THEN f.soc + RATE * (5.0::DOUBLE / 60.0::DOUBLE)
                ELSE f.soc - RATE * v.h * (5.0::DOUBLE / 60.0::DOUBLE) END
    FROM f JOIN vu v USING (user) WHERE f.k + 1 <= v.kmax + 1)
  SELECT * FROM f),
rows AS (
  SELECT f.user, f.k, v.start + to_minutes((f.k * 5)::BIGINT) AS ts,
         (CASE WHEN f.soc < v.cap THEN RATE ELSE -RATE * v.h END)::DECIMAL(12,3) AS power,
         CASE WHEN v.soc0 + f.k * 2.5::DOUBLE < v.cap THEN 30.0::DOUBLE ELSE 0.0::DOUBLE END AS power_unopt
  FROM fold f JOIN vu v USING (user) WHERE f.k <= v.kmax),
up AS (SELECT user, ts, (CASE WHEN power < 0 THEN round_even(power, 1) ELSE power END)::DECIMAL(12,3) AS power
       FROM rows),
tot AS (
  SELECT gl.ts, coalesce(e.ev, 0::DECIMAL(12,3)) AS ev, coalesce(e.ev_unopt, 0.0::DOUBLE) AS ev_unopt,
         gl.load_without_ev FROM gl LEFT JOIN (
    SELECT ts, sum(power) AS ev, sum(power_unopt) AS ev_unopt FROM rows GROUP BY ts) e USING (ts)),
totals AS (
  SELECT ts, round_even(ev, 1)::DOUBLE AS total_ev_load, round_even(ev_unopt, 1) AS total_ev_load_unopt,
         round_even(load_without_ev, 1)::DOUBLE AS load_without_ev,
         round_even(ev + load_without_ev, 1)::DOUBLE AS load_with_ev,
         round_even(ev_unopt + load_without_ev::DOUBLE, 1) AS load_with_ev_unopt FROM tot),
sm AS (
  SELECT user, ts, s, den, s::DOUBLE / den AS smoothed FROM (
    SELECT user, ts, s, least(3, ((epoch(ts) - epoch(grid_start)) / 300)::BIGINT + 1)::INTEGER AS den
    FROM (SELECT user, up.ts + to_minutes((r.k * 5)::BIGINT) AS ts, sum(power) AS s
          FROM up, range(3) r(k) GROUP BY ALL), bnd
    WHERE ts <= grid_end)),
thr AS (SELECT avg(load_without_ev) + stddev_samp(load_without_ev) AS thr FROM totals),
flags AS (SELECT ts, CASE WHEN load_without_ev >= thr THEN 'peak' ELSE 'off-peak' END AS period
          FROM totals, thr),
cost AS (
  SELECT user, ((3 * pk + 2 * op - dis) * 1000)::BIGINT AS milli FROM (
    SELECT user,
      sum(CASE WHEN s > 0 AND period = 'peak' THEN s * (6 // den) ELSE 0 END) AS pk,
      sum(CASE WHEN s > 0 AND NOT period = 'peak' THEN s * (6 // den) ELSE 0 END) AS op,
      -sum(CASE WHEN s < 0 THEN s * (6 // den) ELSE 0 END) AS dis
    FROM sm LEFT JOIN flags USING (ts) GROUP BY user)),
qr AS (SELECT user, milli, ((milli % 7200) + 7200) % 7200 AS r FROM cost),
charges AS (
  SELECT user, ((milli - r) // 7200 + CASE WHEN 2 * r > 7200 THEN 1
                 WHEN 2 * r = 7200 THEN ((((milli - r) // 7200) % 2) + 2) % 2 ELSE 0 END)::DOUBLE
               / 100.0::DOUBLE AS final_cost FROM qr)""".replace(
    "RATE", "(CASE WHEN v.n = 1 THEN 5.0::DOUBLE ELSE round_even(5.0::DOUBLE + f.k::DOUBLE * "
            "(25.0::DOUBLE / (v.n - 1)::DOUBLE), 1) END)")


@query("ev_schedule", f"WITH {SQL_EV} SELECT user, ts, power::DOUBLE AS power FROM up")
def q_ev_schedule(spark, sf_dir):
    up = EV(spark, sf_dir).user_power()
    return up.select("user", ntz("ts"), F.col("power").cast("double").alias("power"))


@query("ev_unoptimised", f"""WITH {SQL_EV}
SELECT user, ts, power_unopt FROM rows WHERE power_unopt > 0""")
def q_ev_unoptimised(spark, sf_dir):
    r = EV(spark, sf_dir).rows
    return r.filter(F.col("power_unopt") > 0).select("user", ntz("ts"), "power_unopt")


@query("ev_totals", f"WITH {SQL_EV} SELECT * FROM totals")
def q_ev_totals(spark, sf_dir):
    t = EV(spark, sf_dir).totals()
    return t.select(ntz("ts"), *[c for c in t.columns if c != "ts"])


@query("ev_user_summary", f"""WITH {SQL_EV},
pos AS (SELECT user, sum(CASE WHEN power > 0 THEN power ELSE 0 END) AS pos FROM rows GROUP BY user),
endsoc AS (SELECT f.user, f.soc FROM fold f JOIN vu v USING (user) WHERE f.k = greatest(v.kmax, -1) + 1)
SELECT vu.user, round_even(coalesce(pos.pos, 0)::DOUBLE * (5.0::DOUBLE / 60.0::DOUBLE), 1) AS energy_kwh,
       round_even(least(endsoc.soc / vu.cap * 100, 100.0::DOUBLE), 1) AS end_soc_pct
FROM vu JOIN endsoc USING (user) LEFT JOIN pos USING (user)""")
def q_ev_user_summary(spark, sf_dir):
    return ch.vehicle_state(EV(spark, sf_dir).folded)


@query("rolling_mean", f"WITH {SQL_EV} SELECT user, ts, round(smoothed, 6) AS smoothed FROM sm")
def q_rolling_mean(spark, sf_dir):
    sm = EV(spark, sf_dir).smoothed()
    return sm.select("user", ntz("ts"), F.round("smoothed", 6).alias("smoothed"))


@query("load_derivative", f"""WITH {SQL_EV}
SELECT ts, round((load_with_ev - lag(load_with_ev) OVER (ORDER BY ts))
                 / ((epoch(ts) - epoch(lag(ts) OVER (ORDER BY ts))) / 3600.0), 6) AS per_hour
FROM totals""")
def q_load_derivative(spark, sf_dir):
    t = ts.rate_of_change(EV(spark, sf_dir).totals(), "ts", "load_with_ev")
    return t.select(ntz("ts"), F.round("per_hour", 6).alias("per_hour"))


@query("peak_metrics", f"""WITH {SQL_EV},
m AS (SELECT max(load_with_ev_unopt) AS pb, max(load_with_ev) AS pa,
             var_samp(load_with_ev_unopt) AS vb, var_samp(load_with_ev) AS va,
             avg(load_with_ev_unopt) AS mb, avg(load_with_ev) AS ma FROM totals)
SELECT round(pb, 6) AS peak_before, round(pa, 6) AS peak_after, round(vb, 6) AS var_before,
       round(va, 6) AS var_after, round(mb, 6) AS mean_before, round(ma, 6) AS mean_after,
       round(100 * (pb - pa) / pb, 6) AS peak_reduction_pct,
       round(100 * (vb - va) / vb, 6) AS var_reduction_pct,
       round(100 * (mb - ma) / mb, 6) AS mean_reduction_pct FROM m""")
def q_peak_metrics(spark, sf_dir):
    t = EV(spark, sf_dir).totals()
    m = t.agg(F.max("load_with_ev_unopt").alias("pb"), F.max("load_with_ev").alias("pa"),
              F.var_samp("load_with_ev_unopt").alias("vb"), F.var_samp("load_with_ev").alias("va"),
              F.avg("load_with_ev_unopt").alias("mb"), F.avg("load_with_ev").alias("ma"))

    def red(b, a):
        return F.round(F.try_divide(100 * (F.col(b) - F.col(a)), F.col(b)), 6)
    return m.select(F.round("pb", 6).alias("peak_before"), F.round("pa", 6).alias("peak_after"),
                    F.round("vb", 6).alias("var_before"), F.round("va", 6).alias("var_after"),
                    F.round("mb", 6).alias("mean_before"), F.round("ma", 6).alias("mean_after"),
                    red("pb", "pa").alias("peak_reduction_pct"), red("vb", "va").alias("var_reduction_pct"),
                    red("mb", "ma").alias("mean_reduction_pct"))


@query("peak_pricing", f"WITH {SQL_EV} SELECT user, final_cost FROM charges")
def q_peak_pricing(spark, sf_dir):
    return EV(spark, sf_dir).write_rows().costs()


@query("peak_pricing_compat", f"""WITH {SQL_EV},
pos AS (SELECT user, sum(CASE WHEN power > 0 THEN power ELSE 0 END) AS pos FROM rows GROUP BY user),
endsoc AS (SELECT f.user, f.soc FROM fold f JOIN vu v USING (user) WHERE f.k = greatest(v.kmax, -1) + 1),
st AS (SELECT vu.user, round_even(coalesce(pos.pos, 0)::DOUBLE * (5.0::DOUBLE / 60.0::DOUBLE), 1) AS e,
              round_even(least(endsoc.soc / vu.cap * 100, 100.0::DOUBLE), 1) AS s
       FROM vu JOIN endsoc USING (user) LEFT JOIN pos USING (user)),
pw AS (SELECT user, smoothed AS p, period FROM sm LEFT JOIN flags USING (ts)
       UNION ALL SELECT 'Total EV Load', total_ev_load, period FROM totals LEFT JOIN flags USING (ts)
       UNION ALL SELECT user, unnest([e, s]), 'off-peak' FROM st)
SELECT user, round(sum(round(CASE WHEN p > 0 THEN p * (5.0::DOUBLE / 60) * (CASE WHEN period = 'peak' THEN 0.2::DOUBLE * 1.5 ELSE 0.2::DOUBLE END)
                                  ELSE p * (5.0::DOUBLE / 60) * 0.1::DOUBLE END, 9)::DECIMAL(20,9)), 2)::DOUBLE AS final_cost
FROM pw GROUP BY user""")
def q_peak_pricing_compat(spark, sf_dir):
    ev = EV(spark, sf_dir).write_rows()
    tot = ev.totals()
    return ch.charges_compat(ev.smoothed(), ch.peak_flags(tot), ch.vehicle_state(ev.folded),
                             tot.select("ts", F.col("total_ev_load").alias("power")))


@query("price_features", f"""WITH {SQL_EV}
SELECT vu.user, vu.hours, vu.soc_start_pct, vu.capacity_kwh,
       hour(try_strptime(strftime(vu.start, '%-I:%M %p'), '%I:%M %p')) AS start_hour, charges.final_cost
FROM vu JOIN charges USING (user)""")
def q_price_features(spark, sf_dir):
    ev = EV(spark, sf_dir).write_rows()
    cost = ev.costs()
    v = ev.vehicles.select("user", "hours", "soc_start_pct", "capacity_kwh",
                           ts.hour_of_clock_string(F.date_format("start", "h:mm a")).alias("start_hour"))
    return v.join(cost, "user")
