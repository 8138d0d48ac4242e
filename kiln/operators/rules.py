"""Fuzzy rule bases as tables.

A rule file lists the variables with their ranges and membership functions and the rules that join them. ``parse`` reads it
into ``sets`` (side, variable, number, shape, corners) and ``rules`` (number, antecedents, consequent, weight, connective).
``score`` evaluates any such pair of tables: antecedents look up their memberships, a rule's strength is their
minimum (or maximum), a consequent's the maximum over its rules, and the crisp output the centroid of the clipped sets.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators.common import attach_row

_SETS = "side string, variable int, variable_name string, low double, high double, number int, name string, shape string, corners array<double>"
_RULES = "rule int, antecedents array<int>, consequent int, weight double, connective string"
SAMPLES = 101  # our choice: points of the sampled output universe


def parse(spark: SparkSession, text: str) -> tuple[DataFrame, DataFrame]:
    """(sets, rules) of a rule file: sections in brackets, Name = value lines, and rules like ``4 7, 7 (1) : 1`` (a set number for each
    input, 0 for any and negative for not; the output's set; the weight; 1 for and, 2 for or). Blank lines and lines that start
    with % are skipped. Triangles (trimf) and trapezoids (trapmf) are known; a line that can't be read is an error."""
    sets, rules, section, variable = [], [], "", {}
    for line in map(str.strip, text.splitlines()):
        if not line or line.startswith("%"):
            continue
        if head := re.fullmatch(r"\[(Input|Output)([0-9]+)\]|\[(\w+)\]", line):
            section = head[1] or head[3]
            variable = {"side": section.lower(), "variable": int(head[2] or 0)}
        elif section == "Rules":
            found = re.fullmatch(r"(-?\d+(?:\s+-?\d+)*)\s*,\s*(\d+)\s*\(([\d.]+)\)\s*:\s*([12])", line)
            if not found:
                raise ValueError(f"not a rule: {line!r}")
            rules.append((len(rules) + 1, [int(x) for x in found[1].split()], int(found[2]), float(found[3]), "and" if found[4] == "1" else "or"))
        elif section in ("Input", "Output"):
            name, _, value = line.partition("=")
            if name == "Name":
                variable["name"] = value.strip("'")
            elif name == "Range":
                variable["low"], variable["high"] = map(float, value.strip("[]").split())
            elif found := re.fullmatch(r"MF(\d+)='([^']*)':'(trimf|trapmf)',\[([^\]]*)\]", line):
                corners = [float(x) for x in found[4].split()]
                if len(corners) != (3 if found[3] == "trimf" else 4) or corners != sorted(corners):
                    raise ValueError(f"not a membership function: {line!r}")
                sets.append((variable["side"], variable["variable"], variable["name"], variable["low"], variable["high"], int(found[1]),
                             found[2], found[3], corners))
            elif name.startswith("MF"):
                raise ValueError(f"not a membership function: {line!r}")
    return spark.createDataFrame(sets, _SETS), spark.createDataFrame(rules, _RULES)


def membership(x: Column, corners: Column) -> Column:
    """V8: height of a triangle or trapezoid at x; a side without width is a shoulder."""
    n = F.size(corners)
    a, b, c, d = corners[0], corners[1], corners[n - 2], corners[n - 1]
    left = F.when(a == b, 1.0).otherwise((x - a) / (b - a))
    right = F.when(c == d, 1.0).otherwise((d - x) / (d - c))
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(left, F.lit(1.0), right)))


def output_samples(sets: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row: array<struct<x, heights map<set, height>>> over the sampled range of the output variable."""
    step = F.sequence(F.lit(0), F.lit(samples - 1))
    points = sets.where("side = 'output'").select(
        "number", "corners", F.explode(step).alias("k"), (F.col("low") + F.col("k") * (F.col("high") - F.col("low")) / (samples - 1)).alias("x"))
    heights = points.select("k", "x", "number", membership(F.col("x"), F.col("corners")).alias("height")).where("height > 0")
    rows = heights.groupBy("k", "x").agg(F.array_sort(F.collect_list(F.struct("number", "height"))).alias("heights"))
    ordered = F.array_sort(F.collect_list(F.struct("x", "heights")))
    return rows.agg(F.transform(ordered, lambda p: F.struct(p["x"].alias("x"), F.map_from_entries(p["heights"]).alias("heights"))).alias("samples"))


def score(df: DataFrame, id_col: str, inputs: list[str], sets: DataFrame, rules: DataFrame, out: str = "u", samples: int = SAMPLES) -> DataFrame:
    """V9: (id, out): the crisp output of each row of ``df``; null when no rule fires. ``inputs`` are the columns of the
    input variables in their order, and a null one has membership 0 in every set.

    The rule tables are as small as their file: each is one broadcast row of arrays, and every row of ``df`` is scored where it lies.
    """
    known = sets.where("side = 'input'").agg(F.collect_list(F.struct((F.col("variable") - 1).alias("at"), "number", "corners")).alias("_sets"))
    listed = rules.agg(F.collect_list(F.struct("antecedents", "consequent", "weight", "connective")).alias("_rules"))
    rows = df.select(F.col(id_col).alias("id"), F.array(*(F.col(c).cast("double") for c in inputs)).alias("_x"))
    rows = attach_row(attach_row(attach_row(rows, known), listed), output_samples(sets, samples))
    # membership of the row's inputs in each set of their variable
    rows = rows.withColumn("_mu", F.map_from_entries(F.transform("_sets", lambda s: F.struct(
        F.struct(s["at"].alias("at"), s["number"].alias("set")).alias("key"),
        F.coalesce(membership(F.get("_x", s["at"]), s["corners"]), F.lit(0.0)).alias("mu")))))

    def met(asked: Column, at: Column) -> Column:
        mu = F.try_element_at("_mu", F.struct(at.alias("at"), F.abs(asked).alias("set")))
        return F.when(asked < 0, 1 - mu).when(asked > 0, mu)

    def strength(r: Column) -> Column:
        parts = F.filter(F.transform(r["antecedents"], met), lambda m: m.isNotNull())
        return F.struct(r["consequent"].alias("key"), (r["weight"] * F.when(r["connective"] == "and", F.array_min(parts)).otherwise(F.array_max(parts))).alias("value"))

    rows = rows.withColumn("fired", F.filter(F.transform("_rules", strength), lambda e: e["value"] > 0))
    height = F.transform("samples", lambda p: F.struct(p["x"].alias("x"), F.array_max(F.transform(
        "fired", lambda e: F.least(e["value"], F.coalesce(F.try_element_at(p["heights"], e["key"]), F.lit(0.0))))).alias("h")))
    summed = F.aggregate("shape", F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("d")),
                         lambda s, p: F.struct((s["n"] + p["x"] * p["h"]).alias("n"), (s["d"] + p["h"]).alias("d")))
    return rows.withColumn("shape", F.when(F.size("fired") > 0, height)).withColumn("sum", summed) \
        .select(F.col("id").alias(id_col), F.when(F.col("sum.d") > 0, F.col("sum.n") / F.col("sum.d")).alias(out))
