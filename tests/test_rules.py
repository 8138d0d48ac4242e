"""Rule files as tables."""

import random

import pytest

from kiln.operators import fuzzy as fz
from kiln.operators import rules


def file_text():
    """The controller of the fixed values as a rule file."""
    kinds = {"tri": "trimf", "trap": "trapmf"}

    def variable(head, name, low, high, sets):
        lines = [f"[{head}]", f"Name='{name}'", f"Range=[{low} {high}]", f"NumMFs={len(sets)}"]
        return lines + [f"MF{n}='{s}':'{kinds[k]}',[{' '.join(map(str, p))}]" for n, (s, k, p) in enumerate(sets, 1)] + [""]

    lines = ["[System]", "Name='controller'", "Type='mamdani'", ""]
    lines += variable("Input1", "Y", -100, 100, fz.MF_Y) + variable("Input2", "THETA", -180, 180, fz.MF_THETA) + variable("Output1", "U", -30, 30, fz.MF_U)
    return "\n".join([*lines, "[Rules]", *(f"{y} {t}, {u} (1) : 1" for y, t, u in fz.RULES)])


def test_parser(spark):
    sets, table = rules.parse(spark, file_text())
    assert sets.count() == 19 and table.count() == 35
    assert tuple(sets.where("name = 'BE'").first()) == ("input", 1, "Y", -100.0, 100.0, 4, "BE", "trapmf", [10.0, 40.0, 100.0, 100.0])
    assert tuple(table.where("rule = 3").first()) == (3, [5, 7], 6, 1.0, "and")
    for bad in ("[Rules]\n1 2 3", "[Input1]\nName='a'\nRange=[0 1]\nMF1='x':'gaussmf',[1 2]", "[Input1]\nName='a'\nRange=[0 1]\nMF1='x':'trimf',[2 1 3]"):
        with pytest.raises(ValueError):
            rules.parse(spark, bad)


def test_score_equals_the_compiled_controller(spark):
    draw = random.Random(4)
    rows = [(k, draw.uniform(-110, 110), draw.uniform(-190, 190)) for k in range(150)] + [(900, None, 3.0), (901, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, y double, theta double")
    got = {r.id: r.u for r in rules.score(df, "id", ["y", "theta"], *rules.parse(spark, file_text())).collect()}
    want = {r.id: r.u for r in fz.mamdani(df.where("y IS NOT NULL"), "y", "theta").collect()}
    assert set(got) == {r[0] for r in rows} and got.pop(900) is None
    assert all(got[k] == pytest.approx(u, abs=1e-9) if u is not None else got[k] is None for k, u in want.items())


def test_other_rule_bases(spark):
    """Or, not, any and weights, with three inputs."""
    one = "MF1='low':'trapmf',[0 0 2 8]\nMF2='high':'trapmf',[2 8 10 10]\n"
    text = "".join(f"[Input{k}]\nName='x{k}'\nRange=[0 10]\n{one}" for k in (1, 2, 3))
    text += "[Output1]\nName='z'\nRange=[0 4]\nMF1='a':'trimf',[0 1 2]\nMF2='b':'trimf',[2 3 4]\n% comment\n[Rules]\n1 0 -2, 1 (0.5) : 1\n2 2 0, 2 (1) : 2\n"
    df = spark.createDataFrame([(1, 5.0, 0.0, 5.0), (2, 0.0, 0.0, 0.0), (3, 10.0, 1.0, 10.0)], "id int, p double, q double, r double")
    got = {r.id: r.u for r in rules.score(df, "id", ["p", "q", "r"], *rules.parse(spark, text), samples=401).collect()}

    def brute(p, q, r):
        low, high = (lambda x: max(0, min(1, (8 - x) / 6))), (lambda x: max(0, min(1, (x - 2) / 6)))
        a, b = 0.5 * min(low(p), 1 - high(r)), max(high(p), high(q))
        xs = [4 * k / 400 for k in range(401)]
        tri = lambda x, c: max(0, 1 - abs(x - c))
        h = [max(min(a, tri(x, 1)), min(b, tri(x, 3))) for x in xs]
        return sum(x * y for x, y in zip(xs, h, strict=True)) / sum(h) if sum(h) else None

    assert got == {k: pytest.approx(brute(p, q, r), abs=1e-9) for k, p, q, r in ((1, 5, 0, 5), (2, 0, 0, 0), (3, 10, 1, 10))}


def test_rows_are_scored_where_they_lie(spark):
    """Rows of one id have their own scores, a row without id too, and nothing is grouped by row."""
    df = spark.createDataFrame([(1, 50.0, 100.0), (1, -50.0, -100.0), (None, 0.0, 0.0)], "id long, y double, theta double")
    out = rules.score(df, "id", ["y", "theta"], *rules.parse(spark, file_text()))
    want = fz.mamdani(df, "y", "theta").select("id", "u").collect()
    order = lambda r: (r.id is None, r.u)
    got = sorted(out.collect(), key=order)
    assert [r.id for r in got] == [1, 1, None] and [r.u for r in got] == [pytest.approx(r.u, abs=1e-9) for r in sorted(want, key=order)]
    assert "hashpartitioning(id" not in out._jdf.queryExecution().executedPlan().toString()
