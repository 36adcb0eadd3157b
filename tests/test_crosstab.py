import math

import pytest
from pyspark.sql import functions as F

from incidentlab.operators import crosstab

# Published category x outcome counts (14 categories, 13 outcome
# columns; the first outcome column is the null outcome), with the published
# test result chi2 = 8684281.98, p = 0, dof = 156.
OUTCOMES = [
    None,
    "action to be taken by another organisation",
    "formal action is not in the public interest",
    "further action is not in the public interest",
    "further investigation is not in the public interest",
    "investigation complete; no suspect identified",
    "local resolution",
    "offender given a caution",
    "offender given a drugs possession warning",
    "offender given penalty notice",
    "suspect charged",
    "suspect charged as part of another case",
    "unable to prosecute suspect",
]
TABLE = {
    "anti-social behaviour": [1260059, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    "bicycle theft": [14339, 48, 116, 62, 151, 72193, 408, 108, 0, 1, 1794, 79, 8297],
    "burglary": [58438, 253, 909, 508, 561, 292479, 1595, 989, 4, 2, 24549, 1507, 59243],
    "criminal damage and arson": [133871, 2644, 3786, 3555, 4134, 497500, 20322, 10416, 8, 169, 41756, 145, 230088],
    "drugs": [60605, 809, 8779, 9828, 7427, 16269, 66702, 14305, 6489, 1430, 55745, 18, 34306],
    "other crime": [46252, 6865, 4100, 3472, 16968, 30558, 2645, 1539, 3, 19, 19754, 51, 80984],
    "other theft": [102815, 1968, 2379, 855, 3782, 423309, 5946, 1818, 1, 15, 9824, 305, 146364],
    "possession of weapons": [18559, 663, 1758, 1490, 1624, 14650, 2667, 3585, 14, 9, 24671, 2, 32081],
    "public order": [115024, 5612, 10283, 4857, 12406, 279113, 19808, 8017, 7, 1279, 61951, 67, 459773],
    "robbery": [14004, 109, 187, 194, 90, 36887, 874, 263, 4, 1, 8346, 36, 28905],
    "shoplifting": [88115, 349, 4661, 1234, 5850, 312091, 18359, 3736, 3, 590, 107982, 2864, 110909],
    "theft from the person": [8833, 170, 124, 56, 196, 47514, 460, 134, 1, 0, 1041, 15, 15713],
    "vehicle crime": [58778, 366, 642, 248, 605, 414152, 1048, 590, 5, 8, 14426, 712, 54088],
    "violence and sexual offences": [638084, 99816, 25473, 30171, 35095, 577328, 75465, 40709, 59, 233, 230424, 239, 2428945],
}
PUBLISHED_CHI2 = 8684281.98
PUBLISHED_DOF = 156


@pytest.fixture(scope="module")
def golden_long(spark):
    # Long form keeps only non-zero cells: the zero cells must come back from the grid.
    rows = [(t, o, n) for t, counts in TABLE.items() for o, n in zip(OUTCOMES, counts) if n]
    return spark.createDataFrame(rows, "crime_type string, outcome_type string, n bigint")


def test_golden_chi_square(golden_long):
    r = crosstab.chi_square_test(golden_long, "crime_type", "outcome_type").collect()[0]
    assert round(r["chi2"], 2) == PUBLISHED_CHI2
    assert r["dof"] == PUBLISHED_DOF
    assert f"{r['p']:.3g}" == "0" and r["log_p"] == pytest.approx(77 * math.log(r["chi2"] / 2) - r["chi2"] / 2 - math.lgamma(78), abs=0.01)


def test_golden_totals_and_grid(golden_long):
    grid = crosstab.chi_square_expected(golden_long, "crime_type", "outcome_type")
    assert grid.count() == 14 * 13
    assert sum(r["observed"] for r in grid.collect()) == 10_570_968
    smallest = min(r["expected"] for r in grid.collect())
    assert smallest == pytest.approx(26.38, abs=0.01)


def test_null_outcome_policy_matters(spark):
    # Without the null-outcome column (and the row that becomes empty) the statistic differs.
    rows = [(t, o, n) for t, counts in TABLE.items() for o, n in zip(OUTCOMES, counts) if n and o is not None]
    df = spark.createDataFrame(rows, "crime_type string, outcome_type string, n bigint")
    r = crosstab.chi_square(df, "crime_type", "outcome_type", scale=2).collect()[0]
    assert r["chi2"] == pytest.approx(3886596.13, abs=0.01)
    assert r["dof"] == 12 * 11


def test_wide_fills_zero_and_null_column(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", None, 1), ("b", "x", 3)], "r string, c string, n bigint")
    wide = crosstab.crosstab_wide(df, "r", "c")
    assert wide.columns == ["r", "null", "x"]
    assert sorted(tuple(x) for x in wide.collect()) == [("a", 1, 2), ("b", 0, 3)]


def test_category_texts_are_free(spark):
    """A category 'null' beside a true null, backticks and dots."""
    rows = [("a", "null", 2), ("a", None, 1), ("b", "x`y", 3), ("b", "p.q", 4), (None, "null", 5)]
    df = spark.createDataFrame(rows, "r string, c string, n bigint")
    wide = crosstab.crosstab_wide(df, "r", "c")
    assert wide.columns == ["r", "null_", "null", "p.q", "x`y"]
    assert sorted((tuple(x) for x in wide.collect()), key=str) == sorted([("a", 1, 2, 0, 0), ("b", 0, 0, 4, 3), (None, 0, 5, 0, 0)], key=str)
    grid = crosstab.chi_square_expected(df, "r", "c")
    assert grid.count() == 12 and sum(r["observed"] for r in grid.collect()) == 15
    assert crosstab.chi_square(df, "r", "c").first()["dof"] == 6


def test_many_categories(spark):
    df = spark.range(20_000).selectExpr("concat('r', id % 7) r", "concat('c', id % 5000) c", "1 + id % 3 n")
    long = df.groupBy("r", "c").agg(F.sum("n").alias("n"))
    cells = {(x["r"], x["c"]): x["n"] for x in long.collect()}
    rows, cols = {}, {}
    for (a, b), n in cells.items():
        rows[a] = rows.get(a, 0) + n
        cols[b] = cols.get(b, 0) + n
    total = sum(rows.values())
    want = sum((cells.get((a, b), 0) - x * y / total) ** 2 / (x * y / total) for a, x in rows.items() for b, y in cols.items())
    got = crosstab.chi_square(long, "r", "c", scale=None).first()
    assert got["dof"] == 6 * 4999 and got["chi2"] == pytest.approx(want, rel=1e-9)


def test_yates_with_an_empty_cell(spark):
    df = spark.createDataFrame([("a", "x", 10), ("b", "x", 30), ("b", "y", 5)], "r string, c string, n bigint")
    obs, rows, cols, tot = [[10, 0], [30, 5]], [10, 35], [40, 5], 45.0
    stat = 0.0
    for i in range(2):
        for j in range(2):
            e = rows[i] * cols[j] / tot
            gap = abs(e - obs[i][j])
            stat += (gap - min(0.5, gap)) ** 2 / e
    assert crosstab.chi_square(df, "r", "c", scale=None).first()["chi2"] == pytest.approx(stat, rel=1e-12)


def test_yates_two_by_two(spark):
    # scipy-style continuity correction for one degree of freedom.
    df = spark.createDataFrame([("a", "x", 10), ("a", "y", 20), ("b", "x", 30), ("b", "y", 5)], "r string, c string, n bigint")
    obs = [[10, 20], [30, 5]]
    tot = 65.0
    rows, cols = [30, 35], [40, 25]
    stat = 0.0
    for i in range(2):
        for j in range(2):
            e = rows[i] * cols[j] / tot
            o = obs[i][j]
            o += (1 if e > o else -1) * min(0.5, abs(e - o))
            stat += (o - e) ** 2 / e
    r = crosstab.chi_square(df, "r", "c", scale=None).collect()[0]
    assert r["dof"] == 1 and r["chi2"] == pytest.approx(stat, rel=1e-12)
    plain = crosstab.chi_square(df, "r", "c", correction=False, scale=None).collect()[0]
    assert plain["chi2"] > r["chi2"]


def test_percent_rows_sum_to_100_and_top_rows(golden_long):
    pct = crosstab.crosstab_percent(golden_long, "crime_type", "outcome_type", scale=None)
    sums = {r[0]: r[1] for r in pct.groupBy("crime_type").sum("pct").collect()}
    assert all(abs(v - 100.0) < 1e-9 for v in sums.values())
    top = {r[0] for r in crosstab.crosstab_top_rows(golden_long, "crime_type", "outcome_type", top=5).collect()}
    # Ranked by total count, not by the sum of percentages.
    assert top == {"violence and sexual offences", "anti-social behaviour", "public order",
                   "criminal damage and arson", "other theft"}


def test_chi_square_permutation_invariant(spark):
    rows = [("a", "x", 5), ("a", "y", 9), ("b", "x", 7), ("b", "z", 4), ("c", "y", 3), ("c", "z", 8)]
    df1 = spark.createDataFrame(rows, "r string, c string, n bigint")
    relabel = {"a": "q", "b": "a", "c": "m"}
    df2 = spark.createDataFrame([(relabel[r], c, n) for r, c, n in rows], "r string, c string, n bigint")
    a = crosstab.chi_square(df1, "r", "c", scale=None).collect()[0]
    b = crosstab.chi_square(df2, "r", "c", scale=None).collect()[0]
    assert a["dof"] == b["dof"] == 4 and a["chi2"] == pytest.approx(b["chi2"], rel=1e-12)


def test_chi_square_test_runs_no_python(golden_long):
    plan = crosstab.chi_square_test(golden_long, "crime_type", "outcome_type")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
