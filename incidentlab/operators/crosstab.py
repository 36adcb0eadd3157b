"""Category x outcome crosstab and the chi-square independence test.

The crosstab lives in long form ``(row, col, n)``; its size is the number of
category pairs that occur, not the number of incidents.  Totals are aggregates
joined back on the category, so no step depends on how many categories there
are; only the display pivot makes one column per category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from incidentlab.functions.stats import chi2_log_sf
from incidentlab.session import checkpoint


def materialize(long: DataFrame) -> DataFrame:
    """Write the category-sized long table once to the checkpoint folder, for
    callers that derive several results from it."""
    return checkpoint(long)


def crosstab_wide(long: DataFrame, row: str, col: str, n: str = "n", values: list | None = None) -> DataFrame:
    """One row per ``row`` value, one column per ``col`` value, missing cell 0.

    A null ``col`` value becomes a column named 'null' (with underscores
    appended where a category has that text).  The display form has a column
    per category, so its column list comes to the driver; Spark's own
    ``spark.sql.pivotMaxValues`` limits it."""
    if values is None:
        long = materialize(long)
        values = [r[0] for r in long.select(col).distinct().orderBy(F.col(col).asc_nulls_first()).collect()]
    names = ["null" if v is None else str(v) for v in values]
    while None in values and names.count(names[values.index(None)]) > 1:
        names[values.index(None)] += "_"
    # Positional names between pivot and result: a category may hold any text.
    wide = long.groupBy(row).pivot(col, values).agg(F.sum(n)).toDF("_row", *(f"_c{i}" for i in range(len(values))))
    cells = [F.coalesce(f"_c{i}", F.lit(0)).alias(name) for i, name in enumerate(names)]
    return wide.select(F.col("_row").alias(row), *cells)


def crosstab_percent(long: DataFrame, row: str, col: str, n: str = "n", scale: int | None = 6) -> DataFrame:
    """Each cell as a percentage of its row total."""
    pct = F.col(n) * 100.0 / F.sum(n).over(Window.partitionBy(row))
    return long.select(row, col, n, (F.round(pct, scale) if scale is not None else pct).alias("pct"))


def _totals(long: DataFrame, by: str, n: str, key: str, total: str) -> DataFrame:
    return long.groupBy(F.col(by).alias(key)).agg(F.sum(n).cast("double").alias(total))


def _margins(long: DataFrame, row: str, col: str, n: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summed cells, row totals and column totals."""
    cells = long.groupBy(F.col(row).alias("_r"), F.col(col).alias("_c")).agg(F.sum(n).alias("_n"))
    return cells, _totals(long, row, n, "_rk", "_rt"), _totals(long, col, n, "_ck", "_ct")


def chi_square_expected(long: DataFrame, row: str, col: str, n: str = "n", scale: int | None = 6) -> DataFrame:
    """Observed and expected frequency of every cell of the complete grid.

    The result is the product of the two category lists, so the two totals are
    combined, and the observed counts joined to it."""
    cells, rows, cols = _margins(long, row, col, n)
    grand = long.agg(F.sum(n).cast("double")).scalar()
    grid = rows.crossJoin(cols)  # the asked-for grid itself
    found = grid.join(cells, F.col("_rk").eqNullSafe(F.col("_r")) & F.col("_ck").eqNullSafe(F.col("_c")), "left")
    e = F.col("_rt") * F.col("_ct") / grand
    return found.select(
        F.col("_rk").alias(row),
        F.col("_ck").alias(col),
        F.coalesce("_n", F.lit(0)).alias("observed"),
        (F.round(e, scale) if scale is not None else e).alias("expected"),
    )


def chi_square(
    long: DataFrame, row: str, col: str, n: str = "n", correction: bool = True, scale: int | None = 4
) -> DataFrame:
    """X3 statistic: one row ``(chi2, dof)``.

    A cell that does not occur adds its expected count, so with E over the
    occurring cells only:  chi2 = sum((O - E)^2 / E) + (N - sum(E)).  No grid,
    no pivot.  With one degree of freedom and ``correction`` the Yates
    continuity correction moves each observed count up to 0.5 towards its
    expected count; that case has four cells, which are formed explicitly."""
    cells, rows, cols = _margins(long, row, col, n)
    n_rows, n_cols = (t.agg(F.count(F.lit(1))).scalar() for t in (rows, cols))
    grand = long.agg(F.sum(n).cast("double")).scalar()
    o = F.col("_n").cast("double")
    occurring = (
        cells.join(rows, F.col("_r").eqNullSafe(F.col("_rk")))
        .join(cols, F.col("_c").eqNullSafe(F.col("_ck")))
        .select(o.alias("o"), (F.col("_rt") * F.col("_ct") / grand).alias("e"))
    )
    total, expected = F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")), F.sum("e")
    stat = total + (F.sum("o") - expected)
    if correction:
        two = [t.filter(size == 2) for t, size in ((rows.withColumn("_one", F.lit(1)), n_rows), (cols.withColumn("_one", F.lit(1)), n_cols))]
        four = (
            two[0]
            .join(two[1], "_one")  # at most 2 x 2 rows
            .join(cells, F.col("_rk").eqNullSafe(F.col("_r")) & F.col("_ck").eqNullSafe(F.col("_c")), "left")
            .select(F.coalesce(o, F.lit(0.0)).alias("o"), (F.col("_rt") * F.col("_ct") / grand).alias("e"))
        )
        gap = F.abs(F.col("e") - F.col("o"))
        yates = four.agg(F.sum((gap - F.least(F.lit(0.5), gap)) ** 2 / F.col("e"))).scalar()
        # A table of 2 x 1 has no such cells: yates is null and the plain form stays.
        stat = F.coalesce(yates, stat)
    dof = ((n_rows - 1) * (n_cols - 1)).cast("bigint")
    return occurring.agg((F.round(stat, scale) if scale is not None else stat).alias("chi2")).select(
        "chi2", dof.alias("dof")
    )


def chi_square_test(long: DataFrame, row: str, col: str, n: str = "n", correction: bool = True) -> DataFrame:
    """X3 + K5: ``(chi2, p, log_p, dof)``; p from the chi-square tail, and its
    natural logarithm, which is finite where p is too small for a double."""
    stats = chi_square(long, row, col, n, correction, scale=None)
    stats = stats.withColumn("log_p", chi2_log_sf(F.col("chi2"), F.col("dof")))
    return stats.select("chi2", F.exp("log_p").alias("p"), "log_p", "dof")


def crosstab_top_rows(long: DataFrame, row: str, col: str, n: str = "n", top: int = 5, scale: int | None = 6) -> DataFrame:
    """Row percentages for the ``top`` rows ranked by total count
    (descending, ties by row value).  The top-``top`` list is a bounded
    TakeOrderedAndProject result, broadcast into a semi-join."""
    totals = long.groupBy(row).agg(F.sum(n).alias("_total"))
    keep = totals.orderBy(F.col("_total").desc(), F.col(row).asc_nulls_first()).limit(top).select(row)
    pct = crosstab_percent(long, row, col, n, scale)
    keep = F.broadcast(keep.withColumnRenamed(row, "_keep"))
    return pct.join(keep, pct[row].eqNullSafe(keep["_keep"]), how="left_semi")
