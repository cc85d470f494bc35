"""Drift of feature distributions between two periods.

All watched columns go through one aggregation: rows become (column, value) pairs counted
per period before the shuffle. Every distance then works on distinct values as they are,
whatever the number of rows.

Where columns have about as many values as rows, ``sketched_drift`` needs no shuffle of values: quantile
sketches of bounded size, a pair for each column, are merged instead. Sketches can be kept, by month for
instance, and merged later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions import calendar
from orderlens.functions.measures import count_of, half_up
from orderlens.operators import evaluation
from orderlens.operators.blocks import in_blocks
from orderlens.session import staged

#: Size of a quantile sketch: its ranks are within 0.08 % of the exact ones, in all but one case in a hundred.
SKETCH_K = 4096
#: So many evenly spaced quantiles stand for the rows of a period.
SKETCH_POINTS = 4096
WIDE = "decimal(38,0)"
PSI_BANDS = 10
PSI_FLOOR = 0.0001  # Fixed value: share given to an empty band.
MIN_NORM = 0.001  # Fixed value: least standard deviation a distance is divided by.


def with_period(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Rows of the two periods, marked by ``period``. The years of both are also filtered
    on the stored partition column, so other years are not read."""
    (ref_from, ref_to), (cur_from, cur_to) = settings.reference_years, settings.current_years
    year = F.col("purchase_year")
    wanted = year.between(ref_from, ref_to) | year.between(cur_from, cur_to)
    return silver.where(wanted).withColumn(
        "period", calendar.period("purchase_year", settings.reference_years, settings.current_years)
    )


def _number(rows: DataFrame, name: str) -> str:
    """A type between a column's own and a double."""
    own = dict(rows.dtypes)[name]
    return "int" if own == "boolean" else own


def value_counts(rows: DataFrame, columns: tuple[str, ...], names: tuple[str, ...] = ()) -> DataFrame:
    """(column_name, value, n_ref, n_cur): how often each value occurs per period. Nulls are left out.

    ``names`` is given where the one column holds values of several, whose name stands beside them."""
    wide = rows.select("period", *names, *[F.col(c).cast(_number(rows, c)).cast("double").alias(c) for c in columns])
    long = wide if names else wide.unpivot("period", list(columns), "column_name", "value")
    return long.where("value IS NOT NULL").groupBy("column_name", "value").agg(
        count_of(F.col("period") == "reference").alias("n_ref"),
        count_of(F.col("period") == "current").alias("n_cur"),
    )


def _blocks(counts: DataFrame) -> DataFrame:
    """Per column and block of values: counts before it, the column's totals, the next block's first value."""
    sums = counts.groupBy("column_name", "block").agg(
        F.sum("n_ref").alias("ref"), F.sum("n_cur").alias("cur"), F.min("value").alias("first"),
        F.max("value").alias("last"), F.count("*").alias("values"),
    )
    along = Window.partitionBy("column_name").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    column = Window.partitionBy("column_name")
    return sums.select(
        "column_name",
        "block",
        F.coalesce(F.sum("ref").over(before), F.lit(0)).alias("ref_before"),
        F.coalesce(F.sum("cur").over(before), F.lit(0)).alias("cur_before"),
        F.sum("ref").over(column).alias("total_ref"),
        F.sum("cur").over(column).alias("total_cur"),
        F.sum("values").over(column).alias("n_values"),
        F.min("first").over(column).alias("lowest"),
        F.max("last").over(column).alias("highest"),
        F.lead("first").over(along).alias("next_first"),
    )


def _entropy_term(share: Column, mixed: Column) -> Column:
    return F.when(share > 0, share * F.log(F.try_divide(share, mixed))).otherwise(0.0)


def distances(counts: DataFrame) -> DataFrame:
    """Per column, from its value counts:

    * ``wasserstein``: area between the two cumulative curves over the reference's standard deviation
    * ``ks``: largest gap between the curves
    * ``jensen_shannon``: square root of the divergence (natural logarithm) of the value shares
    * ``psi``: stability index over ten bands of equal width

    Cumulative counts are added block by block in parallel: blocks hold about as many values each, and
    their totals give each its start, so no column is sorted as a whole.
    """
    counts = in_blocks(counts, "column_name", "value")
    positioned = counts.join(_blocks(counts), ["column_name", "block"])
    inside = Window.partitionBy("column_name", "block").orderBy("value")
    upto_ref = F.col("ref_before") + F.sum("n_ref").over(inside)
    upto_cur = F.col("cur_before") + F.sum("n_cur").over(inside)
    following = F.coalesce(F.lead("value").over(inside), F.col("next_first"))
    gap = F.abs(
        upto_ref.cast("decimal(19,0)") * F.col("total_cur").cast("decimal(19,0)")
        - upto_cur.cast("decimal(19,0)") * F.col("total_ref").cast("decimal(19,0)")
    ).cast(WIDE)
    width = F.coalesce(following - F.col("value"), F.lit(0.0))
    pairs_of_rows = F.col("total_ref").cast("double") * F.col("total_cur").cast("double")
    p = F.try_divide(F.col("n_ref").cast("double"), F.col("total_ref").cast("double"))
    q = F.try_divide(F.col("n_cur").cast("double"), F.col("total_cur").cast("double"))
    mixed = (p + q) / 2
    span = F.col("highest") - F.col("lowest")
    tenth = F.floor((F.col("value") - F.col("lowest")) * PSI_BANDS / span)
    band = F.when(span > 0, F.least(tenth, F.lit(PSI_BANDS - 1))).otherwise(0).cast("int")
    points = positioned.select(
        "column_name",
        "n_values",
        "total_ref",
        "total_cur",
        "n_ref",
        "n_cur",
        "value",
        gap.alias("gap"),
        (F.try_divide(gap.cast("double"), pairs_of_rows) * width).alias("area"),
        (_entropy_term(p, mixed) + _entropy_term(q, mixed)).alias("divergence"),
        band.alias("band"),
    )
    # Bands first (ten per column), then columns: both combine before their shuffle.
    value, n = F.col("value").cast("double"), F.col("n_ref").cast("double")
    banded = points.groupBy("column_name", "n_values", "total_ref", "total_cur", "band").agg(
        F.sum("n_ref").cast("double").alias("ref"),
        F.sum("n_cur").cast("double").alias("cur"),
        F.max("gap").alias("gap"),
        F.sum("area").alias("area"),
        F.sum("divergence").alias("divergence"),
        F.sum(value * n).alias("first_moment"),
        F.sum(value * value * n).alias("second_moment"),
    )
    share_ref = F.try_divide(F.col("ref"), F.col("total_ref").cast("double"))
    share_cur = F.try_divide(F.col("cur"), F.col("total_cur").cast("double"))
    floored_ref = F.when(share_ref > 0, share_ref).otherwise(PSI_FLOOR)
    floored_cur = F.when(share_cur > 0, share_cur).otherwise(PSI_FLOOR)
    per_column = banded.groupBy("column_name", "n_values", "total_ref", "total_cur").agg(
        F.max("gap").cast("double").alias("gap"),
        F.sum("area").alias("area"),
        F.sum("divergence").alias("divergence"),
        F.sum("first_moment").alias("first_moment"),
        F.sum("second_moment").alias("second_moment"),
        F.sum((floored_cur - floored_ref) * F.log(floored_cur / floored_ref)).alias("psi"),
    )
    total_ref = F.col("total_ref").cast("double")
    pairs = total_ref * F.col("total_cur").cast("double")
    average = F.try_divide("first_moment", total_ref)
    variance = F.greatest(F.try_divide("second_moment", total_ref) - average * average, F.lit(0.0))
    norm = F.greatest(F.sqrt(variance), F.lit(MIN_NORM))
    known = F.col("total_ref") * F.col("total_cur") > 0
    return per_column.select(
        "column_name",
        "n_values",
        "total_ref",
        "total_cur",
        F.when(known, half_up(F.col("area") / norm, 6)).alias("wasserstein"),
        F.when(known, half_up(F.try_divide("gap", pairs), 6)).alias("ks"),
        F.when(known, half_up(F.sqrt(F.greatest(F.col("divergence") / 2, F.lit(0.0))), 6)).alias("jensen_shannon"),
        F.when(known, half_up(F.greatest(F.col("psi"), F.lit(0.0)), 6)).alias("psi"),
    )


def column_drift(rows: DataFrame, settings: Settings = DEFAULTS, columns: tuple[str, ...] | None = None) -> DataFrame:
    """Every distance per column, the one that decides, and whether the column drifted.

    Few distinct values: Jensen-Shannon, otherwise Wasserstein.
    """
    return judge(distances(value_counts(rows, columns or settings.watched)), settings)


def sketches(rows: DataFrame, columns: tuple[str, ...], k: int = SKETCH_K, by: tuple[str, ...] = ()) -> DataFrame:
    """What ``sketched_distances`` needs to know of each column and period (and of each ``by``, a month for instance): a quantile
    sketch, a sketch of the distinct values and the count. Nulls are left out."""
    wide = rows.select("period", *by, *[F.col(c).cast(_number(rows, c)).cast("double").alias(c) for c in columns])
    long = wide.unpivot(["period", *by], list(columns), "column_name", "value").where("value IS NOT NULL AND period IS NOT NULL")
    return long.groupBy("column_name", "period", *by).agg(
        F.kll_sketch_agg_double("value", F.lit(k)).alias("quantiles"),
        F.hll_sketch_agg(F.col("value").cast("string")).alias("distinct"),
        F.count("*").alias("n"),
    )


def merged_sketches(states: DataFrame) -> DataFrame:
    """Stored sketches of a column and period as one."""
    return states.groupBy("column_name", "period").agg(
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.sum("n").alias("n"),
    )


def sketched_distances(states: DataFrame, points: int = SKETCH_POINTS) -> DataFrame:
    """The columns of ``distances`` from a row for each column and period, taken over evenly spaced quantiles.

    Cumulative shares, and so ``ks``, are within the sketches' rank errors plus one in ``points`` of the exact ones.
    ``n_values`` is an estimate, exact when small.
    """
    ranks = F.from_json(F.lit(str([(i + 0.5) / points for i in range(points)])), "array<double>")
    drawn = states.select("column_name", "period", F.explode(F.kll_sketch_get_quantile_double("quantiles", ranks)).alias("value"))
    counts = value_counts(drawn.select("period", "column_name", "value"), ("value",), ("column_name",))
    measured = distances(counts).drop("n_values", "total_ref", "total_cur")
    sizes = states.groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_values"),
        *[
            F.coalesce(F.sum(F.when(F.col("period") == name, F.col("n"))), F.lit(0)).alias(total)
            for name, total in (("reference", "total_ref"), ("current", "total_cur"))
        ],
    )
    # A row a column on either side.
    return sizes.join(measured, "column_name", "left")


def sketched_drift(
    rows: DataFrame, settings: Settings = DEFAULTS, columns: tuple[str, ...] | None = None, k: int = SKETCH_K
) -> DataFrame:
    """``column_drift`` by sketches: one aggregation whose state is bounded, whatever the number of rows or values."""
    return judge(sketched_distances(staged(sketches(rows, columns or settings.watched, k), "sketches")), settings)


def judge(measured: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    few = F.col("n_values") <= settings.small_domain
    score = F.when(few, F.col("jensen_shannon")).otherwise(F.col("wasserstein"))
    return measured.select(
        "column_name",
        "n_values",
        "total_ref",
        "total_cur",
        "wasserstein",
        "ks",
        "jensen_shannon",
        "psi",
        F.when(few, "jensen_shannon").otherwise("wasserstein").alias("method"),
        score.alias("score"),
        F.coalesce(score >= settings.column_drift, F.lit(False)).alias("drifted"),
    )


def dataset_drift(judged: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: drifted columns, their share, and whether the whole set counts as drifted."""
    counts = judged.agg(F.count("*").alias("n_columns"), count_of(F.col("drifted")).alias("n_drifted"))
    share = F.coalesce(
        F.try_divide(F.col("n_drifted").cast("double"), F.col("n_columns").cast("double")), F.lit(0.0)
    )
    return counts.select(
        "n_columns",
        "n_drifted",
        share.alias("share_drifted"),
        (share >= settings.dataset_drift_share).alias("drift_detected"),
    )


def tests_pass(settings: Settings = DEFAULTS) -> Column:
    few = F.col("n_drifted") < settings.max_drifted_columns
    return few & (F.col("share_drifted") < settings.max_drifted_share)


def drift_tests(dataset: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Two tests and whether both passed, each in its row."""
    return dataset.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("number_of_drifted_columns").alias("test"),
                    (F.col("n_drifted") < settings.max_drifted_columns).alias("passed"),
                ),
                F.struct(
                    F.lit("share_of_drifted_columns").alias("test"),
                    (F.col("share_drifted") < settings.max_drifted_share).alias("passed"),
                ),
                F.struct(
                    F.lit("all").alias("test"),
                    tests_pass(settings).alias("passed"),
                ),
            )
        ).alias("t")
    ).select("t.*")


def outcome_metrics(counts: DataFrame) -> DataFrame:
    """Precision and recall per period from the value counts of ``outcome`` (2 x label + prediction)."""
    code = F.col("value").cast("int")
    per_period = counts.unpivot(["value"], ["n_ref", "n_cur"], "side", "n").select(
        F.when(F.col("side") == "n_ref", "reference").otherwise("current").alias("period"),
        F.floor(code / 2).cast("int").alias("label"),
        (code % 2).cast("int").alias("prediction"),
        "n",
    )
    return evaluation.classification_by_period(per_period.where("n > 0"), weight="n")


def monitoring_summary(dataset: DataFrame, by_period: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One record: drift, performance in the current period, tests, and whether to act."""
    # Both inputs are one row at most: stacked and folded into one record.
    current = by_period.where("period = 'current'").select("precision", "recall")
    folded = dataset.unionByName(current, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("n_drifted", "share_drifted", "drift_detected")],
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in ("precision", "recall")],
    )
    found = folded.withColumn("passed", tests_pass(settings))
    weak = F.col("recall") < settings.min_recall
    return found.select(
        F.lit(settings.period_label(settings.reference_years)).alias("reference_period"),
        F.lit(settings.period_label(settings.current_years)).alias("current_period"),
        F.struct(
            F.col("drift_detected").alias("detected"),
            half_up(F.col("share_drifted"), 3).alias("share_drifted"),
            F.when(F.col("drift_detected"), "DERIVE DETECTEE").otherwise("Stable").alias("status"),
        ).alias("data_drift"),
        F.struct(
            half_up(F.col("precision"), 3).alias("precision"),
            half_up(F.col("recall"), 3).alias("recall"),
            F.when(weak, "DEGRADATION").otherwise("Acceptable").alias("status"),
        ).alias("model_performance"),
        F.struct(
            F.col("passed").alias("all_passed"),
            F.when(F.col("passed"), "OK").otherwise("TESTS ECHOUES").alias("status"),
        ).alias("tests"),
        (F.col("drift_detected") | weak | ~F.col("passed")).alias("action_required"),
    )
