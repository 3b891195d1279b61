"""Distribution drift between a reference and a current frame, computed on the executors.

Values that repeat are counted map side first; those that hardly do are shuffled as they are. Numeric columns need
running sums over the sorted values. To keep those off a single task per column, values are laid out in buckets between
quantiles: running sums are taken inside a bucket and start from the totals of the buckets before it. The
quantiles decide the layout only; every value is counted, and results do not depend on them.
"""

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tideline.functions.statistics import chi2_p_value, ks_p_value

# --- fixed values: choice of test and thresholds -----------------------------------------------------
FEW_VALUES = 5  # a numeric column with at most this many distinct reference values is categorical
P_VALUE_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
DRIFT_SHARE = 0.5  # a data set drifts when at least this share of its columns does
LEAST_BUCKETS = 256
LAYOUT_ROWS = 40  # sampled rows per bucket that the bucket bounds are read from
SPREAD_FLOOR = 0.001  # least standard deviation the Wasserstein distance is divided by
# -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class DriftSettings:
    """How columns are compared. The method is the caller's choice and the same at every size: "distance" (normed
    Wasserstein and Jensen-Shannon) or "p-value" (Kolmogorov-Smirnov, chi-square and z)."""

    method: str = "distance"
    approximate_tails: bool = False  # normal approximation in place of the exact chi-square sum over all degrees
    few_values: int = FEW_VALUES
    p_value_threshold: float = P_VALUE_THRESHOLD
    distance_threshold: float = DISTANCE_THRESHOLD
    drift_share: float = DRIFT_SHARE
    spread_floor: float = SPREAD_FLOOR
    buckets: int | None = None  # per numeric column; None: four per shuffle partition


def comparable_columns(
    reference: DataFrame, current: DataFrame, exclude: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns that both frames have, less the excluded ones."""
    shared = [f for f in reference.schema.fields if f.name in current.columns and f.name not in exclude]
    numeric = [f.name for f in shared if isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in shared if isinstance(f.dataType, (T.StringType, T.BooleanType))]
    return numeric, categorical


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def cell(name: str, as_type: str) -> str:
    """A column's value as SQL text. Zero has one sign, or a bucket bound at zero would tell two of them apart."""
    return f"try_cast({quoted(name)} AS {as_type})" + (" + 0D" if as_type == "double" else "")


def _sides(reference: DataFrame, current: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """Both frames, their columns renamed to v0, v1, ..., marked (1, 0) for the reference and (0, 1) for the other.

    Text that is no number counts as missing, as null does."""
    values = ", ".join(f"{cell(name, as_type)} AS v{i}" for i, name in enumerate(columns))
    return reference.sparkSession.sql(
        f"""SELECT 1L AS _r, 0L AS _c, {values} FROM {{reference}}
        UNION ALL SELECT 0L, 1L, {values} FROM {{current}}""",
        reference=reference,
        current=current,
    )


def _sampled(df: DataFrame, buckets: int) -> list[Row]:
    """Rows that the layout is read from: about LAYOUT_ROWS for each bucket, whatever the table's size, as a range
    partitioner takes them. The count that sets the sample's share is one number a task."""
    rows = df.count()
    return df.sample(min(1.0, LAYOUT_ROWS * buckets / rows), seed=1).collect() if rows else []


def _layout(sample: Sequence[Row], columns: Sequence[str], buckets: int) -> list[list[float]]:
    """Per column, increasing bucket bounds with open ends. They only have to be about right: no result depends on them."""
    bounds = []
    for name in columns:
        values = sorted(r[name] for r in sample if r[name] is not None and r[name] == r[name] and abs(r[name]) != float("inf"))
        inner = sorted({values[len(values) * k // buckets] for k in range(1, buckets)}) if values else []
        bounds.append([-float("inf"), *(inner or [0.0]), float("inf")])
    return bounds


def _repeats(sample: Sequence[Row], name: str, side: str, buckets: int) -> bool:
    """Whether a side's values are worth counting before the shuffle: half of the sample's occur again, or one of them
    would fill a bucket. No result depends on it."""
    found = Counter(r[name] for r in sample if r[side] and r[name] is not None)
    return 2 * len(found) < found.total() or max(found.values(), default=0) * buckets > len(sample)


def bucket_bounds(df: DataFrame, columns: Sequence[str], settings: DriftSettings = DriftSettings()) -> list[list[float]]:
    """Bucket bounds of numeric columns, as laid out from one frame."""
    values = [f"v{i}" for i in range(len(columns))]
    cells = df.selectExpr(*(f"{cell(c, 'double')} AS {v}" for c, v in zip(columns, values, strict=True)))
    buckets = _bucket_count(df, settings)
    return _layout(_sampled(cells, buckets), values, buckets)


def _bucket_count(df: DataFrame, settings: DriftSettings) -> int:
    """Several buckets per task, so that tasks even out."""
    return settings.buckets or max(LEAST_BUCKETS, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def numeric_cells(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], settings: DriftSettings = DriftSettings()
) -> DataFrame:
    """(place, bucket, value, r, c): occurrences of values on either side, by the column's place in the list.

    A value may have several rows, all of them in the task of its bucket. Null and NaN are left out.
    """
    both = _sides(reference, current, columns, "double")
    values = [f"v{i}" for i in range(len(columns))]
    buckets = _bucket_count(both, settings)
    sample = _sampled(both, buckets)
    placed = Bucketizer(
        splitsArray=_layout(sample, values, buckets),
        inputCols=values,
        outputCols=[f"bucket_of_{v}" for v in values],
        handleInvalid="keep",
    ).transform(both)
    repeating = {(side, v) for side in ("_r", "_c") for v in values if _repeats(sample, v, side, buckets)}
    # The null checks on the keys are what the join on them would infer on one of its sides only; stated here, both
    # sides have the same plan and the shuffle of the cells is done once and reused.
    kept = "place IS NOT NULL AND bucket IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)"

    def cells(side: str, repeat: bool) -> list[str]:
        entries = ", ".join(
            f"struct({i} AS place, cast(bucket_of_{v} AS int) AS bucket, {v} AS value)"
            for i, v in enumerate(values)
            if ((side, v) in repeating) == repeat
        )
        entries = entries and f"SELECT _r AS r, _c AS c, inline(array({entries})) FROM {{placed}} WHERE {side} = 1"
        return [f"SELECT place, bucket, value, r, c FROM ({entries}) WHERE {kept}"] if entries else []

    parts = cells("_r", False) + cells("_c", False)
    if repeated := cells("_r", True) + cells("_c", True):
        parts.append(
            f"""SELECT place, bucket, value, sum(r) AS r, sum(c) AS c
            FROM ({" UNION ALL ".join(repeated)}) GROUP BY place, bucket, value"""
        )
    return reference.sparkSession.sql(" UNION ALL ".join(parts), placed=placed).repartition("place", "bucket")


def numeric_counts(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], settings: DriftSettings = DriftSettings()
) -> DataFrame:
    """(place, bucket, value, r, c) as `numeric_cells`, a row for each value."""
    cells = numeric_cells(reference, current, columns, settings)
    return cells.groupBy("place", "bucket", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def categorical_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place, value, r, c): occurrences of each category on either side; null is left out."""
    entries = ", ".join(f"struct({i} AS place, v{i} AS value)" for i in range(len(columns)))
    return reference.sparkSession.sql(
        f"""SELECT place, value, sum(_r) AS r, sum(_c) AS c
        FROM (SELECT _r, _c, inline(array({entries})) FROM {{both}})
        WHERE place IS NOT NULL AND value IS NOT NULL
        GROUP BY place, value""",
        both=_sides(reference, current, columns, "string"),
    )


_SIZES = """max(n) AS reference_rows, max(m) AS current_rows,
    count_if(r > 0) AS reference_values, count(1) AS all_values"""


def _category_aggregates(where: str) -> str:
    """Jensen-Shannon distance and chi-square of the two-row table of counts (r, c) with totals (n, m)."""
    counted = f"n > 0 AND m > 0 AND {where}"
    return f"""
        sqrt(greatest(0D, sum(if({counted},
            if(r > 0, r / n * ln(2D * (r / n) / (r / n + c / m)), 0D)
            + if(c > 0, c / m * ln(2D * (c / m) / (r / n + c / m)), 0D), NULL)) / 2D)) AS jensen_shannon,
        sum(if({counted},
            pow(r - n * ((r + c) / (n + m)), 2) / (n * ((r + c) / (n + m)))
            + pow(c - m * ((r + c) / (n + m)), 2) / (m * ((r + c) / (n + m))), NULL)) AS chi2"""


def numeric_statistics(
    cells: DataFrame, columns: Sequence[str], settings: DriftSettings = DriftSettings()
) -> DataFrame:
    """One row per numeric column: KS distance, Wasserstein distance plain and normed.

    The category statistics are filled in for columns with so few values that they count as categories. The
    offsets are at most (buckets + 1) rows per column: small enough for one task per column, and to broadcast.
    """
    # Rows of one value are peers, so running sums by RANGE end alike on each; the last of them stands for the value.
    # The totals ask for the value, which is no NaN, lest a query of fewer columns shuffle the cells without it again.
    return cells.sparkSession.sql(
        f"""
        WITH totals AS (
          SELECT place, bucket, sum(if(isnan(value), 0L, r)) AS r, sum(c) AS c, min(value) AS least_value,
            sum(r * value) AS sum_r
          FROM {{cells}} GROUP BY place, bucket),
        offsets AS (
          SELECT place, bucket,
            (sum(r) OVER in_order) - r AS r_before, (sum(c) OVER in_order) - c AS c_before,
            lead(least_value) OVER in_order AS next_bucket_value,
            sum(r) OVER whole AS n, sum(c) OVER whole AS m,
            try_divide(sum(sum_r) OVER whole, sum(r) OVER whole) AS mean
          FROM totals
          WINDOW whole AS (PARTITION BY place), in_order AS (PARTITION BY place ORDER BY bucket)),
        running AS (
          SELECT place, bucket, value, sum(r) OVER peers AS r, sum(c) OVER peers AS c,
            sum(r) OVER upto AS r_upto, sum(c) OVER upto AS c_upto, lead(value) OVER inside AS next_in_bucket
          FROM {{cells}}
          WINDOW inside AS (PARTITION BY place, bucket ORDER BY value),
            peers AS (PARTITION BY place, bucket ORDER BY value RANGE BETWEEN CURRENT ROW AND CURRENT ROW),
            upto AS (PARTITION BY place, bucket ORDER BY value ROWS UNBOUNDED PRECEDING)),
        steps AS (
          SELECT /*+ BROADCAST(offsets) */ place, value, r, c, n, m, mean,
            abs(try_divide(r_before + r_upto, n) - try_divide(c_before + c_upto, m)) AS gap,
            coalesce(next_in_bucket, next_bucket_value, value) AS next_value
          FROM running JOIN offsets USING (place, bucket)
          WHERE next_in_bucket IS NULL OR next_in_bucket <> value),
        found AS (
          SELECT place, {_SIZES}, {_category_aggregates("true")},
            max(gap) AS ks, sum(gap * (next_value - value)) AS wasserstein,
            sqrt(try_divide(sum(r * pow(value - mean, 2)), max(n))) AS spread
          FROM steps GROUP BY place)
        SELECT element_at(:names, place + 1) AS column, 'numeric' AS kind,
          reference_rows, current_rows, reference_values, all_values,
          if(reference_values <= {settings.few_values}, jensen_shannon, 0D) AS jensen_shannon,
          if(reference_values <= {settings.few_values}, chi2, NULL) AS chi2, ks, wasserstein,
          wasserstein / greatest(spread, {settings.spread_floor}D) AS wasserstein_normed
        FROM found""",
        args={"names": list(columns)},
        cells=cells,
    )


def numeric_quantiles(
    df: DataFrame, columns: Sequence[str], levels: Sequence[float], settings: DriftSettings = DriftSettings()
) -> DataFrame:
    """One row per column with a value: (column, n, mean, sd, quantiles), exact, over all rows.

    From the same cells in buckets as the drift statistics, so neither a column nor a sketch of it meets in one task.
    The quantile at a level is the least value that at least that share of the values does not exceed.
    """
    cells = numeric_cells(df, df.filter(F.lit(False)), columns, settings)
    found = ", ".join(f"min(if(upto >= ceil({level}D * n), value, NULL))" for level in levels)
    return df.sparkSession.sql(
        f"""
        WITH totals AS (SELECT place, bucket, sum(r) AS r, sum(r * value) AS s FROM {{cells}} GROUP BY place, bucket),
        offsets AS (
          SELECT place, bucket, (sum(r) OVER in_order) - r AS before,
            sum(r) OVER whole AS n, (sum(s) OVER whole) / (sum(r) OVER whole) AS mean
          FROM totals
          WINDOW whole AS (PARTITION BY place), in_order AS (PARTITION BY place ORDER BY bucket)),
        running AS (
          SELECT place, bucket, value, r,
            sum(r) OVER (PARTITION BY place, bucket ORDER BY value ROWS UNBOUNDED PRECEDING) AS inside
          FROM {{cells}}),
        ranked AS (
          SELECT /*+ BROADCAST(offsets) */ place, value, r, n, mean, before + inside AS upto
          FROM running JOIN offsets USING (place, bucket))
        SELECT element_at(:names, place + 1) AS column, max(n) AS n, max(mean) AS mean,
          sqrt(sum(r * pow(value - mean, 2)) / max(n)) AS sd, array({found}) AS quantiles
        FROM ranked GROUP BY place""",
        args={"names": list(columns)},
        cells=cells,
    )


def categorical_statistics(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per categorical column, with null for the statistics that need an order.

    The totals are one row per column: broadcast, so that a column with many categories is not gathered in one task.
    """
    return counts.sparkSession.sql(
        f"""
        WITH totals AS (SELECT place, sum(r) AS n, sum(c) AS m FROM {{counts}} GROUP BY place),
        found AS (
          SELECT /*+ BROADCAST(totals) */ place, {_SIZES}, {_category_aggregates("true")}
          FROM {{counts}} JOIN totals USING (place) GROUP BY place)
        SELECT element_at(:names, place + 1) AS column, 'categorical' AS kind,
          reference_rows, current_rows, reference_values, all_values, jensen_shannon, chi2,
          cast(NULL AS double) AS ks, cast(NULL AS double) AS wasserstein, cast(NULL AS double) AS wasserstein_normed
        FROM found""",
        args={"names": list(columns)},
        counts=counts,
    )


def drift_statistics(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """All statistics for every shared column (or the given ones), one row each."""
    numeric, categorical = comparable_columns(reference, current, exclude)
    if columns is not None:
        numeric, categorical = ([c for c in kind if c in columns] for kind in (numeric, categorical))
    parts = []
    if numeric:
        cells = numeric_cells(reference, current, numeric, settings)
        parts.append(numeric_statistics(cells, numeric, settings))
    if categorical:
        counts = categorical_counts(reference, current, categorical)
        parts.append(categorical_statistics(counts, categorical))
    if not parts:
        raise ValueError("no comparable columns")
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    run_date: str | None = None,
    columns: Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """The verdict per column: (date, column, kind, method, statistic, threshold, drifted)."""
    return judged(drift_statistics(reference, current, columns, exclude, settings), run_date, settings)


def judged(found: DataFrame, run_date: str | None = None, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """The verdict per column from its statistics."""
    if settings.method not in ("distance", "p-value"):
        raise ValueError(f"unknown method {settings.method!r}")
    small = "true" if settings.method == "p-value" else "false"
    ordered = f"kind = 'numeric' AND reference_values > {settings.few_values}"
    # The squared z of two proportions is the chi-square of their table, with the same tail.
    # A column that is empty on one side has no distribution left to agree with.
    return found.sparkSession.sql(
        f"""
        WITH judged AS (
          SELECT column, kind,
            CASE WHEN {small} AND {ordered} THEN 'ks p-value'
              WHEN {small} AND all_values <= 2 THEN 'z p-value'
              WHEN {small} THEN 'chi-square p-value'
              WHEN {ordered} THEN 'wasserstein normed'
              ELSE 'jensen-shannon' END AS method,
            CASE WHEN reference_rows = 0 OR current_rows = 0 THEN NULL
              WHEN {small} AND {ordered} THEN {ks_p_value("ks", "reference_rows", "current_rows")}
              WHEN {small} THEN {chi2_p_value("chi2", "(all_values - 1)", settings.approximate_tails)}
              WHEN {ordered} THEN wasserstein_normed
              ELSE jensen_shannon END AS statistic,
            if({small}, {settings.p_value_threshold}D, {settings.distance_threshold}D) AS threshold
          FROM {{found}})
        SELECT {"cast(current_date() AS string)" if run_date is None else ":run_date"} AS date,
          column, kind, method, statistic, threshold,
          coalesce(if(endswith(method, 'p-value'), statistic < threshold, statistic >= threshold), true) AS drifted
        FROM judged""",
        args={} if run_date is None else {"run_date": run_date},
        found=found,
    )


def dataset_flag(
    report: DataFrame, name: str = "drift_detected", settings: DriftSettings = DriftSettings()
) -> DataFrame:
    """One row (date, flag): whether the drifted share of columns reaches the limit."""
    share = F.avg(F.col("drifted").cast("double"))
    return report.groupBy("date").agg((share >= settings.drift_share).alias(name))


def target_drift_report(
    reference: DataFrame,
    current: DataFrame,
    reference_column: str,
    current_column: str = "prediction",
    run_date: str | None = None,
    settings: DriftSettings = DriftSettings(),
) -> DataFrame:
    """Drift of one column pair: what the model returns against the target it was trained on."""
    return drift_report(
        reference.select(reference_column),
        current.select(F.col(current_column).alias(reference_column)),
        run_date,
        settings=settings,
    )


def alerts(*flags: DataFrame) -> DataFrame:
    """(date, alert) for every flag table whose flag is set."""
    feeds = [
        df.select("date", F.lit(name).alias("alert"), F.col(name).alias("_on")).filter("_on").drop("_on")
        for df in flags
        for name in df.columns
        if name != "date"
    ]
    feed = feeds[0]
    for other in feeds[1:]:
        feed = feed.unionByName(other)
    return feed


def flag_rows(*flags: DataFrame) -> DataFrame:
    """(date, alert, is_on): the flags of one-row tables as rows, to be kept in a history by date and alert."""
    rows = [
        df.select(F.col("date"), F.lit(name).alias("alert"), F.col(name).alias("is_on"))
        for df in flags
        for name in df.columns
        if name != "date"
    ]
    found = rows[0]
    for other in rows[1:]:
        found = found.unionByName(other)
    return found


def turned_on(history: DataFrame) -> DataFrame:
    """(date, alert) of the dates on which a flag turns true: it is set, and was not on the date before in the history.

    A flag that stays set alerts once. The first date of a history counts as a turn, and an unknown flag as not set. A
    history has a row per day and alert, so the window over one alert stays small.
    """
    before = F.lag("is_on", 1, False).over(Window.partitionBy("alert").orderBy("date"))
    return (
        history.withColumn("_before", F.coalesce(before, F.lit(False)))
        .filter(F.coalesce("is_on", F.lit(False)) & ~F.col("_before"))
        .select("date", "alert")
    )
