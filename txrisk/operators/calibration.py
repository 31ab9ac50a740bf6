"""Percentile thresholds from history, and their version history."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.rules import balance_ratios
from txrisk.schemas import RISK_THRESHOLDS, THRESHOLD_PERCENTILE

# Calibrated value -> column of the calibration input.
METRICS = {
    "p95_amount": "amount",
    "p95_residual_balance_ratio": "residual_balance_ratio",
    "p95_payee_amount_ratio": "payee_amount_ratio",
}
# Most values an exact percentile holds in one task; above it the range is narrowed. Low enough that
# any but a tiny history goes the same way.
EXACT_ROWS = 2_000
# Most sketches that one task merges. Sketches of scan tasks are merged in three levels, which is
# enough for 16 million of them.
_FAN_IN = 256
_LEVELS = 3
# Size of a sketch: a rank error of about 1/10,000 of the rows for thresholds, and one good enough to
# propose the next range for exact ones.
SKETCH_K = 65_535
_PIVOT_K = 16_384
_PIVOT_MARGIN = 0.0015
# Ranks, as shares, that a sketch of what is left of a range is asked for.
_GRID = [i / 256 for i in range(257)]


def calibration_input(bronze: DataFrame, *keep: str) -> DataFrame:
    """The three calibrated measures, after the columns to keep; four Bronze columns are scanned for
    them."""
    return bronze.select(*keep, "amount", *[c.alias(n) for n, c in balance_ratios().items()])


def _merged(rows: DataFrame, summed: dict[str, Column], sketched: dict[str, Column], k: int, by=()) -> DataFrame:
    """Sums and sketches of all rows, or of each value of ``by``, merged in levels.

    A scan task makes one sketch of each column; then each task of a level merges those of at most
    _FAN_IN tasks of the level below. The scan keeps all its tasks, and no task merges more than that
    however long the history is.
    """
    group = F.floor(F.spark_partition_id() / _FAN_IN)
    found = rows.withColumn("_group", group).groupBy(*by, "_group")
    found = found.agg(
        *[column.alias(name) for name, column in summed.items()],
        *[F.kll_sketch_agg_double(column, k).alias(name) for name, column in sketched.items()],
    )
    for level in range(2, _LEVELS + 1):
        last = level == _LEVELS
        found = found.withColumn("_group", F.floor(F.col("_group") / _FAN_IN))
        found = found.groupBy(*by, *([] if last else ["_group"])).agg(
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in summed],
            *[F.kll_merge_agg_double(name).alias(name) for name in sketched],
        )
    return found


def _ranked(column: str) -> Column:
    """The value; a sketch cannot rank NaN, which goes above every number with infinity."""
    return F.when(F.isnan(column), F.lit(float("inf"))).otherwise(F.col(column))


def sketches(measures: DataFrame, k: int = SKETCH_K, by=()) -> DataFrame:
    """For each measure a sketch of its values, how many they are, and how many of them are NaN."""
    summed = {f"{c}_count": F.count(c) for c in METRICS.values()}
    summed |= {f"{c}_nan": F.count_if(F.isnan(c)) for c in METRICS.values()}
    return _merged(measures, summed, {f"{c}_sketch": _ranked(c) for c in METRICS.values()}, k, by)


def merged_sketches(parts: DataFrame) -> DataFrame:
    """One row for any number of stored rows of ``sketches``, merged in levels too."""
    group, found = F.floor(F.spark_partition_id() / _FAN_IN), parts
    for keys in (["_group"], []):
        if keys:
            found = found.withColumn("_group", group)
        found = found.groupBy(*keys).agg(
            *[F.coalesce(F.sum(f"{c}_{n}"), F.lit(0)).alias(f"{c}_{n}") for c in METRICS.values() for n in ("count", "nan")],
            *[F.kll_merge_agg_double(f"{c}_sketch").alias(f"{c}_sketch") for c in METRICS.values()],
        )
    return found


def day_sketches(bronze: DataFrame, day: str) -> DataFrame:
    """``sketches`` of each day's rows. They are as large as a sketch, however many rows a day has."""
    return sketches(calibration_input(bronze, day), by=(day,))


def window(sketched: DataFrame, day: str, days: int) -> DataFrame:
    """The stored sketches of the newest day and the ``days`` - 1 before it. Rows without a date are in
    no window."""
    dated = sketched.withColumn("_date", F.try_to_date(day, "yyyy-MM-dd"))
    newest = dated.agg(F.max("_date")).first()[0]
    return dated.where(F.col("_date") > F.date_sub(F.lit(newest), days)).drop("_date")


def sketched_thresholds(sketch: DataFrame, fraction: str = THRESHOLD_PERCENTILE) -> DataFrame:
    """One row of percentiles from the one row of ``sketches``: the value whose rank reaches the
    fraction. NaN ranks above every number. NULL where there is no value."""
    return sketch.select(*[_at_fraction(c, fraction).alias(name) for name, c in METRICS.items()])


def _at_fraction(column: str, fraction: str) -> Column:
    values, nans = F.col(f"{column}_count"), F.col(f"{column}_nan")
    return (
        F.when(values == 0, F.lit(None).cast("double"))
        .when(F.ceil(values * F.lit(Decimal(fraction))) > values - nans, F.lit(float("nan")))
        .otherwise(F.kll_sketch_get_quantile_double(f"{column}_sketch", F.lit(float(fraction))))
    )


def approximate_thresholds(
    bronze: DataFrame, fraction: str = THRESHOLD_PERCENTILE, k: int = SKETCH_K
) -> DataFrame:
    """One row of approximate percentiles in one pass; rank error about rows / 10,000.

    NULL measures are ignored; the zeros of guarded ratios count. All NULL for no rows.
    """
    return sketched_thresholds(sketches(calibration_input(bronze), k), fraction)


@dataclass
class _Search:
    """Where one percentile still has to be looked for: strictly between two values."""

    column: str
    rows: int  # values left in the range
    rank: int  # 1-based rank of the percentile among them
    low: float | None = None
    high: float | None = None
    found: float | None = None
    pivots: tuple[float, float] | None = None  # two values of the range, proposed to be around the rank

    def values(self) -> Column:
        """The numbers of the column inside the range, NULL outside."""
        value, inside = F.col(self.column), ~F.isnan(self.column)
        if self.low is not None:
            inside = inside & (value > F.lit(self.low))
        if self.high is not None:
            inside = inside & (value < F.lit(self.high))
        return F.when(inside, value)

    def at_rank(self) -> float:
        return (self.rank - 0.5) / self.rows


def _values_at(sketch: str, shares: list[float], rows: Column) -> Column:
    """Values of a sketch at these shares of its rows; NULL for no rows."""
    return F.when(rows > 0, F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, shares))))


def _around(grid: list[float], share: float) -> tuple[float, float]:
    """Values of a grid that lie around a share of the rows, a sketch's error apart."""
    at, last = share * (len(grid) - 1), len(grid) - 1
    return grid[max(floor(at - 0.25), 0)], grid[min(ceil(at + 0.25), last)]


def exact_thresholds(
    bronze: DataFrame, fraction: str = THRESHOLD_PERCENTILE, max_rows: int = EXACT_ROWS
) -> DataFrame:
    """One row of exact discrete percentiles: the smallest value whose rank reaches the fraction.

    ``percentile_disc`` keeps every distinct value in one task. So while a range holds more than
    ``max_rows`` values it is narrowed: a sketch proposes two values around the wanted rank, and
    exact counts below, at and between them say which part holds it. The proposal only decides
    how fast the range shrinks, never the result, and a value repeated often enough to resist that
    is itself proposed and counted out. The first scan counts and proposes; each later one counts and
    proposes for what lies between. A round shrinks the range to less than 1/150.
    """
    measures = calibration_input(bronze)
    searches = _begin(measures, fraction)
    while wide := [s for s in searches.values() if s.found is None and s.rows > max_rows]:
        _narrow(measures, wide)

    left = measures.select(*[s.values().alias(name) for name, s in searches.items()])
    return left.agg(*[_value_at_rank(name, s) for name, s in searches.items()])


def _begin(measures: DataFrame, fraction: str) -> dict[str, _Search]:
    share = float(fraction)
    around = [max(share - _PIVOT_MARGIN, 0.0), min(share + _PIVOT_MARGIN, 1.0)]
    columns = [
        column
        for c in METRICS.values()
        for column in (
            F.col(f"{c}_count"),
            F.col(f"{c}_nan"),
            _values_at(f"{c}_sketch", around, F.col(f"{c}_count")).alias(f"{c}_pivots"),
        )
    ]
    row = sketches(measures, _PIVOT_K).select(*columns).first()
    searches = {}
    for name, c in METRICS.items():
        rows, numbers = row[f"{c}_count"], row[f"{c}_count"] - row[f"{c}_nan"]
        rank = max(int((Decimal(fraction) * rows).to_integral_value(ROUND_CEILING)), 1)
        searches[name] = _Search(c, numbers, rank, pivots=row[f"{c}_pivots"])
        if rows and rank > numbers:
            searches[name].found = float("nan")
    return searches


def _value_at_rank(name: str, search: _Search) -> Column:
    if search.found is not None:
        value = F.max(F.lit(search.found))
    elif search.rows == 0:
        value = F.max(name)
    else:
        # Half a rank below the wanted one, so rounding of the fraction cannot change it.
        value = F.expr(f"percentile_disc({search.at_rank()!r}D) WITHIN GROUP (ORDER BY {name})")
    return value.alias(name)


def _narrow(measures: DataFrame, searches: list[_Search]) -> None:
    """One scan: exact counts around the pivots of each search, and a sketch of what lies between.
    A search without pivots gets a sketch of its range."""
    summed, sketched, grids = {}, {}, []
    for s in searches:
        value, name = s.values(), s.column
        if s.pivots is not None:
            low, high = map(F.lit, s.pivots)
            parts = {
                "below": value < low,
                "at_low": value == low,
                "between": (value > low) & (value < high),
                "at_high": (value == high) & (high > low),
            }
            summed |= {f"{name}_{part}": F.count_if(inside) for part, inside in parts.items()}
            value = F.when(parts["between"], value)
        summed[f"{name}_left"] = F.count(value)
        sketched[f"{name}_sketch"] = value
        grids.append(_values_at(f"{name}_sketch", _GRID, F.col(f"{name}_left")).alias(f"{name}_grid"))
    row = _merged(measures, summed, sketched, _PIVOT_K).select(*map(F.col, summed), *grids).first()
    for s in searches:
        grid = row[f"{s.column}_grid"]
        inside = s.pivots is None or _keep_part_with_rank(
            s, {part: row[f"{s.column}_{part}"] for part in ("below", "at_low", "between", "at_high")}
        )
        # the sketch is of the range that is left only if the rank lies there
        s.pivots = _around(grid, s.at_rank()) if inside and s.found is None else None


def _keep_part_with_rank(s: _Search, share: dict[str, int]) -> bool:
    """Narrow a search by exact counts; says whether what lies between the pivots is left."""
    low, high = s.pivots
    to_low = share["below"] + share["at_low"]
    to_high = to_low + share["between"] + share["at_high"]
    if s.rank <= share["below"]:
        s.high, s.rows = low, share["below"]
    elif s.rank <= to_low:
        s.found = low
    elif s.rank <= to_low + share["between"]:
        s.low, s.high = low, high
        s.rank, s.rows = s.rank - to_low, share["between"]
        return True
    elif s.rank <= to_high:
        s.found = high
    else:
        s.low, s.rank, s.rows = high, s.rank - to_high, s.rows - to_high
    return False


def active_threshold(history: DataFrame) -> DataFrame:
    """The newest open version, at most one row."""
    return history.where(F.col("valid_to").isNull()).orderBy(F.col("valid_from").desc()).limit(1)


def new_version(values: DataFrame, version: str, at: Column) -> DataFrame:
    """A row of calibrated values as an open version starting at ``at``."""
    row = values.select(
        F.lit(version).alias("threshold_version"),
        *METRICS,
        at.alias("valid_from"),
        F.lit(None).alias("valid_to"),
    )
    return row.select(*[F.col(f.name).cast(f.dataType) for f in RISK_THRESHOLDS])


def close_versions(history: DataFrame, at: Column) -> DataFrame:
    """History with every open version closed at ``at``."""
    closed = history.withColumn("valid_to", F.coalesce("valid_to", at))
    return closed.select(*RISK_THRESHOLDS.names)
