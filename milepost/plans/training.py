"""Phase durations, outlier trimming and delay regressions per segment.

A segment is (generation type, phase, market level). Segments are few, so their tables
are joined back through ``SmallTable``; only plant-sized data is ever shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.dates import add_days, day, days_between
from milepost.functions.rules import any_of, holds
from milepost.functions.stats import jarque_bera, order_scores, outside, pearson, w_parts, w_test
from milepost.operators.pick import pick_row, split_duplicate_ids
from milepost.operators.ranks import numbered
from milepost.plans.model import ALL_MARKETS, LEVELS, PHASES, SEGMENT, SPLIT_TYPE, TRIM_Z
from milepost.session import SmallTable

CUT_OFF = dt.date(2022, 10, 1)


# --- cleaning -----------------------------------------------------------------


def phase_durations(units: DataFrame) -> DataFrame:
    """Days from each milestone, and from the obligation, to commercial operation."""
    end = F.col("commercial_date")
    spans = {f"days_{p}": days_between(end, F.col(m)) for p, m in PHASES.items()}
    spans["delay"] = days_between(end, F.col("obligation_date"))
    return units.withColumns(spans)


def _disorder() -> dict[str, Column]:
    """For every pair of phases, whether the later one began before the earlier one.

    Comparing the dates is the same as comparing their spans to operation, and stays a
    plain predicate on two columns.
    """
    return {
        f"{late}>{early}": holds(F.col(PHASES[early]) > F.col(PHASES[late]))
        for early, late in combinations(PHASES, 2)
    }


def check_order(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose milestones are in order, and the rejected ones with the reasons."""
    wrong = _disorder()
    parts = [F.when(cond, F.lit(f"{label},")).otherwise("") for label, cond in wrong.items()]
    rejected = any_of(*wrong.values())
    return (
        units.filter(~rejected),
        units.filter(rejected).withColumn("reject_reason", F.concat(*parts)),
    )


def finished(units: DataFrame) -> DataFrame:
    return units.dropna(subset=["obligation_date", "commercial_date"])


def clean_history(
    units: DataFrame, order: list[str] = ("unit_no",), extra: list[str] = (), written: bool = False
) -> DataFrame:
    """First unit in operation of every plant with milestones in order.

    Hydro plants listed on several rows count as one plant per row. ``order`` names the
    columns that, after the date, decide between equal rows. Units that are a table already
    (``written``) are not written again.
    """
    keep = ["plant_id", "gen_type", "market", "obligation_date", "commercial_date"]
    cols = list(dict.fromkeys([*keep, *PHASES.values(), *order, *extra]))
    rows = finished(units).filter(F.col("plant_id").isNotNull()).select(*cols)
    keyed = split_duplicate_ids(
        rows, "plant_id", ["commercial_date", *order], F.col("gen_type") == SPLIT_TYPE, written=written
    )
    ordered, _ = check_order(keyed)
    first = pick_row(ordered, ["unit_key"], "commercial_date", list(order), largest=False)
    return phase_durations(first)


def split_by_date(df: DataFrame, cut_off: dt.date = CUT_OFF) -> tuple[DataFrame, DataFrame]:
    """Rows before the cut-off train the model, the others test it."""
    train = F.col("commercial_date") < day(cut_off)
    return df.filter(train), df.filter(~train)


# --- observations -------------------------------------------------------------


def _own_level() -> Column:
    """The market level of a row besides that of all markets; only the two named ones have one."""
    return F.when(F.col("market").isin(LEVELS[1:]), F.col("market"))


def _exploded(history: DataFrame, more: dict[tuple[str, str], dict[str, Column]]) -> DataFrame:
    """One row per plant, phase and market level it counts for.

    ``more`` has further columns by phase and level, ``own`` standing for the row's own level.
    """
    both = {"all": F.lit(ALL_MARKETS), "own": _own_level()}
    entries = [
        F.struct(
            F.lit(p).alias("phase"),
            F.col(m).alias("milestone_date"),
            F.col(f"days_{p}").alias("days"),
            level.alias("level"),
            *[c.alias(name) for name, c in more.get((p, kind), {}).items()],
        )
        for kind, level in both.items()
        for p, m in PHASES.items()
    ]
    taken = [*PHASES.values(), *[f"days_{p}" for p in PHASES]]
    kept = [c for c in history.columns if c not in taken]
    return history.select(*kept, F.inline(F.array(*entries))).filter(F.col("level").isNotNull())


def observations(history: DataFrame, cut_off: dt.date = CUT_OFF) -> DataFrame:
    """One row per plant, phase and market level it counts for.

    Every row counts for the level of all markets; only the two named markets have a
    level of their own.
    """
    return _exploded(history.withColumn("is_train", F.col("commercial_date") < day(cut_off)), {})


def _spread(obs: DataFrame) -> DataFrame:
    return obs.groupBy(*SEGMENT).agg(
        F.count("days").alias("n"),
        F.avg("days").alias("mean_days"),
        F.stddev_samp("days").alias("std_days"),
    )


def flag_outliers(history: DataFrame, cut_off: dt.date = CUT_OFF, z: float = TRIM_Z) -> DataFrame:
    """Observations marked outside the training spread of their segment, test rows included.

    The bounds of all phases lie in one row per type and level, so each plant is judged while it
    is one row: ``any_outlier`` tells whether it has an outlier in any phase at any level.
    """
    first = _spread(observations(history, cut_off).filter("is_train"))
    wide = [
        F.max(F.when(F.col("phase") == p, F.col(c))).alias(f"{c}_{p}")
        for p in PHASES
        for c in ("mean_days", "std_days")
    ]
    bounds = SmallTable(first.groupBy("gen_type", "level").agg(*wide))
    rows = history.withColumns({"is_train": F.col("commercial_date") < day(cut_off), "_own": _own_level()})
    every = bounds.df.filter(F.col("level") == ALL_MARKETS).drop("level")
    own = bounds.df.withColumnsRenamed({f"{c}_{p}": f"own_{c}_{p}" for p in PHASES for c in ("mean_days", "std_days")})
    rows = rows.join(every, "gen_type", "left")
    rows = rows.join(own.withColumnRenamed("level", "_own"), ["gen_type", "_own"], "left")
    flags = {
        (p, kind): outside(F.col(f"days_{p}"), F.col(f"{side}mean_days_{p}"), F.col(f"{side}std_days_{p}"), z)
        for p in PHASES
        for kind, side in (("all", ""), ("own", "own_"))
    }
    names = {key: f"_out_{key[1]}_{key[0]}" for key in flags}
    rows = rows.select(*history.columns, "is_train", *[c.alias(names[key]) for key, c in flags.items()])
    rows = rows.withColumn("any_outlier", any_of(*[F.col(n) for n in names.values()]))
    marked = _exploded(rows, {key: {"outlier": F.col(n)} for key, n in names.items()})
    return marked.drop(*names.values())


def trimmed_stats(flagged: DataFrame) -> DataFrame:
    """Count, mean and sample deviation of the training durations that are not outliers."""
    return _spread(flagged.filter("is_train AND NOT outlier"))


def milestone_delay(obs: DataFrame, stats: SmallTable) -> DataFrame:
    """Expected milestone date (obligation less the mean phase) and days behind it."""
    joined = stats.join(obs, SEGMENT)
    return joined.withColumns(
        {
            "expected_date": add_days(F.col("obligation_date"), -F.col("mean_days")),
            "milestone_delay": days_between(F.col("milestone_date"), F.col("obligation_date"))
            + F.col("mean_days"),
        }
    )


def delay_means(delays: DataFrame) -> DataFrame:
    """Mean milestone delay against the own-market expectation, per market and per type."""
    kept = delays.filter((F.col("level") != ALL_MARKETS) & ~F.col("any_outlier"))
    sets = kept.groupingSets(
        [("gen_type", "phase", "level"), ("gen_type", "phase")], "gen_type", "phase", "level"
    )
    return sets.agg(F.avg("milestone_delay").alias("mean_delay")).fillna(ALL_MARKETS, ["level"])


# --- regression ---------------------------------------------------------------


def fit_rows(delays: DataFrame, z: float = TRIM_Z) -> DataFrame:
    """Training pairs of the regression, trimmed again by the already trimmed spread."""
    inside = ~outside(F.col("days"), F.col("mean_days"), F.col("std_days"), z)
    pair = F.col("milestone_delay").isNotNull() & F.col("delay").isNotNull()
    return delays.filter(F.col("is_train") & inside & pair)


def fit_delay(delays: DataFrame, z: float = TRIM_Z) -> DataFrame:
    """Line of operation delay on milestone delay per segment, with correlation and spread."""
    x, y = F.col("milestone_delay"), F.col("delay")
    return fit_rows(delays, z).groupBy(*SEGMENT).agg(
        F.regr_slope(y, x).alias("a"),
        F.regr_intercept(y, x).alias("b"),
        pearson(x, y).alias("r"),
        F.avg(x).alias("mean_delay"),
        F.stddev_pop(x).alias("std_delay"),
    )


class Training:
    """All tables of one training run over ``history`` (see ``clean_history``).

    Each is computed when it is first asked for, the history too if a function of it is given.
    """

    def __init__(
        self, history: DataFrame | Callable[[], DataFrame], cut_off: dt.date = CUT_OFF, z: float = TRIM_Z
    ):
        self._given = history
        self.cut_off, self.z = cut_off, z

    @cached_property
    def history(self) -> DataFrame:
        return self._given() if callable(self._given) else self._given

    @cached_property
    def flagged(self) -> DataFrame:
        return flag_outliers(self.history, self.cut_off, self.z)

    @cached_property
    def stats(self) -> SmallTable:
        return SmallTable(trimmed_stats(self.flagged))

    @cached_property
    def delays(self) -> DataFrame:
        return milestone_delay(self.flagged, self.stats)

    def fit(self) -> DataFrame:
        return fit_delay(self.delays, self.z)

    def coefficient_table(self) -> DataFrame:
        """One row per generation type, phase and level, segments without data included."""
        grid = (
            self.history.select("gen_type")
            .distinct()
            .filter("gen_type IS NOT NULL")
            .withColumn("phase", F.explode(F.array(*map(F.lit, PHASES))))
            .withColumn("level", F.explode(F.array(*map(F.lit, LEVELS))))
        )
        return (
            grid.join(self.stats.df, SEGMENT, "left")
            .join(self.fit(), SEGMENT, "left")
            .fillna(0, ["n"])
        )


# --- evaluation ---------------------------------------------------------------


def backcast(delays: DataFrame, coefficients: SmallTable) -> DataFrame:
    """Forecast every finished plant with its segment's line and compare with the fact."""
    table = coefficients.derive(coefficients.df.select(*SEGMENT, "a", "b"))
    joined = table.join(delays, SEGMENT)
    shift = F.col("milestone_delay") * F.col("a") + F.col("b")
    return joined.withColumns(
        {
            "forecast": add_days(F.col("obligation_date"), shift),
            # Rounded below the millisecond: float noise must not cross a whole day.
            "forecast_error": F.round(F.col("delay") - shift, 8),
        }
    )


def rmse(cast: DataFrame, train: bool = True) -> DataFrame:
    """Root mean squared error in whole days per type, phase and kind of level.

    Training errors leave out plants with any outlier; test errors use every plant.
    """
    rows = cast.filter(F.col("is_train") == F.lit(train))
    if train:
        rows = rows.filter(~F.col("any_outlier"))
    kind = F.when(F.col("level") == ALL_MARKETS, "all").otherwise("own")
    error = F.sqrt(F.avg(F.pow(F.floor("forecast_error").cast("double"), F.lit(2))))
    return (
        rows.groupBy("gen_type", "phase", kind.alias("kind"))
        .agg(F.bround(error, 1).alias("rmse"), F.count("forecast_error").alias("n"))
        .filter("rmse IS NOT NULL")
    )


def choose_level(errors: DataFrame, policy: str = "all") -> DataFrame:
    """Market level to forecast with: always all markets, or the kind with less error."""
    if policy == "all":
        return errors.select("gen_type", "phase").distinct().withColumn("kind", F.lit("all"))
    # An equal error keeps the own market, which is listed first.
    rank = F.struct("rmse", F.when(F.col("kind") == "own", 0).otherwise(1))
    return errors.groupBy("gen_type", "phase").agg(F.min_by("kind", rank).alias("kind"))


def residuals(delays: DataFrame, coefficients: SmallTable, z: float = TRIM_Z) -> DataFrame:
    """Distance of every training pair from its line."""
    table = coefficients.derive(coefficients.df.select(*SEGMENT, "a", "b"))
    line = F.col("milestone_delay") * F.col("a") + F.col("b")
    return table.join(fit_rows(delays, z), SEGMENT).withColumn("residual", F.col("delay") - line)


def mean_residuals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*SEGMENT).agg(F.avg("residual").alias("mean_residual"))


def histogram(rows: DataFrame, keys: list[str], col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between the extremes of each group; the last bin is closed."""
    limits = SmallTable(
        rows.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    )
    share = F.try_divide(F.col(col) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    # A constant group is drawn one unit wide around its value, which is then bin bins/2.
    # Rounded first: float noise must not move a value to the next bin.
    slot = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor(F.round(share * bins, 9)), F.lit(bins - 1)))
    place = F.coalesce(slot, F.lit(bins // 2)).cast("int")
    return (
        limits.join(rows.filter(F.col(col).isNotNull()), keys)
        .groupBy(*keys, place.alias("bin"))
        .agg(F.count("*").alias("n"))
    )


def normality(rows: DataFrame, keys: list[str], col: str) -> DataFrame:
    """Jarque-Bera test per group: statistic and the chance of a larger one, from moments alone."""
    stats = rows.groupBy(*keys).agg(
        F.count(col).alias("n"), jarque_bera(F.col(col)).alias("jb")
    )
    return stats.withColumn("p_value", F.exp(-F.col("jb") / 2))


def normality_by_order(rows: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Shapiro-Wilk test per group for each column: rows, W and the chance of a smaller W.

    Rows are ranked by partition offsets, and with its rank a row adds its part to mergeable
    sums, so no group is sorted or gathered in one task. Unknown values are left out; a group
    of less than three known values, or of equal ones, has neither W nor a chance.
    """
    tested = []
    for col in cols:
        known = rows.select(*keys, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
        ranked = numbered(known, keys, ["_x"], "_place", "_size")
        ranked = order_scores(ranked, "_place", "_size", "_score")
        sums = w_parts(*[F.col(c) for c in ("_x", "_place", "_size", "_score")])
        parts = ranked.groupBy(*keys).agg(*[c.alias(name) for name, c in sums.items()])
        tested.append(w_test(parts, keys).withColumn("variable", F.lit(col)))
    return reduce(lambda a, b: a.unionByName(b), tested)


def correlations(fit: DataFrame, level: str = ALL_MARKETS) -> DataFrame:
    """Correlation in percent, generation types by phases."""
    return (
        fit.filter(F.col("level") == level)
        .withColumn("percent", F.bround(F.col("r") * 100, 1))
        .groupBy("gen_type")
        .pivot("phase", list(PHASES))
        .agg(F.first("percent"))
    )
