"""The thirteen outlier rules, as a table.

A rule looks at ranked histogram rows: a value `x` (in hundredths) with `n` copies, and the
statistics of its group. It says how many of the copies are inside its bounds;
the others are outliers. Groups too small for a rule keep everything; that is a
matter of the whole group and decided after the sums, see `small`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The two minimum sample sizes.
MIN_NS = (11, 6)

# Multiples of the deviation from the median. The wide ones are 3.5 and
# 2.5 times 1.4826 for a median deviation, or times 1.253314 for a mean deviation.
CUT = 3.5
CUT_LOW = 2.5
NORMAL_CUT = 5.189
NORMAL_CUT_LOW = 3.7
MEAN_CUT = 4.3866
MEAN_CUT_LOW = 3.13

# Multiples of the standard deviation, and percentile groups.
EMPIRICAL = 3
CHEBYSHEV = 4.5
LOG_WIDE = 3
LOG_NARROW = 2
GROUPS = 100

# Bounds give by this much, so that values exactly on a bound are inside whatever
# the last bits of the bound are. Prices differ by a cent at least; the logarithms of
# prices up to 10,000,000,000 that differ by a cent differ by 1e-12 at least.
SLACK = 1e-7
LOG_SLACK = 1e-12

# What the rules test: distance from the median, the price, and its logarithm.
TESTED = {
    "gap": "x / 100D - median",
    "price": "x / 100D",
    "log_price": "ln(x / 100D)",
}


def between(value: str, low: str, high: str, slack: float = SLACK) -> str:
    """SQL text: value within the bounds, with slack."""
    return f"({value} between ({low}) - {slack}D and ({high}) + {slack}D)"


def small(min_n: int) -> str:
    """SQL text: the group has too few rows to trim."""
    if min_n < 2:
        raise ValueError("a rule needs at least two rows to have bounds")
    return f"(n_group < {min_n})"


@dataclass(frozen=True)
class IntervalRule:
    """Keeps tested values between two bounds, all given as SQL text."""

    name: str
    tested: str
    low: str
    high: str

    @property
    def deviations(self) -> bool:
        return self.tested == "gap"

    @property
    def inside(self) -> str:
        slack = LOG_SLACK if self.tested == "log_price" else SLACK
        return f"if({between(self.tested, self.low, self.high, slack)}, n, 0L)"


@dataclass(frozen=True)
class PercentileRule:
    """Drops the first and the last of 100 equal groups, highest price first.

    The first group holds one row more whenever the rows do not divide evenly.
    With fewer than 100 rows the last group is empty, so only the highest price
    goes. Copies of one price are split when a group boundary runs through them.
    """

    name: str
    tested: str = "price"
    deviations: bool = False

    @property
    def inside(self) -> str:
        lowest = f"floor(n_group / {GROUPS}) + 1"
        highest = f"n_group - ceil(n_group / {GROUPS})"
        overlap = f"least(last_rank, {highest}) - greatest(first_rank, {lowest}) + 1"
        return f"greatest({overlap}, 0L)"


Rule = IntervalRule | PercentileRule


def _median_rule(name: str, low: float, high: float) -> IntervalRule:
    """Bounds are multiples of the median absolute deviation."""
    return IntervalRule(name, "gap", f"-{low}D * mad", f"{high}D * mad")


def _fallback_rule(
    name: str, low: float, high: float, mean_low: float, mean_high: float
) -> IntervalRule:
    """The mean deviation takes over where more than half of the values are equal."""
    return IntervalRule(
        name,
        "gap",
        f"if(mad = 0, -{mean_low}D * meanad, -{low}D * mad)",
        f"if(mad = 0, {mean_high}D * meanad, {high}D * mad)",
    )


def _sigma_rule(name: str, k: float, tested: str, suffix: str = "") -> IntervalRule:
    mean, std = f"mean{suffix}", f"std{suffix}"
    return IntervalRule(name, tested, f"{mean} - {k} * {std}", f"{mean} + {k} * {std}")


RULES: dict[str, Rule] = {
    rule.name: rule
    for rule in (
        _median_rule("med", NORMAL_CUT, NORMAL_CUT),
        _median_rule("med_nob", CUT, CUT),
        _median_rule("med_dl", NORMAL_CUT_LOW, NORMAL_CUT),
        _median_rule("med_nob_dl", CUT_LOW, CUT),
        _fallback_rule("med_ibm", NORMAL_CUT, NORMAL_CUT, MEAN_CUT, MEAN_CUT),
        _fallback_rule("med_nob_ibm", CUT, CUT, CUT, CUT),
        _fallback_rule("med_dl_ibm", NORMAL_CUT_LOW, NORMAL_CUT, MEAN_CUT_LOW, MEAN_CUT),
        _fallback_rule("med_nob_dl_ibm", CUT_LOW, CUT, CUT_LOW, CUT),
        PercentileRule("ntiles"),
        _sigma_rule("emp", EMPIRICAL, "price"),
        _sigma_rule("chb", CHEBYSHEV, "price"),
        _sigma_rule("3std_log", LOG_WIDE, "log_price", "_log"),
        _sigma_rule("2std_log", LOG_NARROW, "log_price", "_log"),
    )
}


def with_inside(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add `inside_<rule>`, the copies inside each rule's bounds."""
    tested = {r.tested for r in rules}
    return rows.withColumns(
        {name: F.expr(text) for name, text in TESTED.items() if name in tested}
    ).withColumns({f"inside_{r.name}": F.expr(r.inside) for r in rules})
