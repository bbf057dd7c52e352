"""Business rules as column expressions. Everything stays JVM-side; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk tiers with their lower probability bound, and the action per tier.
TIER_BOUNDS = (("High", 0.70), ("Medium", 0.40))
TIER_ORDER = ("High", "Medium", "Low")
TIER_ACTIONS = {"High": "Reassign Driver", "Medium": "Send Reminder", "Low": "Proceed"}

# Driver tiers by completion rate (percent) and by performance score.
COMPLETION_TIERS = (("Elite", 90.0), ("Reliable", 75.0), ("Developing", 60.0))
SCORE_TIERS = (("Elite", 0.8), ("Reliable", 0.6), ("Developing", 0.4))
LOWEST_DRIVER_TIER = "At Risk"

# Weights of rating, acceptance and punctuality in the driver score.
SCORE_WEIGHTS = {"rating": 0.4, "acceptance": 0.3, "punctuality": 0.3}

# Rides-per-driver bounds of the allocation states.
ALLOCATION_BOUNDS = (("High Demand", 1.15), ("Peak Lean", 1.08), ("Balanced", 0.95))
LOWEST_ALLOCATION = "Low Demand"

# Surge bounds shared by the alert and the surge reports.
SURGE_HIGH = 1.8
SURGE_MODERATE = 1.4

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
VEHICLE_TYPES = ("Cab", "Auto", "Bike")

_WHITESPACE = " \t\n\r\x0b\x0c"


def flag(condition: Column) -> Column:
    """0/1 flag in which an unknown comparison counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def round_stable(value: Column, digits: int) -> Column:
    """Round half up with a small nudge, so sums added in another order round alike.

    NaN, infinities and numbers so large that they have no such digits stay as they are.
    """
    number, scale = value.cast("double"), float(10 ** digits)
    scaled = number * scale
    has_digits = F.abs(scaled) < F.lit(2.0 ** 53)  # false for infinities and, as NaN is the largest value, for NaN
    return F.when(has_digits, F.floor(scaled + 0.5 + 1e-6) / F.lit(scale)).otherwise(number)


def steady(value: Column) -> Column:
    """An average as it is compared with a bound: summation order must not decide an exact tie."""
    return round_stable(value, 6)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null on a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return safe_ratio(part.cast("double") * 100.0, whole)


def clip_low(value: Column, low: Column) -> Column:
    """Lower bound that keeps nulls; `greatest` alone would skip them."""
    return F.when(value.isNotNull(), F.greatest(value, low))


def clip(value: Column, low: Column, high: Column) -> Column:
    """Two-sided bound that keeps nulls in the value and in either bound."""
    known = value.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(known, F.least(F.greatest(value, low), high))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_WHITESPACE))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters ('no-show' -> 'No-Show').

    `initcap` only treats blanks as word ends, so the text is cut where a letter follows a non-letter.
    """
    words = F.split(F.lower(strip(text)), r"(?<=\P{L})(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1_000_000_000))),
        "",
    )


def _by_interval(value: Column, edges: Sequence[float], results: Sequence[int | str]) -> Column:
    steps = None
    for low, high, result in zip(edges, edges[1:], results):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        steps = F.when(inside, F.lit(result)) if steps is None else steps.when(inside, F.lit(result))
    return steps


def bin_code(value: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed interval (edges[i], edges[i+1]]; null outside all of them."""
    return _by_interval(value, edges, range(len(edges) - 1))


def bin_label(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """As `bin_code`, with a name per interval."""
    return _by_interval(value, edges, labels)


def mapped(value: Column, mapping: Mapping[str, int | str]) -> Column:
    """Dictionary lookup; a value outside the dictionary becomes null."""
    steps = None
    for key, code in mapping.items():
        steps = F.when(value == key, F.lit(code)) if steps is None else steps.when(value == key, F.lit(code))
    return steps


def first_reached(value: Column, bounds: Sequence[tuple[str, float]], otherwise: str) -> Column:
    """Name of the first bound (listed high to low) that the value reaches."""
    steps = None
    for name, low in bounds:
        steps = F.when(value >= low, name) if steps is None else steps.when(value >= low, name)
    return steps.otherwise(otherwise)


def risk_tier(probability: Column) -> Column:
    return first_reached(probability, TIER_BOUNDS, "Low")


def recommended_action(tier: Column) -> Column:
    return mapped(tier, TIER_ACTIONS)


def tier_rank(tier: Column) -> Column:
    """Sort key High, Medium, Low."""
    return F.array_position(F.array(*[F.lit(t) for t in TIER_ORDER]), tier)


def driver_score(rating: Column, acceptance: Column, delay: Column, rating_scale: float = 1.0) -> Column:
    """Weighted driver score. With `rating_scale` 1 the rating keeps its 0..5 range; pass 5 for a 0..1 score."""
    raw = (
        rating / F.lit(rating_scale) * SCORE_WEIGHTS["rating"]
        + acceptance * SCORE_WEIGHTS["acceptance"]
        + (F.lit(1.0) - delay) * SCORE_WEIGHTS["punctuality"]
    )
    return round_stable(raw, 3)


def completion_tier(rate_pct: Column) -> Column:
    return first_reached(rate_pct, COMPLETION_TIERS, LOWEST_DRIVER_TIER)


def score_tier(score: Column) -> Column:
    return first_reached(score, SCORE_TIERS, LOWEST_DRIVER_TIER)


def weekday_name(when: Column) -> Column:
    return F.get(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(when))


def hour_label(hour: Column) -> Column:
    """'07:00' for hour 7."""
    return F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00"))


def half_past_hour_before(hour: Column) -> Column:
    """'06:30' for hour 7; hour 0 stays in the same day ('00:30')."""
    return F.concat(F.lpad(F.greatest(hour - 1, F.lit(0)).cast("string"), 2, "0"), F.lit(":30"))


def peak_flag(hour: Column) -> Column:
    return flag(hour.between(7, 10) | hour.between(17, 21))
