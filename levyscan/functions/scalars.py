"""Column-level helpers. All run inside the JVM and are safe under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from levyscan.constants import (
    CODE_REMAP,
    DATE_FORMATS,
    FALSE_MARKS,
    GSTIN_PATTERN,
    STATE_NAMES,
    TRUE_MARKS,
)


HASH_BITS = 60  # of `hash_number`


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def gstin_is_valid(gstin: Column) -> Column:
    return gstin.rlike(GSTIN_PATTERN)


def state_code(gstin: Column) -> Column:
    return F.substring(gstin, 1, 2)


def state_name(code: Column) -> Column:
    """Name of a two-digit state code; null for an unknown code."""
    entries = ", ".join(f"'{key}', '{name}'" for key, name in STATE_NAMES.items())
    return F.expr(f"map({entries})")[code]


def differs_ignoring_case(left: Column, right: Column) -> Column:
    return F.lower(left) != F.lower(right)


def parse_date(text: Column) -> Column:
    """Text with slashes as day first, other text as ISO; null when it does not parse.

    The shape decides the format, so that no row pays for a failed parse of the other one.
    """
    slashed, dashed = DATE_FORMATS
    return F.when(F.contains(text, F.lit("/")), F.try_to_date(text, slashed)).otherwise(
        F.try_to_date(text, dashed)
    )


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def as_of_date(as_of: str | None) -> Column:
    """A fixed reporting date, or today when none is given."""
    return F.to_date(F.lit(as_of)) if as_of else F.current_date()


def whole_number(value: Column) -> Column:
    """Text such as '1.0' to int: through double, null when not a number."""
    return value.try_cast("double").try_cast("int")


def round_half_up(value: Column, places: int = 2) -> Column:
    """Rounds once, by the decimal digits that the double prints as, halves away from zero."""
    return F.round(value.cast("double"), places)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator/denominator where the denominator is positive, else 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def exact_sum(value: Column, scale: int = 6) -> Column:
    """Order-independent sum of doubles: a retried task cannot change the last digits."""
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double")


def exact_avg(value: Column, scale: int = 12) -> Column:
    return F.try_divide(exact_sum(value, scale), F.count(value))


def band(value: Column, cuts: list[tuple[float, str]], fallback: str) -> Column:
    """Label of the first cut that the value reaches (cuts run from high to low)."""
    ladder = F.when(value >= cuts[0][0], cuts[0][1])
    for lower, label in cuts[1:]:
        ladder = ladder.when(value >= lower, label)
    return ladder.otherwise(fallback)


def band_below(value: Column, cuts: list[tuple[float, str]], fallback: str) -> Column:
    """Label of the first cut that lies above the value (cuts run from low to high)."""
    ladder = F.when(value < cuts[0][0], cuts[0][1])
    for upper, label in cuts[1:]:
        ladder = ladder.when(value < upper, label)
    return ladder.otherwise(fallback)


def mark_to_flag(mark: Column) -> Column:
    """Tick and yes/no marks to 1/0; anything else counts as 0."""
    return (
        F.when(mark.isin(*TRUE_MARKS), F.lit(1))
        .when(mark.isin(*FALSE_MARKS), F.lit(0))
        .otherwise(F.lit(0))
    )


def remap_code(code: Column, mapping: dict[str, str] = CODE_REMAP) -> Column:
    out = code
    for old, new in mapping.items():
        out = F.when(code == old, F.lit(new)).otherwise(out)
    return out


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """prefix + zero-padded number. A number wider than the pad is kept whole, not cut."""
    digits = number.cast("bigint").cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def hash_fraction(salt: str, *keys: Column) -> Column:
    """Repeatable uniform value in [0, 1) from a key; each use takes its own salt."""
    return hash_number(salt, *keys) / F.lit(float(1 << HASH_BITS))


def hash_number(salt: str, *keys: Column) -> Column:
    """Repeatable integer in [0, 2^60) from a key."""
    text = F.concat_ws("|", F.lit(salt), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def plain_number_text(value: Column) -> Column:
    """Double to text without an exponent (0.0005, not 5.0E-4)."""
    text = value.cast("string")
    plain = F.regexp_replace(value.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(text.contains("E"), F.coalesce(plain, text)).otherwise(text)
