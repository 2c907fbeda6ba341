"""Scalar expressions. All are built-in Column expressions and stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Markers meaning "no height", month abbreviations standing for feet (a
# spreadsheet turned 6-0 into Jun-00), and class years in order.
INVALID_HEIGHTS = ["-", "None", "0", "Jr", "So", "Fr"]
MONTH_FEET = {"Apr": 4, "May": 5, "Jun": 6, "Jul": 7}
CLASS_YEARS = {"Fr": 1, "So": 2, "Jr": 3, "Sr": 4}
FLOAT_EPS = 2.220446049250313e-16

# Fixed value: what counts as a number. The same pattern is used in the SQL checks.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Constants of the key hash: a linear congruential step, its halves swapped, and a second step.
# The salt changes the multiplier, so hashes under different salts are unrelated.
HASH_MOD = 2147483648
HASH_MUL = 1103515245
HASH_ADD = 12345
HASH_SALT_STEP = 362436


def _months() -> str:
    return "|".join(MONTH_FEET)


def _feet_of(month: Column) -> Column:
    out = F.lit(None).cast("int")
    for name, feet in MONTH_FEET.items():
        out = F.when(month == name, F.lit(feet)).otherwise(out)
    return out


def height_inches(ht: Column) -> Column:
    """Height text to inches: 6'4 -> 76, Jun-00 -> 72, 11-May -> 71; anything else null."""
    feet_inches = r"^([0-9]{1,6})'([0-9]{1,6})$"
    month_first = rf"^({_months()})-([0-9]{{1,6}})$"
    month_last = rf"^([0-9]{{1,6}})-({_months()})$"

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(ht, pattern, group)

    def number(pattern: str, group: int) -> Column:
        return part(pattern, group).try_cast("int")

    inches = (
        F.when(ht.isin(INVALID_HEIGHTS), F.lit(None).cast("int"))
        .when(ht.rlike(feet_inches), number(feet_inches, 1) * 12 + number(feet_inches, 2))
        .when(ht.rlike(month_first), _feet_of(part(month_first, 1)) * 12 + number(month_first, 2))
        .when(ht.rlike(month_last), _feet_of(part(month_last, 2)) * 12 + number(month_last, 1))
    )
    return inches.cast("double")


def class_year(yr: Column) -> Column:
    """Fr/So/Jr/Sr to 1..4, anything else null."""
    out = F.lit(None).cast("double")
    for name, value in CLASS_YEARS.items():
        out = F.when(yr == name, F.lit(float(value))).otherwise(out)
    return out


def safe_number(text: Column) -> Column:
    """Text to double; text that is no plain number gives null."""
    return F.when(text.rlike(NUMBER_PATTERN), F.trim(text).try_cast("double"))


def presence(c: Column) -> Column:
    return c.isNotNull().cast("int")


def ratio(a: Column, b: Column) -> Column:
    """a/b as double, null when b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def finite(c: Column) -> Column:
    """NaN and infinities become null."""
    inf = float("inf")
    return F.when(F.isnan(c) | (F.abs(c) == inf), F.lit(None).cast("double")).otherwise(c)


def key_hash(key: Column, salt: int = 0) -> Column:
    """A deterministic value in [0, 2**31) from an integer key, in plain arithmetic so that
    any SQL engine can repeat it."""
    step = lambda k, mul: F.pmod(k * F.lit(mul) + F.lit(HASH_ADD), F.lit(HASH_MOD))
    first = step(F.pmod(key.cast("bigint"), F.lit(HASH_MOD)), (HASH_MUL + salt * HASH_SALT_STEP) % HASH_MOD)
    swapped = F.pmod(first, F.lit(65536)) * F.lit(32768) + F.floor(first / F.lit(65536))
    return step(swapped, HASH_MUL)


def hash_bucket(key: Column, buckets: int, salt: int = 0) -> Column:
    """Bucket 0..buckets-1 by range of the key hash, so bucket order is hash order."""
    return F.floor(key_hash(key, salt) * F.lit(buckets) / F.lit(HASH_MOD)).cast("int")
