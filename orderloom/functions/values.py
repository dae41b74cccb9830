"""Expressions over text cells: missing tokens, type tests, typed casts, dates, money."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Cell texts the CSV reader treats as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Anchored, so that every engine agrees on what counts as a number.
INTEGER = r"^[+-]?[0-9]+$"
DOUBLE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
BOOLEAN = r"^([tT]rue|TRUE|[fF]alse|FALSE)$"
TIMESTAMP = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
             r"([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$")

# Narrowest first: the first type every value fits is the column's type.
TYPE_ORDER = ("bigint", "double", "boolean", "timestamp_ntz")
# A column that has had no value yet; the first file with one decides.
UNKNOWN = "unknown"

# Shapes of a day that is not ISO, and the ISO day or ``d MMM yyyy`` each turns into.
# Month comes before day wherever both orders could be meant.
_MONTH_FIRST = (r"^([0-9]{1,2})[-/.]([0-9]{1,2})[-/.]([0-9]{4})$", "$3-$1-$2")
_DAY_FIRST = (_MONTH_FIRST[0], "$3-$2-$1")
_YEAR_FIRST = (r"^([0-9]{4})[/.]?([0-9]{1,2})[/.]?([0-9]{2}|[0-9])$", "$1-$2-$3")
_NAMED_AFTER = (r"^([0-9]{1,2})[ -]([A-Za-z]{3})[a-z]*[ ,-]+([0-9]{4})$", "$1 $2 $3")
_NAMED_BEFORE = (r"^([A-Za-z]{3})[a-z]*[ -]([0-9]{1,2})[ ,-]+([0-9]{4})$", "$2 $1 $3")
# A day, then maybe a clock time, then maybe am or pm.
_DAY_AND_CLOCK = (r"^(.+?)(?:[ T]+([0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,9})?)?)"
                  r"(?: ?([AaPp])[Mm])?)?$")

# An amount is the number that its shortest decimal says. It is summed exactly with two decimals
# below 2^53 cents, and with nine below the limit: doubles tell all such numbers apart.
CENTS = 1e2
PARTS, PARTS_LIMIT = 1e9, 2.0 ** 22
_PARTS_A_CENT = PARTS / CENTS
# Whole numbers below this are exact doubles.
_EXACT = 2.0 ** 53


def naive_utc(ts: datetime) -> datetime:
    """A point in time as UTC wall-clock, which the lineage columns hold."""
    return ts.astimezone(timezone.utc).replace(tzinfo=None) if ts.tzinfo else ts


def null_if_token(value: Column) -> Column:
    """NULL where the text is one of the missing-value tokens."""
    return F.when(~value.isin(*NULL_TOKENS), value)


def type_class(value: Column) -> Column:
    """Position in `TYPE_ORDER` of the narrowest type a text fits; one more for plain text.

    Whole numbers beyond 64 bits stay text: as doubles, different ids would read alike.
    """
    integer = value.rlike(INTEGER)
    timestamp = value.rlike(TIMESTAMP) & value.try_cast("timestamp_ntz").isNotNull()
    return (F.when(value.isNull(), F.lit(None).cast("int"))
            .when(integer, F.when(value.try_cast("bigint").isNotNull(), 0)
                  .otherwise(len(TYPE_ORDER)))
            .when(value.rlike(DOUBLE), 1).when(value.rlike(BOOLEAN), 2)
            .when(timestamp, 3).otherwise(len(TYPE_ORDER)))


def _parse_day(day: Column) -> Column:
    """Date from a non-ISO day. Only the form whose shape fits is tried."""
    def iso(shape: tuple[str, str]) -> Column:
        return F.regexp_replace(day, *map(F.lit, shape)).try_cast("date")

    def named(shape: tuple[str, str]) -> Column:
        return F.try_to_date(F.initcap(F.regexp_replace(day, *map(F.lit, shape))), "d MMM yyyy")

    return (F.when(day.rlike(_MONTH_FIRST[0]), F.coalesce(iso(_MONTH_FIRST), iso(_DAY_FIRST)))
            .when(day.rlike(_YEAR_FIRST[0]), iso(_YEAR_FIRST))
            .when(day.rlike(_NAMED_AFTER[0]), named(_NAMED_AFTER))
            .when(day.rlike(_NAMED_BEFORE[0]), named(_NAMED_BEFORE)))


def parse_date(value: Column) -> Column:
    """Timestamp without zone from mixed text forms, NULL where none fits.

    Works on wall-clock text throughout, so the session zone never shifts a value.
    """
    text = F.trim(value)
    clock = F.regexp_extract(text, _DAY_AND_CLOCK, 2)
    half = F.lower(F.regexp_extract(text, _DAY_AND_CLOCK, 3))
    hour = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")
    hour24 = (F.when((half == "") | ~hour.between(1, 12), hour)
              .otherwise(hour % 12 + F.when(half == "p", 12).otherwise(0)))
    time = F.when(clock == "", "00:00:00").otherwise(
        F.concat(hour24.cast("string"), F.regexp_extract(clock, ":.*$", 0)))
    day = _parse_day(F.regexp_extract(text, _DAY_AND_CLOCK, 1))
    other = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" "), time).try_cast("timestamp_ntz")
    return F.when(text.rlike("^[0-9]{4}(-|$)"), text.try_cast("timestamp_ntz")).otherwise(other)


def typed(value: Column, type_name: str) -> Column:
    """Read a text cell as its registered type; unreadable text becomes NULL."""
    if type_name in ("string", UNKNOWN):
        return value
    if type_name == "date_text":
        return parse_date(value)
    return value.try_cast(type_name)


def _fine(value: Column) -> Column:
    return (F.abs(value) < PARTS_LIMIT) & (F.rint(value * PARTS) / PARTS == value)


def is_exact_amount(value: Column) -> Column:
    """Whether a number, or its text, is an amount that is summed exactly; false for no number."""
    value = value.try_cast("double")
    cents = F.rint(value * CENTS)
    return F.coalesce((cents / CENTS == value) & (F.abs(cents) < _EXACT) | _fine(value),
                      F.lit(False))


def amount_parts(value: Column, cents: Column) -> dict[str, Column]:
    """An amount as whole cents and what they lack, in billionths; ``cents`` is `rough_cents`.

    The latter is 0 for an amount in cents and a whole number for any other exact one. Others
    have no cents and are there as they are.
    """
    whole = (cents / CENTS == value) & (F.abs(cents) < _EXACT)
    fine = _fine(value)
    return {"cents": F.when(whole | fine, cents).otherwise(0.0),
            "parts": F.when(whole, 0.0).when(
                fine, F.rint(value * PARTS) - cents * _PARTS_A_CENT).otherwise(value * PARTS)}


def rough_cents(value: Column) -> Column:
    return F.rint(value * CENTS)


def parts_total(cents: Column, parts: Column) -> Column:
    """The amount of sums of cents and parts, rounded once to a double; NULL where there was none.

    Sums of exact amounts are exact in any order of rows, up to 2^53 cents. All others are added
    as doubles: none is left out, what is not a number stays none, and beyond 1e299 they are
    infinite.
    """
    whole = (parts == F.rint(parts)) & (F.abs(parts) < _EXACT) & (F.abs(cents) < _EXACT)
    exact = (cents.cast("decimal(17,0)") * F.lit(Decimal("0.01"))
             + parts.cast("decimal(17,0)") * F.lit(Decimal("0.000000001"))).cast("double")
    return (F.when(parts == 0, cents / CENTS).when(whole, exact)
            .otherwise(cents / CENTS + parts / PARTS))


def money_sum(value: Column) -> Column:
    """Sum of amounts as a double, by `parts_total`."""
    value = value.try_cast("double")
    return parts_total(**{part: F.sum(cell)
                          for part, cell in amount_parts(value, rough_cents(value)).items()})
