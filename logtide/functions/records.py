"""Column expressions over one log record."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..schema import LOG_FIELDS
from ..settings import BATCH_THRESHOLDS, Thresholds

# Characters Python's ``str.strip`` removes; ``trim`` alone removes spaces only.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
    + "".join(map(chr, range(0x2000, 0x200B)))
)
# Numbers the cast accepts beyond the decimal notation: type suffixes and hexadecimal.
FOREIGN_NUMBER = r"(?i)[0-9.][df]\s*$|x"


def event_time(text: Column) -> Column:
    """Timestamp of ISO-8601 text; null when it does not parse."""
    return F.try_to_timestamp(text)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def parse_double(text: Column) -> Column:
    """Number in ``text``, 0.0 when absent or malformed."""
    return F.coalesce(F.when(~text.rlike(FOREIGN_NUMBER), text.try_cast("double")), F.lit(0.0))


def parse_integer(text: Column) -> Column:
    """Whole number in ``text``, 0 when absent or malformed (``12.7`` is malformed)."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def not_negative(number: Column) -> Column:
    """Negative becomes zero, null stays null."""
    return F.when(number.isNotNull(), F.greatest(number, F.lit(0)))


def half_even(number: Column) -> Column:
    """Nearest integer, ties to even; null when it does not fit."""
    return F.rint(number).try_cast("bigint")


def mentions(message: Column, keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> Column:
    """``message`` contains a keyword: literal, case-insensitive substring.

    One pattern, so the message is read once. A chain of ``contains`` would repeat the
    message expression per keyword when the filter is pushed below a projection.
    """
    words = [re.escape(word) for word in keywords]
    if not words:
        return F.lit(False)
    fold = "(?i)" if all(map(str.isascii, words)) else "(?iu)"
    return message.rlike(fold + "|".join(words))


def error_filter(keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> Column:
    """Three-valued error test used as a row filter; level is matched as written."""
    return (
        (F.col("status_code") >= 400)
        | F.col("log_level").isin(*fv.ERROR_LEVELS)
        | mentions(F.col("message"), keywords)
    )


def error_event(keywords: Iterable[str] = fv.ERROR_KEYWORDS) -> Column:
    """Two-valued error test of a record: level in any case, missing status counts as 200."""
    return (
        (F.coalesce(F.col("status_code"), F.lit(200)) >= 400)
        | F.upper(F.coalesce(F.col("log_level"), F.lit(""))).isin(*fv.ERROR_LEVELS)
        | mentions(F.coalesce(F.col("message"), F.lit("")), keywords)
    )


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def feature_columns(latency_ms: float = fv.HIGH_LATENCY_MS) -> dict[str, Column]:
    """The four 0/1 feature flags; ``is_error`` looks at level and status, not at the message."""
    status = F.col("status_code")
    return {
        "is_error": flag(F.coalesce(F.col("log_level").isin(*fv.ERROR_LEVELS), F.lit(False)) | (status >= 400)),
        "is_high_latency": flag(F.col("response_time_ms") > latency_ms),
        "is_server_error": flag(status >= 500),
        "is_client_error": flag(status.between(400, 499)),
    }


def record_tests(
    thresholds: Thresholds = BATCH_THRESHOLDS, keywords: Iterable[str] = fv.ERROR_KEYWORDS
) -> dict[str, Column]:
    """The tests that make a record anomalous, by reason, in the order the reasons are listed."""
    return {
        "HIGH_RESPONSE_TIME": F.coalesce(F.col("response_time_ms"), F.lit(0.0)) > thresholds.latency_ms,
        "ERROR_EVENT": error_event(keywords),
        "SERVER_ERROR": F.coalesce(F.col("status_code"), F.lit(200)) >= 500,
    }


def missing_fields(raw: Column) -> Column:
    """Required fields absent from a JSON text; all of them when it is not a JSON object.

    A key with a null value counts as present.
    """
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.array_except(F.array(*(F.lit(name) for name in LOG_FIELDS)), keys)
