"""Row-level column expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe import constants as C

_TIE_WIDTH = 1e-13


Stamp = datetime | str | Column | None


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def stable_round(value: Column | str, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which partial sums were merged.

    A sum of doubles differs in its last bits between runs on a cluster. Values that lie below a tie by no more than that
    noise, 1e-13 of themselves, count as the tie, so the final digit is reproducible; all others are rounded once, as they are.
    """
    number = as_column(value)
    return F.round(number + number * F.lit(_TIE_WIDTH), digits)


def parse_date(value: Column | str) -> Column:
    """ISO text to DATE, NULL when it is not a date."""
    return F.try_to_date(as_column(value), "yyyy-MM-dd")


def iso_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")


def iso_stamp(stamp: Stamp = None) -> Column:
    """Extraction stamp as ISO text: the given moment, or the start of the query."""
    if stamp is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    if isinstance(stamp, Column):
        return stamp
    return F.lit(stamp.isoformat() if isinstance(stamp, datetime) else stamp)


def month_end(value: Column | str) -> Column:
    return F.last_day(F.to_date(as_column(value)))


def simple_return(current: Column | str, previous: Column | str) -> Column:
    """``current / previous - 1``; NULL when the previous value is missing or zero."""
    return F.try_divide(as_column(current), as_column(previous)) - F.lit(1.0)


def change_percent(change: Column | str, previous_close: Column | str) -> Column:
    """Percent change to two digits, 0 when the previous close is not positive."""
    change, previous = as_column(change), as_column(previous_close)
    return F.when(previous > 0, stable_round(change / previous * 100, 2)).otherwise(F.lit(0.0))


def dollar_volume_billions(price: Column | str, volume: Column | str) -> Column:
    return stable_round(as_column(price) * as_column(volume) / F.lit(1e9), 2)


def signed_percent(value: Column | str, digits: int = 1) -> Column:
    """Text such as ``+1.2%`` or ``-0.4%``."""
    return F.format_string(f"%+.{digits}f%%", as_column(value))


def case_label(value: Column | str, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Searched CASE over membership lists."""
    value = as_column(value)
    label = None
    for name, members in groups.items():
        test = value.isin(*members)
        label = F.when(test, name) if label is None else label.when(test, name)
    return F.lit(default) if label is None else label.otherwise(default)


def build_or_rent(category: Column | str, labels: Mapping[str, str] = C.GROUP_LABELS) -> Column:
    return case_label(category, {text: [name] for name, text in labels.items()}, C.NO_GROUP_LABEL)


def chain_rank(category: Column | str, order: Sequence[str] = C.CHAIN_ORDER) -> Column:
    """1-based position of the category in ``order``; 99 when it is not listed."""
    position = F.array_position(F.array(*[F.lit(c) for c in order]), as_column(category))
    return F.when(position > 0, position.cast("int")).otherwise(F.lit(C.UNRANKED))


def stance_label(
    premium: Column | str,
    cuts: Sequence[float] = C.STANCE_CUTS,
    labels: Sequence[str] = C.STANCE_LABELS,
) -> Column:
    """Bucket by strictly-greater thresholds, the last label catching the rest."""
    premium = as_column(premium)
    label = None
    for cut, name in zip(cuts, labels):
        test = premium > F.lit(float(cut))
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.otherwise(labels[-1])


def is_weekday(day: Column | str) -> Column:
    """Monday to Friday."""
    return F.weekday(as_column(day)) < 5
