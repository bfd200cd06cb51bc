"""Zone-less time literals, so a cut-off never depends on the session's time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def ts_literal(moment: datetime | str) -> Column:
    text = moment.isoformat(sep=" ") if isinstance(moment, datetime) else moment
    return F.lit(text).cast("timestamp_ntz")


def date_literal(day: date | str) -> Column:
    return F.lit(str(day)).cast("date")
