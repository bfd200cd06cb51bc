from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from helpers import LEDGER, SETTLEMENT  # noqa: E402

from tallyline.session import local_session  # noqa: E402

@pytest.fixture(scope="session")
def spark():
    return local_session(8, partitions=4, memory="4g")


@pytest.fixture
def ledger(spark):
    """Rows given as (payment, type, paise, time of day) on the 15th."""
    from datetime import datetime

    def make(*rows):
        data = [
            (f"e{i}", p, "M1", kind, paise, "INR", t and datetime.fromisoformat(f"2025-09-15 {t}"), "upi")
            for i, (p, kind, paise, t) in enumerate(rows)
        ]
        return spark.createDataFrame(data, LEDGER)

    return make


@pytest.fixture
def settlement(spark):
    """Rows given as (utr, payment, gross paise, captured on, remarks)."""
    from datetime import date

    def make(*rows):
        data = [
            (utr, p, "M1", gross, 0, 0, gross, date.fromisoformat(day), date(2025, 9, 15), remarks)
            for utr, p, gross, day, remarks in rows
        ]
        return spark.createDataFrame(data, SETTLEMENT)

    return make
