import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallyspark import schemas as S  # noqa: E402
from tallyspark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", 4)
    yield s
    s.stop()


def ntz(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


@pytest.fixture
def make(spark):
    def _make(schema, rows):
        return spark.createDataFrame(rows, schema)
    return _make


INGEST = dt.datetime(2024, 2, 1, 3, 0, 0)


def customers_rows(*rows):
    """(customer_id, name, email, country, created_at)"""
    return [(*r, INGEST) for r in rows]


def billing_rows(*rows):
    """(transaction_id, customer_id, amount, transaction_date)"""
    from decimal import Decimal
    return [(r[0], r[1], None if r[2] is None else Decimal(r[2]), r[3], INGEST) for r in rows]


def sessions_rows(*rows):
    """(session_id, customer_id, start_time, end_time, data_used_mb)"""
    from decimal import Decimal
    return [(r[0], r[1], r[2], r[3], None if r[4] is None else Decimal(r[4]), INGEST) for r in rows]


__all__ = ["S", "customers_rows", "billing_rows", "sessions_rows", "ntz"]
