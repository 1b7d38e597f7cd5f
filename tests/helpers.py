"""Builders for hand-written boundary rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from polikit.schemas import RAW_COLUMNS, RAW_SCHEMA

BASE = {
    "SEX": 1, "INSR_BEGIN": "01-JAN-15", "INSR_END": "31-DEC-15", "EFFECTIVE_YR": "15", "INSR_TYPE": 1201,
    "INSURED_VALUE": Decimal("100000.00"), "PREMIUM": Decimal("1000.0000"), "OBJECT_ID": 1, "PROD_YEAR": 2010,
    "SEATS_NUM": 4, "CARRYING_CAPACITY": Decimal("1000.00"), "TYPE_VEHICLE": "Pick-up", "CCM_TON": Decimal("2000.00"),
    "MAKE": "TOYOTA", "USAGE": "Private", "CLAIM_PAID": None,
}


def raw(spark, rows: list[dict]):
    data = [tuple({**BASE, **r}[c] for c in RAW_COLUMNS) for r in rows]
    return spark.createDataFrame(data, RAW_SCHEMA)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def fmt(x: dt.date) -> str:
    return x.strftime("%d-%b-%y").upper()
