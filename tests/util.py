"""Helpers: rows by key, and small transaction frames."""

from __future__ import annotations

import datetime as dt

START = dt.datetime(2024, 3, 1)


def at(**delta) -> dt.datetime:
    return START + dt.timedelta(**delta)


def by_id(df, key="transaction_id"):
    return {r[key]: r for r in df.collect()}


TRANSACTION = ("transaction_id string, customer_id string, merchant_id string, device_id string,"
               " timestamp timestamp_ntz, amount double, payment_method string, country string,"
               " ip_country string")


def transactions(spark, rows):
    """Rows are dicts; anything left out gets a plain default."""
    filled = []
    for i, r in enumerate(rows):
        base = dict(transaction_id=f"T{i}", customer_id="C1", merchant_id="M1", device_id="D1",
                    timestamp=at(hours=i), amount=10.0, payment_method="card", country="US",
                    ip_country="US")
        base.update(r)
        filled.append(tuple(base.values()))
    return spark.createDataFrame(filled, TRANSACTION)


def truth(spark, rows):
    return spark.createDataFrame(
        rows, "transaction_id string, fraud_label int, confirmed_fraud_at timestamp_ntz")
