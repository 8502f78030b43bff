"""The closed-form market the golden values come from: 30 days of 20 coins."""

from __future__ import annotations

from datetime import date, timedelta

from tickhouse import schemas


def seed_rows(days=30):
    out = []
    for day in range(days):
        for i, (symbol, _name) in enumerate(schemas.COINS):
            opened = 100.0 + 25 * i + day
            closed = opened * (1 + (i - 10) / 100)
            out.append(
                (
                    symbol,
                    date(2026, 4, 2) + timedelta(days=day),
                    opened,
                    max(opened, closed) * 1.01,
                    min(opened, closed) * 0.99,
                    closed,
                    10000.0 + 100 * i + day,
                )
            )
    return out


def seed_summary(spark):
    return spark.createDataFrame(seed_rows(), schemas.DAILY_BAR)
