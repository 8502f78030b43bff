"""User data: alerts, positions, watchlists, and the change log that maintains them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import numeric

CONDITIONS = ("above", "below")


def evaluate_alerts(
    alerts: DataFrame,
    prices: DataFrame,
    above_price: str = "close_price",
    below_price: str | None = None,
) -> DataFrame:
    """Active alerts whose condition the price of their symbol meets (the threshold counts).

    ``prices`` holds one row per symbol, so no alert is repeated. It has no broadcast hint:
    Spark broadcasts it when its measured size allows, and otherwise splits the alerts of a
    popular symbol over several tasks. ``above_price``/``below_price`` name the columns each
    condition looks at, which differ when a batch of ticks is checked by its extremes.
    """
    below_price = below_price or above_price
    quotes = prices.select(
        F.upper("symbol").alias("symbol"),
        F.col(above_price).cast("double").alias("_high"),
        F.col(below_price).cast("double").alias("_low"),
    ).filter(F.col("_high").isNotNull() & F.col("_low").isNotNull())
    limit = F.col("threshold").cast("double")
    is_above = F.col("condition") == "above"
    is_below = F.col("condition") == "below"
    return (
        alerts.filter("is_active")
        .withColumn("symbol", F.upper("symbol"))
        .join(quotes, "symbol")
        .filter((is_above & (F.col("_high") >= limit)) | (is_below & (F.col("_low") <= limit)))
        .select(
            "id",
            "user_id",
            "symbol",
            "condition",
            limit.alias("threshold"),
            F.when(is_above, F.col("_high")).otherwise(F.col("_low")).alias("current_price"),
        )
    )


def alert_message() -> Column:
    """The line a fired alert is announced with."""
    return F.format_string(
        "ALERT TRIGGERED: alert_id=%s user_id=%s %s is %s %s (current: %s)",
        *[
            F.col(name).cast("string")
            for name in ("id", "user_id", "symbol", "condition", "threshold", "current_price")
        ],
    )


def latest_closes(summary: DataFrame) -> DataFrame:
    """The newest known close per symbol, which alerts and positions are valued at."""
    known = summary.filter(F.col("close_price").isNotNull())
    return known.groupBy("symbol").agg(
        F.max_by("close_price", "date").alias("close_price"), F.max("date").alias("date")
    )


def deactivate_alerts(alerts: DataFrame, fired: DataFrame) -> DataFrame:
    """The alerts table with every fired alert switched off."""
    ids = fired.select("id").distinct().withColumn("_fired", F.lit(True))
    return (
        alerts.join(ids, "id", "left")
        .withColumn("is_active", F.when(F.col("_fired"), F.lit(False)).otherwise(F.col("is_active")))
        .drop("_fired")
    )


def watchlist_add(watchlist: DataFrame, requests: DataFrame) -> DataFrame:
    """The requested (user, symbol) pairs that are not on the list yet, once each."""
    wanted = requests.select("user_id", F.upper("symbol").alias("symbol")).distinct()
    listed = watchlist.select("user_id", "symbol")
    return wanted.join(listed, ["user_id", "symbol"], "left_anti")


def portfolio_value(
    positions: DataFrame, latest: DataFrame, price_col: str = "close_price"
) -> DataFrame:
    """Cost, market value, profit and profit in percent of every position.

    Decimals throughout, so that totals do not depend on the order of addition. A position
    without a price keeps its cost and has a null value.
    """
    quotes = latest.select("symbol", numeric.money(F.col(price_col)).alias("price"))
    quantity = numeric.money(F.col("quantity"))
    bought = numeric.money(F.col("avg_buy_price"))
    amount = "decimal(38,8)"
    return (
        positions.join(quotes, "symbol", "left")
        .withColumn("cost", (quantity * bought).cast(amount))
        .withColumn("market_value", (quantity * F.col("price")).cast(amount))
        .withColumn("profit", (F.col("market_value") - F.col("cost")).cast(amount))
        .withColumn(
            "profit_pct",
            F.when(
                F.col("cost") > 0, F.col("profit").cast("double") / F.col("cost").cast("double") * 100
            ),
        )
    )


def portfolio_totals(valued: DataFrame) -> DataFrame:
    """Cost, value and profit per user."""
    return valued.groupBy("user_id").agg(
        F.count("*").alias("positions"),
        *[
            F.sum(name).cast("decimal(38,8)").alias(name)
            for name in ("cost", "market_value", "profit")
        ],
    )


def change_rules() -> dict[str, Column]:
    """What a change to the alerts table must satisfy."""
    return {
        "operation_unknown": F.col("op").isin("insert", "update", "delete"),
        "condition_invalid": F.col("condition").isNull() | F.col("condition").isin(*CONDITIONS),
    }


def apply_changes(
    table: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    op_col: str,
    fields: Sequence[str],
    upper: Sequence[str] = ("symbol",),
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The table after a log of inserts, partial updates and deletes, applied in ``seq`` order.

    An update changes only its non-null fields. Changes of rows that do not exist are ignored;
    with the owner among ``keys`` so are changes by anybody else. Columns of the table that are
    neither keys nor fields keep their stored values and are null in inserted rows. Columns
    named in ``upper`` are compared and stored in upper case, keys as well.

    The log is read once and folded by one aggregation, partial in each task before the shuffle: of
    a key it keeps the last insert or delete, and for each field the last change that names it with
    its value, so no key's history is brought together. Where no field is a text the fold is a hash
    aggregation; for texts Spark sorts a task's rows by key.
    """
    keys = list(keys)
    at = F.col(seq)
    kind = F.when(F.col(op_col) == "insert", 1).when(F.col(op_col) == "delete", 2).otherwise(0)
    raised = {name: F.upper(name) for name in upper if name in (*fields, *keys)}
    log = changes.withColumns({**raised, "_kind": kind})
    # Positions double as (position, kind) numbers: the last insert or delete and which it was.
    folded = [F.max(F.when(F.col("_kind") > 0, at * 2 + F.col("_kind") - 1)).alias("_reset")]
    for name in fields:
        given = (F.col("_kind") != 2) & F.col(name).isNotNull()
        folded += [
            F.max(F.when(given, at)).alias(f"_at_{name}"),
            F.max_by(name, F.when(given, at)).alias(f"_new_{name}"),
        ]
    latest = log.groupBy(*keys).agg(*folded)

    stored = table.withColumns({n: F.upper(n) for n in upper if n in keys})
    joined = stored.withColumn("_stored", F.lit(True)).join(latest, keys, "full_outer")
    reset_at, was_delete = F.floor(F.col("_reset") / 2), F.col("_reset") % 2 == 1
    inserted = F.coalesce(~was_delete, F.lit(False))
    deleted = F.coalesce(was_delete, F.lit(False))
    alive = ~deleted & (inserted | F.coalesce(F.col("_stored"), F.lit(False)))
    out = {}
    for name in fields:
        later = F.col("_reset").isNull() | (F.col(f"_at_{name}") >= reset_at)
        changed = F.when(later, F.col(f"_new_{name}"))
        base = F.when(inserted, F.lit((defaults or {}).get(name))).otherwise(F.col(name))
        kind = table.schema[name].dataType
        out[name] = F.coalesce(changed.cast(kind), base.cast(kind)).alias(name)
    return joined.filter(alive).select(*[out.get(name, F.col(name)) for name in table.columns])
