"""The change log against a row-by-row replay, watchlists and portfolios."""

import random
from decimal import Decimal

from conftest import rows
from tickhouse.operators import accounts, filters, silver

ALERT = "id long, user_id long, symbol string, condition string, threshold double, is_active boolean"
CHANGE = "seq long, op string, " + ALERT
FIELDS = ("symbol", "condition", "threshold", "is_active")


def replay(table, changes):
    """What a request handler would have done, one request after the other."""
    state = {(r[0], r[1]): list(r[2:]) for r in table}
    for _seq, op, key, user, *values in sorted(changes):
        values[0] = values[0] and values[0].upper()
        if op == "insert":
            if values[3] is None:
                values[3] = True
            state[key, user] = values
        elif (key, user) in state:
            if op == "delete":
                del state[key, user]
            else:
                row = state[key, user]
                state[key, user] = [n if n is not None else o for n, o in zip(values, row)]
    return sorted(((*k, *v) for k, v in state.items()), key=lambda r: tuple(map(repr, r)))


def test_change_log_equals_replay(spark):
    for trial in range(4):
        rng = random.Random(trial)
        table = [
            (i, i % 3, "OLD", rng.choice(["above", "below"]), float(i), rng.random() < 0.5)
            for i in range(12)
        ]
        changes = []
        for seq in range(400):
            key = 0 if seq % 3 == 0 else rng.randrange(20)
            changes.append(
                (
                    seq, rng.choice(["insert", "update", "update", "update", "delete"]), key,
                    key % 3 if rng.random() < 0.9 else 9,
                    rng.choice([None, "btc", "Eth"]), rng.choice([None, "above", "below"]),
                    rng.choice([None, rng.random()]), rng.choice([None, True, False]),
                )
            )
        # Only the owner creates a row.
        changes = [c for c in changes if c[1] != "insert" or c[3] != 9]
        got = accounts.apply_changes(
            spark.createDataFrame(table, ALERT), spark.createDataFrame(changes, CHANGE),
            ["id", "user_id"], "seq", "op", FIELDS, defaults={"is_active": True},
        )
        assert rows(got.select("id", "user_id", *FIELDS)) == replay(table, changes)


def test_other_columns_stay_and_keys_are_upper_case(spark):
    table = spark.createDataFrame(
        [(1, "BTCUSDT", "mine", 1.0), (1, "ETHUSDT", "too", 2.0)],
        "user_id long, symbol string, memo string, quantity double",
    )
    log = spark.createDataFrame(
        [(1, "delete", 1, "btcusdt", None), (2, "update", 1, "ethusdt", 5.0), (3, "insert", 2, "Sol", 7.0)],
        "seq long, op string, user_id long, symbol string, quantity double",
    )
    got = accounts.apply_changes(table, log, ["user_id", "symbol"], "seq", "op", ["quantity"])
    assert got.columns == table.columns
    assert rows(got) == [(1, "ETHUSDT", "too", 5.0), (2, "SOL", None, 7.0)]
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text


def test_bad_changes_are_rejected(spark):
    changes = spark.createDataFrame(
        [(1, "insert", 1, 1, "A", "above", 1.0, None), (2, "insert", 1, 1, "A", "near", 1.0, None),
         (3, "merge", 1, 1, "A", None, 1.0, None), (4, "update", 1, 1, None, None, None, None)],
        CHANGE,
    )
    rejected = silver.quarantine(changes, accounts.change_rules())
    assert [(r.seq, r.reject_reason) for r in rejected.orderBy("seq").collect()] == [
        (2, "condition_invalid"), (3, "operation_unknown")
    ]
    assert silver.passing(changes, accounts.change_rules()).count() == 2


def test_watchlist(spark):
    listed = spark.createDataFrame([(1, 1, "BTC"), (2, 2, "ETH")], "id long, user_id long, symbol string")
    asked = spark.createDataFrame(
        [(1, "btc"), (1, "eth"), (1, "ETH"), (2, "btc")], "user_id long, symbol string"
    )
    assert rows(accounts.watchlist_add(listed, asked)) == [(1, "ETH"), (2, "BTC")]
    assert filters.user_scope(listed, 2).first().symbol == "ETH"


def test_portfolio(spark):
    positions = spark.createDataFrame(
        [(1, 1, "A", 2.0, 10.0), (2, 1, "B", 1.0, 5.0), (3, 2, "A", 0.5, 0.0)],
        "id long, user_id long, symbol string, quantity double, avg_buy_price double",
    )
    prices = spark.createDataFrame([("A", 15.0)], "symbol string, close_price double")
    valued = accounts.portfolio_value(positions, prices)
    got = {r.id: r for r in valued.collect()}
    assert (got[1].cost, got[1].market_value, got[1].profit, got[1].profit_pct) == (
        Decimal(20), Decimal(30), Decimal(10), 50.0
    )
    assert (got[2].cost, got[2].market_value, got[2].profit_pct) == (Decimal(5), None, None)
    assert got[3].profit_pct is None
    totals = {r.user_id: r for r in accounts.portfolio_totals(valued).collect()}
    assert (totals[1].positions, totals[1].cost, totals[1].market_value) == (2, Decimal(25), Decimal(30))
