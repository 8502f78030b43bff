"""Daily bars kept up to date by what changed in silver, found by digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.functions import temporal
from tickhouse.operators import bars, digests, silver
from tickhouse.session import settle
from tickhouse.sources.lake import LakeTable

GROUP = ("symbol", "date")
VALUES = ("open_time", "open", "high", "low", "close", "volume")
PARTITION = "year"


def refresh_bars(stored: LakeTable, daily: LakeTable, seen: LakeTable, stamps: LakeTable) -> DataFrame:
    """Bring the bars ``daily`` up to date with the candles ``stored``; returns what was recomputed.

    ``stamps`` has a digest of the files of each year of candles, ``seen`` one of the candles behind each
    bar. Years whose files are as they were are not read. In the others the digests of all days are
    compared, and only days that differ are computed again, added or removed. The result has symbol,
    date and gone. Bars are written first and stamps last, so a run that died is made up for by
    the next one.
    """
    spark = stored.spark
    stamped = settle(digests.file_stamps(spark, stored.path, [PARTITION]), "stamps")
    if daily.exists() and seen.exists() and stamps.exists():
        differ = digests.changed_groups(stamps.read(), stamped, [PARTITION])
    else:
        differ = stamped.select(PARTITION, F.lit(False).alias("gone"))
    years = settle(differ.select(F.col(PARTITION).cast("int").alias(PARTITION)), "years")
    nothing = spark.createDataFrame([], "symbol string, date date, gone boolean")
    if years.isEmpty():
        return nothing
    candles = silver.stg_historical(stored.read().join(years, PARTITION, "left_semi"))
    dated = candles.withColumn("date", temporal.day_of(F.col("open_time")))
    fresh = settle(digests.group_digests(dated, GROUP, VALUES), "digests")
    known = [F.col(name) for name in fresh.columns]
    in_years = F.year("date").alias(PARTITION)
    if daily.exists() and seen.exists():
        before = seen.read().select(*known, in_years).join(years, PARTITION, "left_semi").select(*known)
        elsewhere = seen.read().select(*known, in_years).join(years, PARTITION, "left_anti").select(*known)
    else:
        before = elsewhere = fresh.limit(0)
    changed = settle(digests.changed_groups(before, fresh, GROUP), "changed-days")
    if not changed.isEmpty():
        computed = bars.daily_ohlcv_touched(candles, changed.filter(~F.col("gone"))).select(*bars.BAR)
        if daily.exists():
            kept = daily.read().select(*bars.BAR).join(changed, list(GROUP), "left_anti")
            computed = kept.unionByName(computed)
        daily.overwrite(computed)
        seen.overwrite(elsewhere.unionByName(fresh))
    stamps.overwrite(stamped)
    return changed
