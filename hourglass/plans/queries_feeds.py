"""Several feeds on one spine, and a daily value as of each hour (J1-J3 together).

The four feeds come from ``events``, one hourly series per ``user_id``; two of
them are stamped hour-ending, as published feeds are, and are shifted back by
the spine join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import time as T
from ..operators import joins as J
from . import inputs as I
from .queries import q

KEYS = ["user_id", "ts"]


def _feed(ev: DataFrame, value, name: str, hour_ending: bool = False) -> DataFrame:
    """One hourly feed; an hour-ending feed carries the end of its hour."""
    hour = T.floor_hour("ts")
    stamp = hour + F.make_dt_interval(hours=F.lit(1)) if hour_ending else hour
    return ev.groupBy("user_id", stamp.alias("ts")).agg(value.alias(name))


def merged(spark, sf) -> DataFrame:
    """Real-time, day-ahead, load and wind feeds on a gap-free spine per series."""
    ev = I.events(spark, sf)
    of = lambda kind: ev.where(F.col("event_type") == kind)
    spine = J.time_spine(ev.select("user_id", T.floor_hour("ts").alias("ts")), "ts", ["user_id"])
    feeds = [_feed(ev, F.avg("value"), "rt"),
             _feed(of("view"), F.avg("value"), "dam", hour_ending=True),
             _feed(of("click"), F.sum("value"), "load", hour_ending=True),
             _feed(of("error"), F.sum("value"), "wind")]
    wide = J.spine_left_join(spine, feeds, KEYS, shift_hours=[0, -1, -1, 0])
    return wide.withColumn("spread", F.col("rt") - F.col("dam"))


_SQL = """
WITH ev AS (SELECT user_id, date_trunc('hour', ts) AS ts, event_type, value FROM events),
spine AS (SELECT user_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM ev GROUP BY user_id),
f AS (SELECT user_id, ts, avg(value) AS rt, avg(value) FILTER (WHERE event_type = 'view') AS dam,
             sum(value) FILTER (WHERE event_type = 'click') AS load, sum(value) FILTER (WHERE event_type = 'error') AS wind
      FROM ev GROUP BY ALL),
m AS (SELECT spine.user_id, spine.ts, rt, dam, load, wind, rt - dam AS spread
      FROM spine LEFT JOIN f ON f.user_id = spine.user_id AND f.ts = spine.ts),
daily AS (SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS ts, sum(value) AS gas
          FROM ev WHERE event_type = 'purchase' GROUP BY ALL)
"""


def _rounded(df: DataFrame, cols) -> DataFrame:
    return df.select(*KEYS, *[F.round(c, 6).alias(c) for c in cols])


@q("merged_feeds", _SQL + """
SELECT user_id, ts, round(rt, 6) AS rt, round(dam, 6) AS dam, round(load, 6) AS load, round(wind, 6) AS wind,
       round(spread, 6) AS spread FROM m""")
def merged_feeds(spark, sf):
    return _rounded(merged(spark, sf), ["rt", "dam", "load", "wind", "spread"])


@q("asof_daily_to_hourly", _SQL + """
SELECT m.user_id, m.ts, round(m.spread, 6) AS spread, round(daily.gas, 6) AS gas
FROM m ASOF LEFT JOIN daily ON m.user_id = daily.user_id AND m.ts >= daily.ts""")
def asof_daily_to_hourly(spark, sf):
    """A day's value is published at the next midnight and holds until a later one."""
    day = T.trunc_ntz("ts", "day") + F.make_dt_interval(days=F.lit(1))
    daily = (I.events(spark, sf, F.col("event_type") == "purchase")
              .groupBy("user_id", day.alias("ts")).agg(F.sum("value").alias("gas")).withColumn("published", F.col("ts")))
    hours = merged(spark, sf).select(*KEYS, "spread", F.col("ts").alias("hour_id"))
    out = J.asof_backward(hours, daily, "ts", ["user_id"], ["gas"], "hour_id", "published")
    return _rounded(out, ["spread", "gas"])
