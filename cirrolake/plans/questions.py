"""Analysts' questions on Silver: recent change, comparison with the past week, extremes, coverage, frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cirrolake.functions.measures import mean
from cirrolake.operators.dedupe import first_per_key, total_order
from cirrolake.plans.dashboard import Gold

DAY = 86_400

# What a row of the past-week window is: the observation itself, itself `days` later, or a whole day's total.
OWN, MOVED, WHOLE = 0, 1, 2


def recent_trend(
    silver: DataFrame, hours: int = 24, unit: str = "hour", scale: int | None = None, partition: str | None = None
) -> DataFrame:
    """Average temperature and humidity per hour (or day) over the last `hours` before the newest observation.

    With `partition`, the name of Silver's date partition column, only the partitions of those hours are read.
    """
    last = silver
    if partition is not None:
        last = silver.where(F.col(partition) == silver.agg(F.max(partition)).scalar())
    start = last.agg((F.max("observed_at") - F.expr(f"INTERVAL {int(hours)} HOURS")).alias("start"))
    recent = silver.where(F.col("observed_at") > start.scalar())
    if partition is not None:
        recent = recent.where(F.col(partition) >= start.select(F.to_date("start")).scalar())
    return recent.groupBy(F.date_trunc(unit, "observed_at").alias("period")).agg(
        mean("temperature", scale).alias("avg_temperature"),
        mean("humidity", scale).alias("avg_humidity"),
    )


def against_past_week(silver: DataFrame, days: int = 7, scale: int | None = None) -> DataFrame:
    """Each observation's temperature next to the place's average over the `days` days before it.

    The past of an observation on day D is the whole of days D-1 .. D-(days-1), the part of D before it, and the part
    of day D-days from the same time of day on. Whole days enter as one total for each day of a place that has rows,
    summed over its daily totals, and rows also appear once, moved `days` days ahead. So all that a day of a place needs
    meets under (place, day): the group stays as small as a day, however long the place's history is. Only daily totals,
    one for each day of the calendar, meet under the place.
    """
    value = F.col("temperature") if scale is None else F.col("temperature").cast(f"decimal(18,{scale})")
    at = F.unix_seconds("observed_at")
    rows = silver.where(F.col("place").isNotNull() & F.col("observed_at").isNotNull()).select(
        "id", "place", "observed_at", "temperature", value.alias("_v"), at.alias("_at"), F.floor(at / DAY).alias("_day")
    )
    n = F.when(F.col("_v").isNotNull(), 1).otherwise(0).cast("bigint")

    def part(kind: int, shift: int) -> Column:
        """The row as it counts on its own day, or `shift` days later."""
        return F.struct(
            F.lit(kind).alias("_kind"), (F.col("_day") + shift).alias("_day"), (F.col("_at") + shift * DAY).alias("_at")
        )

    parts = rows.select(
        "id", "place", "observed_at", "temperature", "_v", n.alias("_n"), F.inline(F.array(part(OWN, 0), part(MOVED, days)))
    )
    if days > 1:
        daily = rows.groupBy("place", "_day").agg(F.sum("_v").alias("_v"), F.count("_v").alias("_n"))
        before = Window.partitionBy("place").orderBy("_day").rangeBetween(-(days - 1), -1)
        ahead = daily.select("place", "_day", F.sum("_v").over(before).alias("_v"), F.sum("_n").over(before).alias("_n"))
        whole = ahead.withColumns({"_kind": F.lit(WHOLE), "_at": F.col("_day") * DAY})
        parts = parts.unionByName(whole, allowMissingColumns=True)
    day = Window.partitionBy("place", "_day").orderBy("_at")
    earlier = day.rangeBetween(Window.unboundedPreceding, -1)
    everywhere = day.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def past(column: str) -> Column:
        def of(kind: int, window) -> Column:
            return F.coalesce(F.sum(F.when(F.col("_kind") == kind, F.col(column))).over(window), F.lit(0))

        # Moved rows from now on are all of them but those before: a frame that ends at the group's end would be
        # summed anew for every row.
        later = of(MOVED, everywhere) - of(MOVED, earlier)
        return of(OWN, earlier) + later + of(WHOLE, everywhere)

    framed = parts.withColumns({"_sum": past("_v"), "_count": past("_n")}).where(F.col("_kind") == OWN)
    week = F.col("_sum").cast("double") / F.nullif(F.col("_count"), F.lit(0))
    return framed.select("id", "place", "observed_at", "temperature", week.alias("week_avg")).withColumn(
        "difference", F.col("temperature") - F.col("week_avg")
    )


def latest_per_place(silver: DataFrame) -> DataFrame:
    """Current conditions: the newest observation of each place."""
    rows = silver.where(F.col("place").isNotNull()).select("place", "observed_at", "temperature", "wind_speed", "id")
    order = total_order(rows, F.col("observed_at").desc_nulls_last(), F.col("id").asc_nulls_last())
    return first_per_key(rows, ["place"], order)


def current_extremes(silver: DataFrame) -> DataFrame:
    """Which place is now hottest, coldest and windiest; of equal ones the first by name."""
    latest = latest_per_place(silver)

    def pick(column: str, highest: bool) -> Column:
        # A maximum over (value, ...) would prefer the last name; negating makes one form serve both ends.
        v = F.col(column) if highest else -F.col(column)
        best = F.struct((-v).alias("rank"), F.col("place").alias("place"))
        return F.min(F.when(v.isNotNull(), best))

    kinds = (("hottest", "temperature", True), ("coldest", "temperature", False), ("windiest", "wind_speed", True))
    picked = latest.agg(*[pick(c, high).alias(k) for k, c, high in kinds])
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("extreme"),
                F.col(k)["place"].alias("place"),
                ((-F.col(k)["rank"] if high else F.col(k)["rank"]) + F.lit(0.0)).alias("value"),
            )
            for k, _, high in kinds
        ]
    )
    return picked.select(F.inline(rows))


def hour_words(silver: DataFrame) -> DataFrame:
    """(place, block, word, low, high): the hours of each place as bits, 64 hours since 1970 a word, and their ends.

    Words of tasks, batches or dates unite by OR, so a row that occurs again changes nothing, and one number travels
    where a place has up to 64 hours.
    """
    number = F.floor(F.unix_seconds("observed_at") / 3600)
    hours = silver.where("observed_at is not null").select("place", number.alias("n"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("n").bitwiseAND(F.lit(63)).cast("int"))
    words = hours.groupBy("place", F.shiftright("n", 6).alias("block"))
    return words.agg(F.bit_or(bit).alias("word"), F.min("n").alias("low"), F.max("n").alias("high"))


def coverage(silver: DataFrame, locations: DataFrame) -> DataFrame:
    """Per listed place the hours with data, the hours expected between the first and last hour seen, and the ratio.

    A place without data is listed with zero hours. Repeated rows count once.
    """
    seen = hour_words(silver).groupBy("place")
    seen = seen.agg(F.sum(F.bit_count("word")).alias("hours"), F.min("low").alias("low"), F.max("high").alias("high"))
    span = seen.agg((F.max("high") - F.min("low") + 1).cast("bigint").alias("expected"))
    listed = locations.select(F.col("name").alias("place"))
    return (
        listed.join(seen.select("place", "hours"), "place", "left")
        .select("place", F.coalesce("hours", F.lit(0)).cast("bigint").alias("hours"), span.scalar().alias("expected"))
        .withColumn("ratio", F.col("hours") / F.nullif(F.col("expected"), F.lit(0)))
    )


def missing_spans(silver: DataFrame, locations: DataFrame) -> DataFrame:
    """(place, start, end, hours): the runs of hours that each listed place lacks, from the first to the last hour seen.

    A run lies between two neighbouring hours of a place, the hour before the first and the one after the last among
    them. Hours travel as words of bits and become rows where a place's words have met, so a place has at most one row
    for each hour of the calendar.
    """
    words = hour_words(silver)
    bounds = words.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    edges = F.array(bounds.select("low").scalar() - 1, bounds.select("high").scalar() + 1)
    listed = locations.select(F.col("name").alias("place")).distinct()
    # A word of the border hours has two numbers, a word of data its 64 bits: both open into numbers of hours.
    borders = listed.select("place", edges.alias("numbers"))
    set_bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("word", i) == 1)
    numbers = F.transform(set_bits, lambda i: F.col("block") * 64 + i)
    seen = words.join(listed, "place", "left_semi").select("place", numbers.alias("numbers"))
    met = seen.unionByName(borders).repartition("place").select("place", F.explode("numbers").alias("n"))
    after = F.lead("n").over(Window.partitionBy("place").orderBy("n"))
    gaps = met.withColumn("after", after).where("after > n + 1")
    return gaps.select(
        "place",
        F.timestamp_seconds((F.col("n") + 1) * 3600).alias("start"),
        F.timestamp_seconds((F.col("after") - 1) * 3600).alias("end"),
        (F.col("after") - F.col("n") - 1).cast("bigint").alias("hours"),
    )


def missing_hours(silver: DataFrame, locations: DataFrame) -> DataFrame:
    """The same runs hour by hour."""
    hours = F.sequence("start", "end", F.expr("INTERVAL 1 HOUR"))
    return missing_spans(silver, locations).select("place", F.explode(hours).alias("hour"))


def condition_frequency(gold: Gold) -> DataFrame:
    """Observations per weather text over all places and dates, with their share."""
    by_key = gold.fact_hourly_weather.groupBy("weather_key").agg(F.sum("observation_count").alias("_n"))
    labels = gold.dim_weather.select("weather_key", "weather_description")
    counts = (
        by_key.join(labels, "weather_key", "left")
        .groupBy("weather_description")
        .agg(F.sum("_n").alias("observation_count"))
    )
    everything = gold.fact_hourly_weather.agg(F.sum("observation_count")).scalar()
    return counts.withColumn("share", F.col("observation_count") / F.nullif(everything, F.lit(0)))
