"""Advisory intervals, site status, feed and bulletin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydrosignal.functions import times
from hydrosignal.operators.joins import DAY, asof_join, covering_intervals
from hydrosignal.operators.ordered import first_per_key, running_totals, time_part

# Texts shown to the public.
LABELS = {"advisory": "Advisory", "uncertain": "Uncertain", "good": "Good", "unknown": "Not Available"}
HIGH = "High probability of elevated bacteria levels."
LOW = "Low probability of elevated bacteria levels."
NO_DATA = "Data unavailable or system error."

FLAG_SUMMARY = ("n_flags", "any_offline", "any_advisory", "any_uncertain", "flag_text")


def interval_state(start: Column, end: Column, now: Column) -> Column:
    return F.when(end < now, F.lit("EXPIRED")).when(start > now, F.lit("PENDING")).otherwise(F.lit("ACTIVE"))


def flag_summary() -> list[Column]:
    """Aggregates a status decision needs from a group of flags (level, description, id)."""
    level = F.col("level")
    return [
        F.count(F.lit(1)).alias("n_flags"),
        F.bool_or(level == "OFFLINE").alias("any_offline"),
        F.bool_or(level == "ADVISORY").alias("any_advisory"),
        F.bool_or(level == "UNCERTAIN").alias("any_uncertain"),
        F.expr("listagg(description, ' ') within group (order by id)").alias("flag_text"),
    ]


def decide(exceedance: Column, prefix: str = "") -> Column:
    """struct(type, label, reason) from a prediction and the flag summary columns.

    Flags come first; a predicted exceedance overrides them unless one is OFFLINE. Without
    flags the prediction decides, and no prediction is unknown.
    """
    n, offline, advisory, uncertain, text = (F.col(prefix + c) for c in FLAG_SUMMARY)
    flagged = F.coalesce(n, F.lit(0)) > 0
    overrides = flagged & F.coalesce(exceedance, F.lit(False)) & ~offline
    kind = (
        F.when(overrides, F.lit("advisory"))
        .when(flagged & advisory, F.lit("advisory"))
        .when(flagged & uncertain, F.lit("uncertain"))
        .when(flagged, F.lit("unknown"))
        .when(exceedance.isNull(), F.lit("unknown"))
        .when(exceedance, F.lit("advisory"))
        .otherwise(F.lit("good"))
    )
    text = F.coalesce(text, F.lit(""))
    reason = (
        F.when(overrides, F.concat(F.lit(HIGH + " "), text))
        .when(flagged, text)
        .when(exceedance.isNull(), F.lit(NO_DATA))
        .when(exceedance, F.lit(HIGH))
        .otherwise(F.lit(LOW))
    )
    label = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])[kind]
    return F.struct(kind.alias("type"), label.alias("label"), reason.alias("reason"))


#: Aggregates of a segment that need no list of its flags.
COUNTED = ("n_flags", "any_offline", "any_advisory", "any_uncertain")
_AFTER = "INTERVAL '0.000001' SECOND"


def _located(flags: DataFrame) -> DataFrame:
    return (
        flags.withColumnRenamed("location_id", "name")
        .select("name", "id", "start_timestamp", "end_timestamp", "level", "description")
        .filter("start_timestamp <= end_timestamp")
    )


def flag_segments(flags: DataFrame, part_seconds: int = 30 * DAY) -> DataFrame:
    """The time line of each site cut where its set of covering flags changes: a sweep over starts and ends.

    One row per (name, from): how many flags (closed intervals) cover the instants from ``from`` up
    to the site's next row, ``n_flags`` null where there are none, and whether one of each level is
    among them. A flag adds one at its start and takes one away behind its end; running sums along
    parts of a site's time give the counts, so the work grows with the flags and not with their
    overlaps. Flags with a null bound or with end before start cover nothing.
    """
    level = {"any_offline": "OFFLINE", "any_advisory": "ADVISORY", "any_uncertain": "UNCERTAIN"}
    edge = F.inline(
        F.array(
            F.struct(F.col("start_timestamp").alias("from"), F.lit(1).alias("sign")),
            F.struct((F.col("end_timestamp") + F.expr(_AFTER)).alias("from"), F.lit(-1).alias("sign")),
        )
    )
    changes = (
        _located(flags)
        .select("name", "level", edge)
        .groupBy("name", "from")
        .agg(F.sum("sign").alias("n"), *[F.sum(F.when(F.col("level") == v, F.col("sign")).otherwise(0)).alias(f"_{k}") for k, v in level.items()])
    )
    totals = {"n_flags": F.col("n"), **{k: F.col(f"_{k}") for k in level}}
    swept = running_totals(changes, ["name"], time_part(F.col("from"), part_seconds), [F.col("from")], totals)
    # null without flags, so that a site's gaps look like a site without any
    some = lambda c: F.when(F.col("n_flags") > 0, c)
    return swept.select("name", "from", some(F.col("n_flags")).alias("n_flags"), *[some(F.col(k) > 0).alias(k) for k in level])


def segment_flags(segments: DataFrame, flags: DataFrame) -> DataFrame:
    """(name, from, flag_text, flag_ids): descriptions and numbers of the flags that cover each given segment, in order."""
    pairs = covering_intervals(segments.select("name", "from"), _located(flags), ["name"], "from", "start_timestamp", "end_timestamp")
    text = F.expr("listagg(description, ' ') within group (order by id)").alias("flag_text")
    return pairs.groupBy("name", "from").agg(text, F.sort_array(F.collect_list("id")).alias("flag_ids"))


def with_covering_flags(predictions: DataFrame, flags: DataFrame) -> DataFrame:
    """Predictions plus the summary of flags that cover their instant (name = location_id).

    Flags are cut to the time span of their site's predictions, so an open-ended one costs no
    more than that. Each prediction then looks up the segment it falls into; no pair of
    prediction and flag is made, and flags are listed only for segments that hold a prediction.
    ``flag_ids`` lists the covering flags, null where there are none.
    """
    span = predictions.groupBy(F.col("name").alias("location_id")).agg(
        F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to")
    )
    within = (
        flags.join(span, "location_id")
        .filter("start_timestamp <= end_timestamp and start_timestamp <= _to and end_timestamp >= _from")
        .withColumns(
            {
                "start_timestamp": F.greatest("start_timestamp", "_from"),
                "end_timestamp": F.least("end_timestamp", "_to"),
            }
        )
    )
    placed = asof_join(predictions, flag_segments(within), ["name"], "timestamp", "from", [*COUNTED], tie=["from"], part_seconds=DAY)
    lists = segment_flags(placed.filter("n_flags > 0").select("name", "from").distinct(), within)
    joined = placed.join(lists, ["name", "from"], "left")
    return joined.select(*predictions.columns, *FLAG_SUMMARY, "flag_ids")


def recent(predictions: DataFrame, now: Column, tz: str = times.EASTERN, days: int = 7) -> DataFrame:
    """Predictions of the last local days, today included.

    The plain range on the instant is a day wider than the local days and reaches the scan.
    """
    first = F.date_sub(times.local_date(now, tz), days - 1)
    earliest = F.date_sub(first, 2).cast("timestamp")
    return predictions.filter(
        (F.col("timestamp") >= earliest) & (times.local_date(F.col("timestamp"), tz) >= first)
    )


def site_history(
    sites: DataFrame, predictions: DataFrame, flags: DataFrame, now: Column, tz: str = times.EASTERN, days: int = 7
) -> DataFrame:
    """The feed of every known site as a long table, one row per (site, prediction)."""
    return feed(predictions, flags, now, tz, days).join(sites, "name")


def site_flags(sites: DataFrame, flags: DataFrame, now: Column) -> DataFrame:
    """All flags of every known site with their state, one row per (site, flag)."""
    state = interval_state(F.col("start_timestamp"), F.col("end_timestamp"), now)
    return flags.withColumnRenamed("location_id", "name").withColumn("state", state).join(sites, "name")


def feed(predictions: DataFrame, flags: DataFrame, now: Column, tz: str = times.EASTERN, days: int = 7) -> DataFrame:
    """The last local days with labels, covering flags and status."""
    rows = with_covering_flags(recent(predictions, now, tz, days), flags)
    return rows.withColumns(
        {
            "day_label": times.day_label(F.col("timestamp"), tz),
            "timestamp_local": times.local_text(F.col("timestamp"), tz),
            "status": decide(F.col("exceedance")),
        }
    )


def current_status(
    sites: DataFrame, predictions: DataFrame, flags: DataFrame, now: Column, tz: str = times.EASTERN, days: int = 7
) -> DataFrame:
    """One row per site: latest recent prediction decided with the flags active now."""
    latest = first_per_key(recent(predictions, now, tz, days), ["name"], [F.col("timestamp").desc()])
    active = (
        flags.filter((F.col("start_timestamp") <= now) & (F.col("end_timestamp") >= now))
        .withColumnRenamed("location_id", "name")
        .groupBy("name")
        .agg(*flag_summary())
    )
    joined = sites.join(latest, "name", "left").join(active, "name", "left")
    return joined.withColumn("status", decide(F.col("exceedance")))


def bulletin(sites: DataFrame, predictions: DataFrame, link: str, order: str = "name") -> DataFrame:
    """One text: a line per site from its latest prediction, flags ignored."""
    latest = first_per_key(predictions, ["name"], [F.col("timestamp").desc()]).join(sites, "name")
    blank = latest.withColumns(
        {"n_flags": F.lit(0), "flag_text": F.lit(None).cast("string")}
        | {c: F.lit(False) for c in ("any_offline", "any_advisory", "any_uncertain")}
    )
    lines = blank.select(
        order, F.concat_ws(": ", F.col("tweet_name"), decide(F.col("exceedance"))["label"]).alias("line")
    )
    joined = F.expr(f"listagg(line, '\\n') within group (order by {order})")
    return lines.agg(F.concat(joined, F.lit("\n\nMore Info: " + link)).alias("text"))


# Display class by status type.
COLOURS = {"good": "green", "advisory": "red", "uncertain": "yellow"}


def colour(kind: Column) -> Column:
    pairs = [F.lit(x) for kv in COLOURS.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[kind], F.lit("gray"))
