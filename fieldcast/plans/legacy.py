"""Statistics of the older devices: log events and three kinds of synchronised counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcast.functions.pg import same, to_bigint
from fieldcast.tables import Tables, mart

# Thresholds of the play classes and weights of partial plays.
PLAY_CLASSES = {
    "quarter": (0.25, 0.49999),
    "half": (0.499991, 0.74999),
    "threequarters": (0.749991, 0.94999),
}
STARTED_BELOW = 0.25
COMPLETED_ABOVE = 0.94999
END_MARGIN_SECONDS = 10
MIN_SECONDS = 10
IGNORED_CONTENT = "dga"
WEIGHT_QUARTER = "0.3"
WEIGHT_HALF = "0.6"
WEIGHT_THREEQUARTERS = "0.83"
STATS_FACTOR = "1.23"

KEYS = ["contentpackage", "village", "talkingbook", "contentid"]
COUNTERS = {
    "seconds": "totaltimeplayed",
    "started": "countstarted",
    "quarter": "countquarter",
    "half": "counthalf",
    "threequarters": "countthreequarters",
    "completed": "countcompleted",
}


@mart
def filter_played_events(t: Tables) -> DataFrame:
    """Events that count as a play."""
    return t["playedevents"].where(_counts())


def _counts() -> Column:
    """Whether an event counts as a play."""
    return (F.col("timeplayed") >= MIN_SECONDS) & (F.col("totaltime") > 0) & (F.col("contentid") != IGNORED_CONTENT)


def _played(of: Column) -> list[Column]:
    """Seconds and plays by how far they got, of the events for which ``of`` holds.

    The class bounds leave small gaps, and exactly 10 remaining seconds is in no class: such
    plays count in no column.
    """
    done = F.col("percentdone")
    remaining = F.col("totaltime") - F.col("timeplayed")
    broken_off = (remaining > END_MARGIN_SECONDS) & ~F.col("isfinished")

    def plays(condition: Column) -> Column:
        return F.sum(F.when(of, F.when(condition, 1).otherwise(0)))

    classes = [
        plays(done.between(low, high) & broken_off).alias(name) for name, (low, high) in PLAY_CLASSES.items()
    ]
    completed = (done > COMPLETED_ABOVE) | (remaining < END_MARGIN_SECONDS) | F.col("isfinished")
    return [
        F.sum(F.when(of, F.col("timeplayed"))).alias("timeplayed"),
        plays((done < STARTED_BELOW) & broken_off).alias("started"),
        *classes,
        plays(completed).alias("completed"),
    ]


@mart
def logstats_from_played_events(t: Tables) -> DataFrame:
    """Plays per device and message, by how far they got."""
    by = ["packageid", "village", "talkingbookid", "contentid", "totaltime"]
    return t["filter_played_events"].groupBy(*by).agg(*_played(F.lit(True)))


@mart
def played_keys(t: Tables) -> DataFrame:
    """Every (package, village, device, message) that any source knows of."""
    events = t["playedevents"].select(
        F.col("packageid").alias("contentpackage"), "village", F.col("talkingbookid").alias("talkingbook"), "contentid"
    )
    return t["syncaggregation"].select(*KEYS).union(events).distinct()


def _dec(col: Column, precision: int = 18, scale: int = 0) -> Column:
    return col.cast(f"decimal({precision},{scale})")


def _num(text: str) -> Column:
    digits = len(text.replace(".", "").lstrip("0"))
    scale = len(text.split(".")[1])
    return F.lit(text).cast(f"decimal({max(digits, scale)},{scale})")


@mart
def allsources(t: Tables) -> DataFrame:
    """One row per key with the counters of all four sources beside each other.

    The sources lie one below the other, each row with its counters under the name of its source, and meet in one
    aggregate on the four key columns: each fact is read once.  A source that has several rows of a key multiplies it, as
    outer joins would; rows with a NULL in the key make a key of their own and match nothing.  Village and content
    metadata, which multiply rows, come last.
    """
    complete = F.lit(True)
    for key in KEYS:
        complete = complete & F.col(key).isNotNull()
    sources = ("l", "s1", "s2", "s3")
    # joins with villages and messages follow, so a key without either makes no row
    wanted = F.col("village").isNotNull() & F.col("contentid").isNotNull()

    def tagged(rows: DataFrame, source: Column, names: dict[str, str]) -> DataFrame:
        """Keys and the counters with the number of the source that a row counts for, null if it counts for none."""
        counters = F.struct(source.alias("source"), *[F.col(column).cast("bigint").alias(name) for name, column in names.items()])
        return rows.where(wanted).select(*KEYS, F.when(complete & source.isNotNull(), counters).alias("counters"))

    counts = _counts()
    events = (
        t["playedevents"]
        .withColumnsRenamed({"packageid": "contentpackage", "talkingbookid": "talkingbook"})
        .groupBy(*KEYS, "totaltime")
        .agg(F.count_if(counts).alias("plays"), *_played(counts))
        .withColumnRenamed("timeplayed", "seconds")
    )
    number = F.when(F.col("datasource").isin(1, 2, 3), F.col("datasource").cast("int"))
    rows = tagged(events, F.when(F.col("plays") > 0, 0), {name: name for name in COUNTERS}).unionByName(
        tagged(t["syncaggregation"], number, COUNTERS)
    )
    # one shuffle by message serves the sources and the messages' metadata; rows are narrow there, lists are made after it.
    # sorting by a hash first compares numbers, not keys that begin alike
    wide = rows.repartition("contentid").groupBy(F.xxhash64(*KEYS).alias("__key"), *KEYS).agg(F.collect_list("counters").alias("found"))
    for n, s in enumerate(sources):
        wide = wide.withColumn(s, F.explode_outer(F.expr(f"filter(found, c -> c.source = {n})")))
    wide = wide.select(*KEYS, *[F.col(f"{s}.{name}").alias(f"{s}_{name}") for s in sources for name in COUNTERS])
    villages = t["communities"].select("project", F.col("communityname").alias("village"))
    lengths = t["contentmetadata2"].select(F.col("project").alias("__project"), F.col("contentid").alias("__content"), "duration_sec")
    wide = (
        wide.join(villages, "village")
        .join(lengths.repartition("__content"), (F.col("contentid") == F.col("__content")) & same("project", "__project"))
        .drop("__content", "__project")
    )

    def all_of(name: str, prefixes: tuple[str, ...]) -> list[Column]:
        return [F.col(f"{p}_{name}") for p in prefixes]

    full, logged = ("l", "s1", "s2", "s3"), ("l", "s1", "s3")
    stats_seconds = _dec(F.col("s2_completed")) * _num(STATS_FACTOR) * _dec(F.col("duration_sec"), 10)
    seconds_max = F.greatest(
        *[_dec(F.col(c)).cast("decimal(32,2)") for c in ("l_seconds", "s1_seconds", "s3_seconds")],
        stats_seconds.cast("decimal(32,2)"),
    )

    def weighted(weight: str | None, value: Column) -> Column:
        return _dec(value) if weight is None else _num(weight) * _dec(value)

    zero = F.lit(0)
    effective = (
        F.coalesce(weighted(WEIGHT_QUARTER, F.greatest(*all_of("quarter", logged))), zero)
        + F.coalesce(weighted(WEIGHT_HALF, F.greatest(*all_of("half", logged))), zero)
        + F.coalesce(weighted(WEIGHT_THREEQUARTERS, F.greatest(*all_of("threequarters", logged))), zero)
        + F.coalesce(weighted(None, F.greatest(*all_of("completed", full))), zero)
    )
    effective_stats = _dec(F.col("s2_completed")) * _num(STATS_FACTOR)
    effective_flash = (
        weighted(WEIGHT_QUARTER, F.col("s3_quarter"))
        + weighted(WEIGHT_HALF, F.col("s3_half"))
        + weighted(WEIGHT_THREEQUARTERS, F.col("s3_threequarters"))
        + weighted(None, F.col("s3_completed"))
    )

    def sides(name: str, prefixes: tuple[str, ...]) -> list[Column]:
        labels = {"l": "logevents", "s1": "logs", "s2": "stats", "s3": "flash"}
        return [F.col(f"{p}_{name}").alias(f"{name}_{labels[p]}") for p in prefixes]

    started, completed = all_of("started", full), all_of("completed", full)
    return wide.select(
        "project", *KEYS,
        F.col("l_seconds").alias("played_seconds_logevents"),
        F.col("s1_seconds").alias("played_seconds_logs"),
        stats_seconds.alias("played_seconds_stats"),
        F.col("s3_seconds").alias("played_seconds_flash"),
        seconds_max.alias("played_seconds_max"),
        F.greatest(to_bigint(effective), to_bigint(effective_stats)).alias("effectivecompletions_max"),
        effective_flash.alias("effecticecompletions_flash"),
        *sides("started", full),
        F.least(*started).alias("started_min"),
        F.greatest(*started).alias("started_max"),
        (F.greatest(*started) - F.least(*started)).alias("started_variance"),
        *sides("quarter", logged),
        F.greatest(*all_of("quarter", logged)).alias("quarter_max"),
        *sides("half", logged),
        F.greatest(*all_of("half", logged)).alias("half_max"),
        *sides("threequarters", logged),
        F.greatest(*all_of("threequarters", logged)).alias("threequarters_max"),
        *sides("completed", full),
        F.least(*completed).alias("completed_min"),
        F.greatest(*completed).alias("completed_max"),
        # the log events take no part in the smaller side, as in the original view
        (F.greatest(*completed) - F.least(*all_of("completed", ("s1", "s2", "s3")))).alias("completed_variance"),
    )


@mart
def allsources_s(t: Tables) -> DataFrame:
    """``allsources`` in the column types of its stored table: whole numbers, rounded."""
    view = t["allsources"].withColumnRenamed("started_stats", "starts_stats")
    text = {"project", *KEYS}
    return view.select(
        *[F.col(c) if c in text else (to_bigint(F.col(c)) if dtype.startswith("decimal") else F.col(c).cast("bigint")).alias(c)
          for c, dtype in view.dtypes]
    )


@mart
def tbcollections(t: Tables) -> DataFrame:
    """Devices seen per package and community, in either kind of source."""
    synced = t["syncaggregation"].select("contentpackage", F.col("village").alias("communityname"), "talkingbook")
    events = t["playedevents"].select(
        F.col("packageid").alias("contentpackage"), F.col("village").alias("communityname"),
        F.col("talkingbookid").alias("talkingbook"),
    )
    return synced.union(events).distinct()
