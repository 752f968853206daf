"""The layers raw -> bronze -> silver -> gold in one session, with checks in between."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barmart.functions.calendar import with_calendar
from barmart.operators.cleaning import NULL_KEY, accepted_rows, newest_per, rejected_rows
from barmart.operators.features import enrich, enrich_days
from barmart.operators.joins import join_bars
from barmart.operators.layout import partition_skew, rows_per_key
from barmart.operators.quality import quality_report, summarise
from barmart.operators.ranking import groups_fit
from barmart.operators.series import calendar_bounded, short_series
from barmart.plans import gold
from barmart.schemas import Bars
from barmart.sources.lookup import coin_lookup
from barmart.sources.payloads import BODY, REASON, TROUBLE, flatten_ohlc, zip_market
from barmart.sources.raw import read_market, read_ohlc, read_payloads
from barmart.sources.tables import append_new, append_table, held, merge_newest, read_table, table_exists, write_table

log = logging.getLogger(__name__)

LAYERS = ("bronze", "quality", "silver", "gold")
SOURCES = {"ohlc": read_ohlc, "market": read_market}
ORIGIN = ["coin_id", "_source_file", "_run_id", "_ingested_at"]
PAYLOAD_SOURCES = {
    "ohlc": lambda spark, raw, stream=False: flatten_ohlc(read_payloads(spark, raw, "ohlc", stream), ORIGIN),
    "market": lambda spark, raw, stream=False: zip_market(read_payloads(spark, raw, "market", stream), ORIGIN),
}
BAR_KEY, NEWEST = ["coin_id", "timestamp_ms"], ["_run_id"]
GOLD_TABLES = {
    "gold_daily_summary": lambda silver, lookup, bars, series: gold.daily_summary(silver, lookup, bars, series=series),
    "gold_weekly_rankings": lambda silver, lookup, bars, series: gold.weekly_rankings(
        silver, bars, gold.weeks_fit(silver, bars), series
    ),
    "gold_volatility_report": lambda silver, lookup, bars, series: gold.volatility_report(silver, bars, series),
    "gold_regime_summary": lambda silver, lookup, bars, series: gold.regime_summary(silver, bars),
}


@dataclass(frozen=True)
class Outcome:
    ok: bool
    seconds: float
    rows: dict[str, int]
    error: str = ""


@dataclass(frozen=True)
class Places:
    """Where and how the layers read and write.

    Bronze and silver are partitioned by ``partition_by``: the key by default, which suits
    up to some thousands of keys; with more, use ("event_year",) or (), as every key would
    become a directory of small files. Bronze names its key ``coin_id`` whatever ``Bars`` says.
    ``payloads``: the raw files are whole response bodies. ``days``: see ``join_bars``.
    ``incremental``: bronze reads only raw files that no run has read, and merges them into the
    partitions they touch; that needs partitions that new rows meet few of, such as
    ("event_year", "event_month").
    """

    raw: str
    out: str
    fmt: str = "parquet"
    partition_by: tuple[str, ...] = ("coin_id",)
    payloads: bool = False
    days: str = "merged"
    incremental: bool = False

    def table(self, name: str) -> str:
        return f"{self.out}/{name}"


def clean(rows: DataFrame) -> DataFrame:
    """Accepted rows of a raw source, the newest run's copy of each (key, time stamp)."""
    return newest_per(accepted_rows(rows), BAR_KEY, NEWEST)


def set_aside(rows: DataFrame, source: str, places: Places) -> None:
    """Store rejected rows, unless an earlier run has: a row is known by its source file and its text."""
    bad = rejected_rows(rows)
    if REASON in rows.columns:
        bad = bad.withColumn("_quarantine_reason", F.coalesce(REASON, F.lit(NULL_KEY))).drop(REASON)
    known_by = [c for c in bad.columns if c != "_ingested_at"]
    if append_new(bad, places.table(f"quarantine/{source}"), known_by):
        log.warning("%s: rows without key set aside", source)


def accepted_bars(rows: DataFrame) -> DataFrame:
    return clean(rows.drop(REASON, BODY)).drop("_corrupt_record", *TROUBLE)


def build_bronze(spark: SparkSession, places: Places) -> dict[str, int]:
    """Store both sources; rejected rows that aren't stored yet are appended to ``quarantine/<source>``.

    The rejects are counted in a pass of their own columns and stored before the accepted
    rows, so they are kept whatever the accepted side holds, and an empty table is stored
    as one. A market body whose arrays differ in length is logged.
    """
    stored = {}
    for source, read in (PAYLOAD_SOURCES if places.payloads else SOURCES).items():
        rows = with_calendar(read(spark, places.raw))
        name = f"bronze_{source}"
        set_aside(rows, source, places)
        stored[name] = write_table(accepted_bars(rows), places.table(name), places.partition_by, places.fmt)
        if "length_mismatch" in rows.columns:
            stored["market_bodies_uneven"] = _uneven_bodies(rows)
    return stored


def update_bronze(spark: SparkSession, places: Places) -> dict[str, int]:
    """Bring raw files that no run has read into both bronze tables, and end; returns their rows and the files read.

    A file stream remembers in ``_progress/<source>`` what it has read. Its batches may be repeated after a failure: merging
    the newest rows of a key and setting rejects aside give the same tables then.
    """
    stored = {}
    for source, read in (PAYLOAD_SOURCES if places.payloads else SOURCES).items():
        name, new_files = f"bronze_{source}", []

        def merge(batch: DataFrame, _: int, source: str = source, name: str = name, new_files: list[int] = new_files) -> None:
            with held(batch) as rows:
                set_aside(rows, source, places)
                merge_newest(accepted_bars(rows), places.table(name), places.partition_by, BAR_KEY, NEWEST, places.fmt)
                new_files.append(rows.agg(F.count_distinct("_source_file")).first()[0])
                if "length_mismatch" in rows.columns:
                    stored["market_bodies_uneven"] = stored.get("market_bodies_uneven", 0) + _uneven_bodies(rows)

        stream = with_calendar(read(spark, places.raw, stream=True)).writeStream.foreachBatch(merge)
        stream = stream.option("checkpointLocation", places.table(f"_progress/{source}")).trigger(availableNow=True)
        stream.start().awaitTermination()
        stored[f"{source}_files_read"] = sum(new_files)
        known = table_exists(spark, places.table(name))
        stored[name] = read_table(spark, places.table(name), places.fmt).count() if known else 0
    return stored


def _uneven_bodies(rows: DataFrame) -> int:
    """How many bodies had arrays of different length, so that elements were left over."""
    bodies = rows.filter("length_mismatch").select("_source_file").distinct().count()
    if bodies:
        log.warning("market: %d bodies with arrays of different length", bodies)
    return bodies


def build_silver(spark: SparkSession, places: Places, bars: Bars) -> dict[str, int]:
    prices = read_table(spark, places.table("bronze_ohlc"), places.fmt)
    measures = read_table(spark, places.table("bronze_market"), places.fmt)
    joined = join_bars(prices, measures, bars, places.days)
    # Merged days hold one bar per key, so a date holds no more rows than in the measures.
    fits = places.days == "merged" and groups_fit(measures, [bars.time])
    if places.days == "all":
        # Rows of a day are told apart by their time stamp, and by their place among equal ones.
        enriched = enrich_days(joined, short_series(joined, bars))
    else:
        enriched = enrich(joined, bars, fits, unique=True)  # one bar for each key and day, by the merge
    # Uncut series leave each (bounded) key in one task, sorted: one file per key without another exchange.
    clustered = places.days == "merged" and calendar_bounded(enriched, bars) and places.partition_by == (bars.key,)
    path = places.table("silver_enriched")
    stored = {"silver_enriched": write_table(enriched, path, places.partition_by, places.fmt, clustered)}
    if places.days == "merged":
        days = prices.select(bars.key, bars.time).distinct().count()
        stored["price_rows_merged"] = prices.count() - days
        log.info("silver: %d price rows merged into the bar of their day", stored["price_rows_merged"])
    return stored


def build_gold(
    spark: SparkSession, places: Places, bars: Bars, lookup: DataFrame | None, keep_silver: bool
) -> dict[str, int]:
    """Store the four summary tables.

    By default each reads its few columns from the stored silver table. ``keep_silver``
    holds the whole table persistent meanwhile, which pays off only where it fits. Whether a
    key and date has several rows is measured on the stored table, whatever run wrote it.
    """
    lookup = coin_lookup(spark) if lookup is None else lookup

    def store(silver: DataFrame) -> dict[str, int]:
        series = gold.series_of(silver, bars)
        if series != bars:
            log.info("gold: several rows for a key and date; series run by %s", series.order)
            series = short_series(silver, series)
        return {
            name: write_table(build(silver, lookup, bars, series), places.table(name)) for name, build in GOLD_TABLES.items()
        }

    silver = read_table(spark, places.table("silver_enriched"), places.fmt)
    if not keep_silver:
        return store(silver)
    with held(silver) as kept:
        return store(kept)


def check_tables(spark: SparkSession, places: Places, bars: Bars, tables: tuple[str, ...]) -> dict[str, int]:
    """Append the checks of the given tables to ``quality_report``; returns passed and failed."""
    totals = {"passed": 0, "failed": 0}
    for name in tables:
        report = quality_report(read_table(spark, places.table(name), places.fmt), bars)
        with held(report) as kept:
            append_table(kept, places.table("quality_report"))
            found = summarise(kept).first()
        totals = {k: totals[k] + found[k] for k in totals}
    return totals


def describe_layout(spark: SparkSession, places: Places, bars: Bars, top: int = 20) -> dict[str, int]:
    """Log the largest keys and the spread over partitions of the silver table."""
    silver = read_table(spark, places.table("silver_enriched"), places.fmt)
    largest = {str(row[bars.key]): row["count"] for row in rows_per_key(silver, bars.key).take(top)}
    log.info("rows per key: %s", largest)
    log.info("partitions: %s", partition_skew(silver).first())
    return largest


def run(
    spark: SparkSession,
    raw: str,
    out: str,
    layers: tuple[str, ...] = LAYERS,
    bars: Bars = Bars(),
    lookup: DataFrame | None = None,
    fmt: str = "parquet",
    keep_silver: bool = False,
    partition_by: tuple[str, ...] = ("coin_id",),
    payloads: bool = False,
    days: str = "merged",
    incremental: bool = False,
) -> dict[str, Outcome]:
    """Run the requested layers in order; one whose parent failed is left out.

    ``layers`` is any subset of bronze, quality, silver, gold and layout. Quality runs
    on the bronze tables and again on silver. A layer not requested counts as done.

    ``days``: "merged" makes one bar of all rows of a key and day before the join; "all"
    joins them as they are, which multiplies the rows of a day, and runs the series windows
    along the time stamp. Bronze and ``partition_by`` use the key name ``coin_id``.

    ``incremental``: bronze reads new raw files only (``Places``); needs ``partition_by``.
    """
    if incremental and not partition_by:
        raise ValueError("incremental runs need partition_by")
    places = Places(raw, out, fmt, partition_by, payloads, days, incremental)
    bronze = update_bronze if incremental else build_bronze
    both = ("bronze_ohlc", "bronze_market")
    plan: list[tuple[str, str, str, Callable[[], dict[str, int]]]] = [
        ("bronze", "bronze", "", lambda: bronze(spark, places)),
        ("quality", "quality_bronze", "bronze", lambda: check_tables(spark, places, bars, both)),
        ("silver", "silver", "bronze", lambda: build_silver(spark, places, bars)),
        ("quality", "quality_silver", "silver", lambda: check_tables(spark, places, bars, ("silver_enriched",))),
        ("gold", "gold", "silver", lambda: build_gold(spark, places, bars, lookup, keep_silver)),
        ("layout", "layout", "silver", lambda: describe_layout(spark, places, bars)),
    ]
    unknown = set(layers) - {layer for layer, *_ in plan}
    if unknown:
        raise ValueError(f"unknown layers: {sorted(unknown)}")
    outcomes: dict[str, Outcome] = {}
    broken: set[str] = set()
    for layer, step, parent, work in plan:
        if parent in broken:
            broken.add(step)
        elif layer in layers:
            outcomes[step] = _timed(step, work)
            if not outcomes[step].ok:
                broken.add(step)
    return outcomes


def _timed(step: str, work: Callable[[], dict[str, int]]) -> Outcome:
    start = time.perf_counter()
    try:
        rows, error = work(), None
    except Exception as problem:  # a failed layer is an outcome; later layers depend on it
        log.exception("%s failed", step)
        rows, error = {}, repr(problem)
    outcome = Outcome(error is None, time.perf_counter() - start, rows, error or "")
    log.info("%s: %s", step, outcome)
    return outcome
