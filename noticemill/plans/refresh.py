"""A whole run: parse, merge, compare, store, chart.  A failing chart does not stop the others."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import charts, diff, history, merge
from ..sinks import report, runs, store
from ..sources import envelopes

CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "timeline": charts.timeline,
    "monthly": charts.monthly_ma3,
    "rolling": charts.daily_rolling30,
    "companies": charts.top_companies,
    "county_month": charts.county_month,
    "treemap": charts.treemap_leaves,
    "sectors": charts.sector_breakdown,
    "lead_time": charts.lead_time_hist,
    "counties": charts.county_top,
}
#: Charts over all years, of history and live notices together.
YEAR_CHARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "years": lambda records: history.fiscal_year_summary(records, list(range(2014, 2025))),
    "year_months": history.multiyear_month,
}

MANIFEST = "chart string, status string, error string"


@dataclass
class Outcome:
    totals: Row
    entry: Row
    manifest: DataFrame
    report: str
    message: tuple[str, str] | None
    failed: dict[str, str] = field(default_factory=dict)


def run(
    spark: SparkSession, parsed: DataFrame, folder: str, run_id: str, run_ts: str, source_url: str = "", past: DataFrame | str | None = None, dry_run: bool = False
) -> Outcome:
    """Store a snapshot of the parsed notices, its changes against the run before, and the chart datasets.

    The baseline of both the change log and the report is the last committed run.  Records, totals and change line are committed
    together, before the charts are written under ``charts``; the manifest has the status of each.  ``past`` has the records of
    earlier years, or names the folder of their envelopes.  A ``dry_run`` writes nothing, and charts are not looked at.
    """
    base = runs.head(spark, folder)
    before = next((r for r in runs.ids(spark, folder) if r < run_id), None)
    notices = merge.merge_duplicates(parsed).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        baseline = store.read_snapshot(spark, folder, before)
        entry = diff.change_entry(notices, baseline if before else None, run_ts, store.FIELDS)
        sums = store.payload(notices, run_ts, source_url)
        if not dry_run:
            store.write_run(spark, folder, run_id, notices, sums, entry, base, run_ts)
        line, totals = entry.first(), sums.first()
        text = report.change_report(notices, baseline, run_ts, [line])
        note = report.message(line, totals.total_records, totals.total_employees)
        if dry_run:
            return Outcome(totals, line, spark.createDataFrame([], MANIFEST), text, note)
        live = notices.drop("ord")
        if isinstance(past, str):
            past = envelopes.history(spark, past)
        records = history.union_sources(live.where(F.lit(False)) if past is None else past, live)
        plans = [*((n, c, notices) for n, c in CHARTS.items()), *((n, c, records) for n, c in YEAR_CHARTS.items())]
        failed, status = {}, []
        for name, chart, rows in plans:
            try:
                chart(rows).write.mode("overwrite").parquet(f"{folder}/charts/{name}")
                found = "empty" if spark.read.parquet(f"{folder}/charts/{name}").isEmpty() else "ok"
            except PySparkException as error:
                failed[name], found = str(error).splitlines()[0], "error"
            status.append((name, found, failed.get(name)))
        manifest = spark.createDataFrame(status, MANIFEST)
        manifest.write.mode("overwrite").json(f"{folder}/manifest")
        return Outcome(totals, line, manifest, text, note, failed)
    finally:
        notices.unpersist()
