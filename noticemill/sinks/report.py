"""Texts made from small results: change report, message, manifest."""

from __future__ import annotations

from collections.abc import Iterable
from html import escape

from pyspark.sql import DataFrame, Row

from ..operators import diff

MESSAGE_ENTRIES = 10


def _number(n: object) -> str:
    try:
        return f"{int(n):,}"  # type: ignore[call-overload]
    except (TypeError, ValueError):
        return str(n)


def change_report(new: DataFrame, baseline: DataFrame, run_ts: str, log: Iterable[Row] = ()) -> str:
    """Markdown: totals, the largest entries of either direction, and the last lines of the change log, newest first."""
    t = diff.totals(new, baseline).first()
    added, removed = (diff.largest(side).collect() for side in diff.casefold(new, baseline))
    out = [
        "# Layoff notices: change report",
        f"\n**Generated:** {run_ts}\n",
        "| Metric | Snapshot | Latest | Change |",
        "|---|---|---|---|",
        f"| Records | {t.snapshot_count:,} | {t.latest_count:,} | {t.added_count:+}/{-t.removed_count:+} |",
        f"| Employees | {t.snapshot_employees:,} | {t.latest_employees:,} | {t.employees_delta:+,} |",
        "",
    ]
    for title, rows, n in (("New entries", added, t.added_count), ("Removed entries", removed, t.removed_count)):
        out.append(f"## {title} ({n})\n")
        out += [f"| {r.company} | {r.employees:,} | {r.effective_date or '?'} | {r.county or '?'} |" for r in rows] or ["None."]
        out.append("")
    out.append("## Change log\n")
    lines = [f"- `{r.timestamp}`: +{r.new_count or 0} added, -{r.removed_count or 0} removed, {_number(r.total_employees_new or 0)} employees" for r in log]
    return "\n".join(out + (lines or ["No entries yet."])) + "\n"


def message_html(entry: Row, total_records: int, total_employees: int, run_ts: str = "") -> str | None:
    """The same message as a small HTML page; None if nothing is new.  Texts are escaped."""
    if not entry.new_count:
        return None
    text = lambda v: escape(str(v)) if v not in (None, "") else "?"
    shown = list(entry.new_entries or [])[:MESSAGE_ENTRIES]
    cell = lambda v, right=False: f'<td style="padding:4px 8px{";text-align:right" if right else ""}">{v}</td>'
    rows = [f"<tr>{cell(text(r.company))}{cell(_number(r.employees), True)}{cell(text(r.effective_date))}{cell(text(r.county))}</tr>" for r in shown]
    out = [
        "<html><body>",
        f"<h2>{entry.new_count:,} new layoff notice{'s' if entry.new_count > 1 else ''}</h2>",
        f"<p>{entry.total_employees_new:,} employees affected{', ' + text(run_ts) if run_ts else ''}</p>",
        "<table><tr><th>Company</th><th>Employees</th><th>Effective</th><th>County</th></tr>",
        *rows,
        "</table>",
    ]
    if entry.new_count > len(shown):
        out.append(f"<p>... and {entry.new_count - len(shown):,} more</p>")
    if entry.removed_count:
        out.append(f"<p>Removed since the last run: {entry.removed_count:,}</p>")
    out += [f"<p>All notices: {total_records:,} with {total_employees:,} employees</p>", "</body></html>"]
    return "\n".join(out)


def message(entry: Row, total_records: int, total_employees: int) -> tuple[str, str] | None:
    """(subject, text) of a message about a change-log entry; None if nothing is new."""
    if not entry.new_count:
        return None
    plural = "s" if entry.new_count > 1 else ""
    subject = f"{entry.new_count} new layoff notice{plural}, {entry.total_employees_new:,} employees"
    shown = list(entry.new_entries or [])[:MESSAGE_ENTRIES]
    lines = [f"New notices: {entry.new_count}", f"Employees affected: {entry.total_employees_new:,}", ""]
    lines += [f"- {r.company}: {_number(r.employees)} employees, {r.effective_date or '?'}, {r.county or '?'}" for r in shown]
    if entry.new_count > len(shown):
        lines.append(f"... and {entry.new_count - len(shown)} more")
    if entry.removed_count:
        lines.append(f"Removed since the last run: {entry.removed_count}")
    lines += ["", f"All notices: {total_records:,} with {total_employees:,} employees"]
    return subject, "\n".join(lines)
