"""SQL twins of the queries, for an engine that is not Spark."""

from __future__ import annotations

from .functions.sectors import BY_INDUSTRY, BY_NAME
from .functions.text import AIRPORTS
from .sources.star import RAW_SQL, TABLES


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _fixed(x: str) -> str:
    out = _strip(x)
    for pattern, new in (("(?i)&rsquo;", "''"), ("(?i)&amp;", "&"), ("(?i)&nbsp;", " "), (r"\s+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return f"CASE WHEN regexp_matches({x}, '(?i)ju+l+') THEN 'Juul Labs, Inc.' ELSE {out} END"


def _entities_only(x: str) -> str:
    out = _strip(x)
    for pattern, new in (("(?i)&rsquo;", "''"), ("(?i)&amp;", "&"), (r"\s+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return out


def _group(x: str) -> str:
    cut = rf"regexp_replace({_strip(x)}, '(?i)\s+({'|'.join(AIRPORTS)})\s*\d*.*$', '')"
    bare = _strip(rf"regexp_replace({cut}, '\s+\(\d+\)\s*$', '')")
    return f"CASE WHEN contains({bare}, 'Amazon') THEN 'Amazon' ELSE {bare} END"


def _sector(industry: str, company: str) -> str:
    def chain(x: str, lists: tuple, otherwise: str) -> str:
        whens = " ".join(f"WHEN {' OR '.join(f"contains(lower({x}), '{w}')" for w in words)} THEN '{name}'" for name, words in lists)
        return f"CASE {whens} ELSE {otherwise} END"

    field = _strip(f"coalesce({industry}, '')")
    known = chain(field, BY_INDUSTRY, f"substr({field}, 1, 40)")
    return f"CASE WHEN {field} <> '' AND {field} <> 'nan' THEN {known} ELSE {chain(company, BY_NAME, "'Other'")} END"


def _text(x: str) -> str:
    return _strip(f"coalesce({x}, 'nan')")


RAW = f"raw AS ({RAW_SQL.format(**{t: t for t in TABLES})})"
EMPLOYEES = "CAST(trunc(try_cast(trim(replace(employees, ',', '')) AS DOUBLE)) AS INTEGER)"
FIELD_NAMES = "company, notice_date, effective_date, employees, county, city, layoff_type, address, industry"
CLEAN = f"""{RAW}, clean AS (
    SELECT * FROM (
        SELECT ord, filing, {_fixed("coalesce(company, 'nan')")} AS company, notice_date, effective_date,
               CAST(trunc(try_cast(trim(replace(employees, ',', '')) AS DOUBLE)) AS INTEGER) AS employees,
               {_text("county")} AS county, {_text("city")} AS city, {_text("layoff_type")} AS layoff_type,
               {_text("address")} AS address, {_text("industry")} AS industry
        FROM raw) t
    WHERE lower(company) NOT IN ('company', 'nan', '') AND employees > 0)"""
PAYLOAD_ORDER = " || chr(1) || ".join(f"coalesce({k}, chr(65535))" for k in ("effective_date", "company", "county", "city", "layoff_type"))
MERGED = f"""{CLEAN}, notices AS (
    SELECT company, effective_date, county, city, layoff_type, CAST(sum(employees) AS BIGINT) AS employees,
           arg_min(notice_date, ord) FILTER (WHERE notice_date IS NOT NULL) AS notice_date,
           arg_min(address, ord) FILTER (WHERE address IS NOT NULL) AS address,
           arg_min(industry, ord) FILTER (WHERE industry IS NOT NULL) AS industry,
           {PAYLOAD_ORDER} AS ord
    FROM clean GROUP BY company, effective_date, county, city, layoff_type)"""
TYPED = f"""{MERGED}, typed AS (
    SELECT *, try_cast(effective_date AS DATE) AS effective_on, try_cast(notice_date AS DATE) AS notice_on, {_group("company")} AS company_clean
    FROM notices), dated AS (SELECT * FROM typed WHERE effective_on IS NOT NULL)"""
SUM = "CAST(sum(employees) AS BIGINT)"
INGESTED = TYPED.replace(
    "FROM raw) t",
    "FROM (SELECT * REPLACE (CASE WHEN filing % 100 = 20 THEN '1,000' ELSE employees END AS employees) FROM raw WHERE filing % 100 <> 7 AND (filing % 100 <> 3 OR filing % 200 = 3)) raw) t",
)
COUNTY_MONTH = f"""{TYPED}, each AS (
    SELECT county, strftime(effective_on, '%Y-%m') AS month, {SUM} AS employees FROM dated WHERE trim(county) <> '' GROUP BY 1, 2
), top AS (SELECT county FROM each GROUP BY county ORDER BY sum(employees) DESC, county LIMIT 20)"""
TREEMAP = f"""{TYPED}, each AS (
    SELECT coalesce(nullif(layoff_type, ''), 'Unknown') AS layoff_type, company, {SUM} AS employees FROM typed GROUP BY 1, 2
), top AS (SELECT company FROM each GROUP BY company ORDER BY sum(employees) DESC, company LIMIT 80
), leaves AS (SELECT layoff_type, company, employees FROM each WHERE company IN (SELECT company FROM top))"""
LEAD = f"""{TYPED}, lead AS (
    SELECT CAST(date_diff('day', notice_on, effective_on) AS INTEGER) AS days FROM typed
    WHERE notice_on IS NOT NULL AND date_diff('day', notice_on, effective_on) BETWEEN 0 AND 365)"""
FISCAL = """CAST(year(try_cast(effective_date AS DATE)) - CASE WHEN month(try_cast(effective_date AS DATE)) < 7 THEN 1 ELSE 0 END AS VARCHAR)"""
UNION = f"""{CLEAN}, records AS (
    SELECT company, CAST(employees AS BIGINT) AS employees, effective_date, county, NULL AS city, NULL AS industry, {FISCAL} AS fiscal_year, 'pdf' AS source
    FROM clean WHERE filing % 2 = 0
    UNION ALL
    SELECT company, CAST(employees AS BIGINT), effective_date, county, city, industry, 'current', 'xlsx' FROM clean WHERE filing % 2 = 1)"""
DIFF = f"{CLEAN}, latest AS (SELECT * FROM clean WHERE filing % 10 <> 1), snapshot AS (SELECT * FROM clean WHERE filing % 10 <> 0)"


def _anti(a: str, b: str) -> str:
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ("company", "effective_date", "employees"))
    return f"SELECT ord, company, effective_date, employees FROM {a} a WHERE NOT EXISTS (SELECT 1 FROM {b} b WHERE {same})"


def _folded(name: str) -> str:
    return f"""folded_{name} AS (
    SELECT lower({_strip("company")}) AS k1, coalesce(effective_date, 'None') AS k2, CAST(employees AS VARCHAR) AS k3, min(ord) AS first_ord,
           arg_max(company, ord) AS company, arg_max(effective_date, ord) AS effective_date, arg_max(employees, ord) AS employees
    FROM {name} GROUP BY 1, 2, 3)"""


FOLDED = f"{DIFF}, {_folded('latest')}, {_folded('snapshot')}"


def _fold_anti(a: str, b: str) -> str:
    return f"SELECT first_ord, company, employees FROM folded_{a} a WHERE NOT EXISTS (SELECT 1 FROM folded_{b} b WHERE a.k1 = b.k1 AND a.k2 = b.k2 AND a.k3 = b.k3)"


COUNTY_LABEL = _strip("replace(replace(coalesce(county, ''), ' County', ''), ' Parish', '')")
CELLS = f"""{MERGED}, cells AS (
    SELECT replace(replace(company, '<', '&lt;'), '>', '&gt;') AS company, {COUNTY_LABEL} AS county, format('{{:,}}', employees) AS employees,
           substr(coalesce(notice_date, ''), 1, 10) AS notice, substr(coalesce(effective_date, ''), 1, 10) AS effective,
           coalesce(layoff_type, '') AS type, coalesce(industry, '') AS industry, ord
    FROM notices)"""
CELL_NAMES = "company, county, employees, notice, effective, type, industry"

MONTH_RANGE = ("1995-01", "2001-12")
MONTH_SUMS = ", ".join(
    f"CAST(coalesce(sum(employees) FILTER (WHERE month = '{y}-{m:02d}'), 0) AS BIGINT) AS \"{y}-{m:02d}\"" for y in range(1995, 2002) for m in range(1, 13)
)

ORACLE_SQL: dict[str, str] = {
    "notices_clean": f"WITH {CLEAN} SELECT ord, company, notice_date, effective_date, employees, county, city, layoff_type, address, industry FROM clean",
    "sheet_named": f"WITH {CLEAN} SELECT ord, {FIELD_NAMES} FROM clean",
    "sheet_detailed": f"WITH {CLEAN} SELECT ord, {FIELD_NAMES} FROM clean",
    "sheet_positions": f"WITH {CLEAN} SELECT ord, {FIELD_NAMES.replace('city', "'' AS city")} FROM clean",
    "page_tables": f"""WITH {RAW} SELECT * FROM (
        SELECT ord, {_entities_only("coalesce(company, 'None')")} AS company, {EMPLOYEES} AS employees,
               CASE WHEN filing % 2 = 0 THEN notice_date END AS notice_date, effective_date, {_strip("coalesce(county, 'None')")} AS county,
               {_strip("coalesce(address, 'None')")} AS address, {_strip("coalesce(layoff_type, 'None')")} AS layoff_type,
               '2014' AS fiscal_year, 'pdf' AS source
        FROM raw) t WHERE trim(company) <> '' AND NOT contains(lower(company), 'company') AND employees >= 1""",
    "placed_words": f"""WITH {RAW} SELECT * FROM (
        SELECT {_entities_only("coalesce(company, 'None')")} AS company, {EMPLOYEES} AS employees,
               CASE WHEN filing % 2 = 0 THEN notice_date END AS notice_date, effective_date, coalesce(nullif({_strip("county")}, ''), 'None') AS county,
               {_strip("coalesce(address, 'None')")} AS address, coalesce(nullif({_strip("layoff_type")}, ''), 'None') AS layoff_type,
               '2014' AS fiscal_year, 'pdf' AS source
        FROM raw) t WHERE trim(company) <> '' AND NOT contains(lower(company), 'company') AND employees >= 1""",
    "incremental_ingest": f"""WITH {INGESTED} SELECT * FROM notices
        UNION ALL BY NAME SELECT 'month' AS company, strftime(effective_on, '%Y-%m') AS effective_date, {SUM} AS employees FROM dated GROUP BY 2""",
    "legacy_sheet": f"""WITH {RAW}, kept AS (SELECT * FROM raw WHERE ord NOT IN (SELECT ord FROM raw ORDER BY ord DESC LIMIT 2)), named AS (
            SELECT ord, effective_date, CASE WHEN contains(company, '&rsquo;')
                   THEN string_split(company, '&rsquo;')[1] || chr(39) || string_split(company, '&rsquo;')[-1] ELSE company END AS company, {EMPLOYEES} AS employees
            FROM kept)
        SELECT effective_date, company, {SUM} AS employees, min(ord) AS ord FROM named WHERE employees > 0 GROUP BY 1, 2""",
    "legacy_sheet_newer": f"""WITH {RAW}, kept AS (
            SELECT ord, effective_date, employees, CASE WHEN filing % 41 = 0 THEN 'Company'
                   WHEN filing % 37 = 0 THEN CASE filing % 3 WHEN 0 THEN 'JUUL' WHEN 1 THEN 'Juul' ELSE 'JUUl' END || ' ' || company ELSE company END AS company
            FROM raw WHERE ord NOT IN (SELECT ord FROM raw ORDER BY ord DESC LIMIT 2)), named AS (
            SELECT ord, effective_date, {EMPLOYEES} AS employees, CASE WHEN contains(company, '&rsquo;')
                   THEN string_split(company, '&rsquo;')[1] || chr(39) || string_split(company, '&rsquo;')[-1]
                   WHEN contains(company, 'JUUL') OR contains(company, 'Juul') OR contains(company, 'JUUl') THEN 'Juul Labs, Inc.' ELSE company END AS company
            FROM kept WHERE NOT contains(company, 'Company'))
        SELECT effective_date, company, {SUM} AS employees, min(ord) AS ord FROM named WHERE employees > 0 GROUP BY 1, 2""",
    "legacy_sheets": f"""WITH {RAW}, kept AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY filing % 3 ORDER BY ord DESC) > 2), named AS (
            SELECT ord, effective_date, CASE WHEN contains(company, '&rsquo;')
                   THEN string_split(company, '&rsquo;')[1] || chr(39) || string_split(company, '&rsquo;')[-1] ELSE company END AS company, {EMPLOYEES} AS employees
            FROM kept)
        SELECT effective_date, company, {SUM} AS employees, min(ord) AS ord FROM named WHERE employees > 0 GROUP BY 1, 2""",
    "date_spellings": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders",
    "change_entry": f"""WITH {DIFF}, added AS ({_anti("latest", "snapshot")}), removed AS ({_anti("snapshot", "latest")})
        SELECT 'run' AS timestamp, CAST((SELECT count(*) FROM added) AS INTEGER) AS new_count, CAST((SELECT count(*) FROM removed) AS INTEGER) AS removed_count,
               coalesce((SELECT {SUM} FROM added), 0) AS total_employees_new, coalesce((SELECT {SUM} FROM removed), 0) AS total_employees_removed,
               CAST((SELECT count(*) FROM (SELECT 1 FROM added LIMIT 50)) AS INTEGER) AS new_listed, CAST((SELECT count(*) FROM (SELECT 1 FROM removed LIMIT 50)) AS INTEGER) AS removed_listed,
               (SELECT string_agg(company, '|' ORDER BY ord) FROM (SELECT * FROM added ORDER BY ord LIMIT 50)) AS new_companies""",
    "change_entry_no_snapshot": f"""WITH {DIFF} SELECT 'run' AS timestamp, CAST(count(*) AS INTEGER) AS new_count, 0 AS removed_count,
        coalesce({SUM}, 0) AS total_employees_new, CAST(NULL AS BIGINT) AS total_employees_removed FROM latest""",
    "merge_duplicates": f"WITH {MERGED} SELECT * FROM notices",
    "legacy_merge": f"WITH {CLEAN} SELECT effective_date, company, {SUM} AS employees, min(ord) AS ord FROM clean GROUP BY 1, 2",
    "payload_totals": f"""WITH {MERGED} SELECT count(*) AS total_records, {SUM} AS total_employees,
        min(effective_date) AS date_range_start, max(effective_date) AS date_range_end FROM notices""",
    "company_groups": f"WITH {TYPED} SELECT DISTINCT company, company_clean FROM typed",
    "county_forms": f"""WITH {MERGED} SELECT DISTINCT county, {_strip(r"regexp_replace(county, '\s*(County|Parish)\s*$', '')")} AS short,
        {COUNTY_LABEL} AS label FROM notices""",
    "timeline": f"""WITH {TYPED} SELECT company, effective_on, CAST(employees AS BIGINT) AS employees, county AS colour,
        '<b>' || company || '</b><br>' || strftime(effective_on, '%b %d, %Y') || '<br>' || format('{{:,}}', employees) || ' employees' AS hover FROM dated""",
    "monthly_ma3": f"""WITH {TYPED}, m AS (SELECT strftime(effective_on, '%Y-%m') AS month, {SUM} AS employees FROM dated GROUP BY 1)
        SELECT month, employees, round(avg(employees) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3 FROM m""",
    "daily_rolling30": f"""WITH {TYPED}, d AS (SELECT effective_on AS day, {SUM} AS employees FROM dated GROUP BY 1), spine AS (
            SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d
        ), f AS (SELECT s.day, coalesce(d.employees, 0) AS employees FROM spine s LEFT JOIN d ON s.day = d.day)
        SELECT day, employees, round(avg(employees) OVER (ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS rolling30,
               CAST(sum(employees) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative FROM f""",
    "top_companies": f"WITH {TYPED} SELECT company_clean AS company, {SUM} AS employees FROM typed GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    "county_month_long": f"WITH {COUNTY_MONTH} SELECT county, month, employees FROM each WHERE county IN (SELECT county FROM top)",
    "county_month_pivot": f"""WITH {COUNTY_MONTH} SELECT county, {MONTH_SUMS} FROM each WHERE county IN (SELECT county FROM top) GROUP BY county""",
    "treemap_leaves": f"WITH {TREEMAP} SELECT * FROM leaves",
    "treemap_parents": f"""WITH {TREEMAP} SELECT layoff_type, {SUM} AS employees,
        round(CAST(sum(employees * employees) AS DOUBLE) / CAST(sum(employees) AS DOUBLE), 6) AS colour FROM leaves GROUP BY 1""",
    "sector_breakdown": f"""WITH {TYPED}, s AS (SELECT {_sector("industry", "company_clean")} AS sector, {SUM} AS employees FROM typed GROUP BY 1)
        SELECT sector, employees, round(100 * employees / CAST(sum(employees) OVER () AS DOUBLE), 6) AS share FROM s""",
    "lead_time_stats": f"""WITH {LEAD} SELECT count(*) AS notices, CAST(floor(quantile_cont(days, 0.5)) AS BIGINT) AS median_days,
        round(avg(days), 6) AS mean_days, round(100 * avg(CASE WHEN days >= 60 THEN 1 ELSE 0 END), 6) AS at_least_60 FROM lead""",
    "lead_time_hist": f"WITH {LEAD} SELECT CAST(days // 10 * 10 AS INTEGER) AS days_from, count(*) AS notices FROM lead GROUP BY 1",
    "county_top10": f"""WITH {TYPED} SELECT {_strip(r"regexp_replace(county, '\s*(County|Parish)\s*$', '')")} AS county, {SUM} AS employees,
        count(company) AS notices FROM typed WHERE trim(county) <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
    "union_sources": f"WITH {UNION} SELECT * FROM records",
    "union_totals": f"WITH {UNION} SELECT count(*) AS total_records, {SUM} AS total_employees FROM records",
    "fiscal_year_summary": f"""WITH {UNION}, years AS (SELECT unnest(generate_series(1993, 2003)) AS y), past AS (
            SELECT fiscal_year, count(*) AS records, {SUM} AS employees FROM records WHERE fiscal_year <> 'current' GROUP BY 1)
        SELECT CAST(y AS VARCHAR) AS fiscal_year, 'FY ' || y || '-' || right(CAST(y + 1 AS VARCHAR), 2) AS label,
               coalesce(records, 0) AS records, coalesce(employees, 0) AS employees, 'pdf' AS source
        FROM years LEFT JOIN past ON CAST(y AS VARCHAR) = fiscal_year
        UNION ALL SELECT 'current', 'FY 2025-26 (Live)', count(*), {SUM}, 'xlsx' FROM records WHERE fiscal_year = 'current' HAVING count(*) > 0""",
    "multiyear_month": f"""WITH {UNION}, d AS (SELECT try_cast(effective_date AS DATE) AS day, employees FROM records), e AS (
            SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, {SUM} AS employees FROM d WHERE day IS NOT NULL GROUP BY 1, 2)
        SELECT *, year = max(year) OVER () AS is_current FROM e""",
    "year_over_year": f"""WITH {UNION}, years AS (SELECT unnest(generate_series(1993, 2003)) AS y), past AS (
            SELECT fiscal_year, {SUM} AS employees FROM records WHERE fiscal_year <> 'current' GROUP BY 1)
        SELECT CAST(y AS VARCHAR) AS fiscal_year, 'FY ' || y || '-' || right(CAST(y + 1 AS VARCHAR), 2) AS label, 'pdf' AS source,
               coalesce(employees, 0) AS employees, CAST(NULL AS BIGINT) AS notices
        FROM years LEFT JOIN past ON CAST(y AS VARCHAR) = fiscal_year
        UNION ALL SELECT 'current', 'FY 2025-26 (Live)', 'xlsx', {SUM}, count(*) FROM records WHERE fiscal_year = 'current' HAVING count(*) > 0""",
    "month_lines": f"""WITH {UNION}, d AS (SELECT try_cast(effective_date AS DATE) AS day, employees FROM records), e AS (
            SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, strftime(min(day), '%b') AS label, {SUM} AS employees
            FROM d WHERE day IS NOT NULL GROUP BY 1, 2)
        SELECT CAST(year AS VARCHAR) AS line, month, label, employees, year = max(year) OVER () AS is_current FROM e""",
    "kpi_avg_lead": f"""WITH {MERGED}, l AS (SELECT date_diff('day', try_cast(substr(notice_date, 1, 10) AS DATE), try_cast(substr(effective_date, 1, 10) AS DATE)) AS d FROM notices)
        SELECT coalesce(CAST(CAST(round_even(avg(d), 0) AS BIGINT) AS VARCHAR) || 'd', 'N/A') AS avg_lead_days FROM l WHERE d > 0 AND d < 730""",
    "kpi_largest": f"WITH {MERGED} SELECT company, format('{{:,}}', employees) AS employees FROM notices ORDER BY notices.employees DESC, ord LIMIT 1",
    "kpi_top_county": f"""WITH {MERGED}, c AS (SELECT {_strip("coalesce(county, '')")} AS county, {SUM} AS total, min(ord) AS ord FROM notices GROUP BY 1)
        SELECT county, format('{{:,}}', total) AS employees FROM c WHERE county <> '' ORDER BY total DESC, ord LIMIT 1""",
    "recent_notices": f"WITH {CELLS} SELECT {CELL_NAMES} FROM cells",
    "notice_search_page": f"""WITH {CELLS} SELECT {CELL_NAMES} FROM cells WHERE contains(lower(company), 'labs') AND type = 'Layoff Permanent'
        AND (notice = '' OR notice >= '1996-01-01') AND (notice = '' OR notice <= '1999-12-31') ORDER BY notice DESC, ord LIMIT 50 OFFSET 50""",
    "any_text_search": f"""WITH {CELLS} SELECT {CELL_NAMES} FROM cells WHERE contains(lower(concat_ws(' ', {CELL_NAMES})), 'nation_1')""",
    "js_sort_page": rf"""WITH {CELLS} SELECT {CELL_NAMES} FROM cells
        ORDER BY try_cast(regexp_extract(notice, '^\s*([-+]?\d+\.?\d*)', 1) AS DOUBLE) ASC NULLS LAST, lower(notice), ord LIMIT 100 OFFSET 200""",
    "notice_last_page": f"""WITH {CELLS}, placed AS (SELECT *, row_number() OVER (ORDER BY notice DESC, ord) - 1 AS place, count(*) OVER () AS n FROM cells)
        SELECT {CELL_NAMES} FROM placed WHERE place // 100 = (n - 1) // 100""",
    "js_sort_far_page": rf"""WITH {CELLS}, placed AS (
            SELECT *, row_number() OVER (ORDER BY try_cast(regexp_extract(company, '^\s*([-+]?\d+\.?\d*)', 1) AS DOUBLE) DESC NULLS LAST, lower(company) DESC, ord) - 1 AS place,
                   count(*) OVER () AS n FROM cells)
        SELECT {CELL_NAMES} FROM placed WHERE place // 100 = least(399, (n - 1) // 100)""",
    "indexed_search": f"""WITH {CELLS}, whole AS (SELECT *, lower(concat_ws(' ', {CELL_NAMES})) AS any_text FROM cells)
        SELECT w.wanted, {CELL_NAMES} FROM whole, (VALUES ('any', 'NATION_1'), ('company', 'labs'), ('company', 'x '), ('any', '77'), ('company', '000001 & Labs'), ('any', 'nowhere at all')) w(field, wanted)
        WHERE contains(CASE WHEN w.field = 'any' THEN any_text ELSE lower(company) END, lower(w.wanted))""",
    "filter_options": f"""WITH {MERGED} SELECT DISTINCT 'county' AS kind, {COUNTY_LABEL} AS value FROM notices WHERE {COUNTY_LABEL} <> ''
        UNION ALL SELECT DISTINCT 'industry', {_strip("coalesce(industry, '')")} FROM notices WHERE {_strip("coalesce(industry, '')")} <> ''
        UNION ALL SELECT DISTINCT 'type', layoff_type FROM notices WHERE layoff_type <> ''""",
    "diff_strict_added": f"WITH {DIFF} {_anti('latest', 'snapshot')}",
    "diff_strict_removed": f"WITH {DIFF} {_anti('snapshot', 'latest')}",
    "diff_no_snapshot": f"WITH {DIFF} SELECT ord, company, effective_date, employees FROM latest",
    "diff_casefold_added": f"WITH {FOLDED} {_fold_anti('latest', 'snapshot')}",
    "diff_casefold_removed": f"WITH {FOLDED} {_fold_anti('snapshot', 'latest')}",
    "diff_largest_added": f"WITH {FOLDED} {_fold_anti('latest', 'snapshot')} ORDER BY employees DESC, first_ord LIMIT 20",
    "diff_totals": f"""WITH {FOLDED}, added AS ({_fold_anti("latest", "snapshot")}), removed AS ({_fold_anti("snapshot", "latest")})
        SELECT *, latest_employees - snapshot_employees AS employees_delta FROM
        (SELECT count(*) AS latest_count, {SUM} AS latest_employees FROM latest), (SELECT count(*) AS snapshot_count, {SUM} AS snapshot_employees FROM snapshot),
        (SELECT count(*) AS added_count, {SUM} AS added_employees FROM added), (SELECT count(*) AS removed_count, {SUM} AS removed_employees FROM removed)""",
    "stream_changes": f"""WITH {CLEAN}, counts AS (
            SELECT company, effective_date, employees, 0 AS a0, count(*) FILTER (WHERE filing % 10 <> 0) AS a1,
                   count(*) FILTER (WHERE filing % 10 <> 1) AS a2, count(*) FILTER (WHERE filing % 10 <> 2) AS a3
            FROM clean GROUP BY 1, 2, 3), steps AS (
            SELECT 1 AS taken, a0 AS b, a1 AS a, * FROM counts UNION ALL SELECT 2, a1, a2, * FROM counts UNION ALL SELECT 3, a2, a3, * FROM counts)
        SELECT CAST(taken AS BIGINT) AS taken, company, effective_date, employees, CASE WHEN a > b THEN 'added' ELSE 'removed' END AS change, CAST(abs(a - b) AS BIGINT) AS rows
        FROM steps WHERE a <> b""",
    "run_history": f"""WITH {CLEAN}, counts AS (
            SELECT company, effective_date, employees, 0 AS a0, count(*) FILTER (WHERE filing % 10 <> 0) AS a1,
                   count(*) FILTER (WHERE filing % 10 <> 1) AS a2, count(*) FILTER (WHERE filing % 10 <> 2) AS a3
            FROM clean GROUP BY 1, 2, 3), steps AS (
            SELECT 1 AS taken, a0 AS b, a1 AS a, employees FROM counts UNION ALL SELECT 2, a1, a2, employees FROM counts UNION ALL SELECT 3, a2, a3, employees FROM counts)
        SELECT 'run ' || taken AS run_id, CAST(sum(CASE WHEN b = 0 THEN a ELSE 0 END) AS INTEGER) AS new_count, CAST(sum(CASE WHEN a = 0 THEN b ELSE 0 END) AS INTEGER) AS removed_count,
               CAST(sum(CASE WHEN b = 0 THEN a * employees ELSE 0 END) AS BIGINT) AS total_employees_new,
               CASE WHEN taken > 1 THEN CAST(sum(CASE WHEN a = 0 THEN b * employees ELSE 0 END) AS BIGINT) END AS total_employees_removed,
               CAST(sum(a) AS INTEGER) AS total_records, CAST(sum(a * employees) AS BIGINT) AS total_employees
        FROM steps GROUP BY taken""",
    "changelog_lines": """WITH t AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS ord FROM events)
        SELECT ord, 'run ' || event_id AS timestamp, CAST(event_id % 5 AS INTEGER) AS new_count FROM t WHERE event_id % 4 <> 0""",
    "changelog_file_tail": """WITH t AS (SELECT event_id, -row_number() OVER (ORDER BY event_id DESC) AS ord FROM events ORDER BY event_id DESC LIMIT 10)
        SELECT ord, 'run ' || event_id AS timestamp, CAST(event_id % 5 AS INTEGER) AS new_count, CAST(event_id % 7 AS BIGINT) AS total_employees_new FROM t WHERE event_id % 4 <> 0""",
    "stream_closed_days": """SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS events, round(sum(CAST(value AS DECIMAL(18, 2))), 2) AS value
        FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY 1, 2""",
    "changelog_tail": """WITH t AS (SELECT event_id AS ord, event_type FROM events ORDER BY event_id DESC LIMIT 10)
        SELECT ord, 'run ' || ord AS timestamp, CAST(ord % 5 AS INTEGER) AS new_count, CAST(ord % 7 AS BIGINT) AS total_employees_new FROM t WHERE ord % 4 <> 0""",
    "stream_event_days": """SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS events, round(sum(CAST(value AS DECIMAL(18, 2))), 2) AS value
        FROM events GROUP BY 1, 2""",
}

for _name in ("casefold_added", "casefold_removed", "totals"):
    ORACLE_SQL[f"digest_{_name}"] = ORACLE_SQL[f"diff_{_name}"]
