"""Checks: what each query must return, as SQL for DuckDB over the same test tables.

Written apart from the Spark code and as plainly as possible: row-level joins where the
reports work on summaries, subqueries where they join.  Names in the test tables hold no
LIKE metacharacters, so a case-insensitive match is written ``lower(a) = lower(b)``.
"""

from __future__ import annotations

from fieldcast.bindings import duckdb_with
from fieldcast.queries import AS_OF, MAX_BYTES, MAX_FILES
from fieldcast.sinks.reports import GLOBAL_REPORTS, PROJECT_REPORTS


def ratio(num: str, den: str, digits: int) -> str:
    """Half-up rounding of a quotient of whole numbers."""
    whole = f"(abs({num}) * {2 * 10**digits} + ({den})) // (2 * ({den}))"
    return f"CAST(sign({num}) * ({whole}) AS DOUBLE) / {float(10**digits)}"


def texts(col: str) -> str:
    return f"string_agg(DISTINCT CAST({col} AS VARCHAR), ';' ORDER BY CAST({col} AS VARCHAR))"


#: whether the next message closes a bundle that is limited in bytes and files
_FULL = f"b.open + s.length_bytes > {MAX_BYTES} OR b.held + 1 > {MAX_FILES}"


# -- shared pieces: name -> (tables and pieces it reads, SQL) ---------------------------------

PIECES: dict[str, tuple[tuple[str, ...], str]] = {
    "x_tbs": (
        ("tbsdeployed", "recipients"),
        """SELECT DISTINCT b.project, b.deployment, b.contentpackage AS package, b.recipientid, p.communityname,
                  p.groupname, p.language AS languagecode, b.talkingbookid
           FROM tbsdeployed b, recipients p WHERE p.recipientid = b.recipientid""",
    ),
    "x_depl": (
        ("x_tbs", "deployments"),
        """SELECT DISTINCT x.project, x.deployment, s.deploymentnumber, x.package, x.languagecode, s.startdate,
                  s.enddate, x.recipientid, x.communityname, x.groupname, x.talkingbookid
           FROM x_tbs x LEFT JOIN deployments s ON s.project = x.project AND lower(s.deployment) = lower(x.deployment)""",
    ),
    "x_depl_by": (
        ("x_depl",),
        f"""SELECT project, {texts('deployment')} AS deployment, deploymentnumber, startdate, enddate,
                  count(DISTINCT package) AS num_packages, count(DISTINCT languagecode) AS num_languages,
                  count(DISTINCT communityname) AS num_communities, count(DISTINCT recipientid) AS num_recipients,
                  count(DISTINCT talkingbookid) AS deployed_tbs
           FROM x_depl GROUP BY ALL""",
    ),
    "x_tbd": (
        ("tbsdeployed", "recipients", "deployments"),
        """SELECT p.partner, p.affiliate, p.communityname, p.groupname, p.country, p.region, p.district, b.*,
                  s.deploymentnumber
           FROM tbsdeployed b JOIN recipients p ON p.recipientid = b.recipientid
           JOIN deployments s ON s.project = b.project AND s.deployment = b.deployment""",
    ),
    "x_newsn": (
        ("tbsdeployed",),
        """SELECT DISTINCT project, deployedtimestamp AS timestamp, CAST(year(deployedtimestamp) AS INT) AS year,
                  CAST(quarter(deployedtimestamp) AS INT) AS quarter, CAST(month(deployedtimestamp) AS INT) AS month,
                  strftime(deployedtimestamp, '%b') AS month_name, talkingbookid, username, tbcdid
           FROM tbsdeployed WHERE newsn""",
    ),
    "x_newsn_months": (
        ("x_newsn",),
        """SELECT project, year, quarter, month, month_name, min(timestamp) AS earliest,
                  count(DISTINCT timestamp) AS count FROM x_newsn GROUP BY ALL""",
    ),
    "x_prod": (
        ("deployments", "packagesindeployment", "languages", "contentinpackage", "categories", "contentmetadata2"),
        """SELECT k.project, d.deployment, d.deploymentnumber, p.startdate, p.contentpackage AS package,
                  p.languagecode, g.language, k.categoryid, c.categoryname, k.contentid, m.format, m.duration_sec, m.title
           FROM contentinpackage k
           JOIN packagesindeployment p ON p.project = k.project AND lower(p.contentpackage) = lower(k.contentpackage)
           JOIN deployments d ON d.project = k.project AND lower(d.deployment) = lower(p.deployment)
           JOIN languages g ON g.projectcode = k.project AND lower(g.languagecode) = lower(p.languagecode)
           JOIN categories c ON c.projectcode = k.project AND lower(c.categoryid) = lower(k.categoryid)
           JOIN contentmetadata2 m ON m.project = k.project AND lower(m.contentid) = lower(k.contentid)""",
    ),
    "x_cats": (
        ("contentinpackage", "categories", "contentmetadata2"),
        """SELECT DISTINCT k.project, k.contentpackage, k.contentid, k.categoryid, k.position,
                  CASE WHEN starts_with(c.categoryname, 'General') THEN substring(c.categoryname, 9)
                       ELSE coalesce(c.categoryname, m.title) END AS category, m.sdg_goals, m.sdg_targets
           FROM contentinpackage k
           LEFT JOIN categories c ON c.categoryid = k.categoryid AND c.projectcode = k.project
           LEFT JOIN contentmetadata2 m ON m.contentid = k.categoryid AND m.project = k.project""",
    ),
    "x_base": (
        ("playstatistics", "contentmetadata2", "x_cats"),
        """SELECT DISTINCT s.timestamp, s.project, s.contentpackage, m.languagecode, s.recipientid, k.category,
                  k.category AS playlist, k.sdg_goals, k.sdg_targets, s.contentid, m.title, m.format,
                  m.duration_sec AS duration_seconds, k.position, s.talkingbookid, s.played_seconds,
                  s.completed AS completions, s.threequarters, s.half, s.quarter, s.started, s.tbcdid,
                  s.deployment_timestamp, s.deployment_uuid
           FROM playstatistics s
           JOIN contentmetadata2 m ON m.contentid = s.contentid AND m.project = s.project
           JOIN x_cats k ON lower(k.contentpackage) = lower(s.contentpackage) AND k.contentid = s.contentid""",
    ),
    "x_usage": (
        ("x_base", "packagesindeployment", "deployments", "languages", "recipients"),
        """SELECT DISTINCT b.timestamp, b.project, d.deploymentnumber, d.deployment, d.deploymentname, d.startdate,
                  b.contentpackage, b.languagecode, g.language, b.recipientid, r.partner, r.affiliate, r.country,
                  r.region, r.district, r.communityname, r.groupname, r.agent, r.supportentity, b.talkingbookid,
                  b.category, b.playlist, b.sdg_goals, b.sdg_targets, b.contentid, b.title, b.format,
                  b.duration_seconds, b.position, b.played_seconds, b.completions, b.threequarters, b.half,
                  b.quarter, b.started, b.tbcdid, b.deployment_timestamp, b.deployment_uuid
           FROM x_base b
           JOIN packagesindeployment p ON p.project = b.project AND lower(p.contentpackage) = lower(b.contentpackage)
           JOIN deployments d ON d.project = b.project AND d.deployment = p.deployment
           JOIN languages g ON g.projectcode = b.project AND g.languagecode = b.languagecode
           LEFT JOIN recipients r ON r.recipientid = b.recipientid""",
    ),
    "x_used": (
        ("playstatistics",),
        """SELECT project, contentpackage, count(DISTINCT talkingbookid) AS package_tbs_used
           FROM playstatistics GROUP BY ALL""",
    ),
    "x_usage_by": (
        ("x_usage",),
        f"""SELECT project, {texts('deployment')} AS deployment, deploymentnumber, startdate,
                  count(DISTINCT contentpackage) AS num_packages, count(DISTINCT languagecode) AS num_languages,
                  count(DISTINCT communityname) AS num_communities, count(DISTINCT recipientid) AS num_recipients,
                  count(DISTINCT category) AS num_categories, count(DISTINCT contentid) AS num_messages,
                  count(DISTINCT talkingbookid) AS num_tbs,
                  {ratio('sum(played_seconds)', '60', 2)} AS played_minutes, CAST(sum(completions) AS BIGINT) AS num_completions
           FROM x_usage GROUP BY project, deploymentnumber, startdate""",
    ),
    "x_plays": (
        ("playedevents",),
        "SELECT * FROM playedevents WHERE NOT (timeplayed < 10 OR totaltime <= 0 OR contentid = 'dga')",
    ),
    "x_logs": (
        ("x_plays",),
        """SELECT packageid, village, talkingbookid, contentid, totaltime, CAST(sum(timeplayed) AS BIGINT) AS timeplayed,
                  count(*) FILTER (percentdone < 0.25 AND open) AS started,
                  count(*) FILTER (percentdone >= 0.25 AND percentdone <= 0.49999 AND open) AS quarter,
                  count(*) FILTER (percentdone >= 0.499991 AND percentdone <= 0.74999 AND open) AS half,
                  count(*) FILTER (percentdone >= 0.749991 AND percentdone <= 0.94999 AND open) AS threequarters,
                  count(*) FILTER (percentdone > 0.94999 OR totaltime - timeplayed < 10 OR isfinished) AS completed
           FROM (SELECT *, totaltime - timeplayed > 10 AND NOT isfinished AS open FROM x_plays) GROUP BY ALL""",
    ),
    "x_keys": (
        ("syncaggregation", "playedevents"),
        """SELECT contentpackage, village, talkingbook, contentid FROM syncaggregation
           UNION SELECT packageid, village, talkingbookid, contentid FROM playedevents""",
    ),
    "x_all": (
        ("x_keys", "communities", "contentmetadata2", "x_logs", "syncaggregation"),
        """SELECT c.project, k.contentpackage, k.village, k.talkingbook, k.contentid,
                  l.timeplayed AS played_seconds_logevents, a.totaltimeplayed AS played_seconds_logs,
                  CAST(b.countcompleted * 123 * m.duration_sec AS BIGINT) AS stats_hundredths,
                  f.totaltimeplayed AS played_seconds_flash,
                  greatest(l.timeplayed * 100, a.totaltimeplayed::BIGINT * 100, b.countcompleted::BIGINT * 123 * m.duration_sec, f.totaltimeplayed::BIGINT * 100) AS max_hundredths,
                  greatest(
                    (coalesce(30 * greatest(l.quarter, a.countquarter, f.countquarter), 0)
                     + coalesce(60 * greatest(l.half, a.counthalf, f.counthalf), 0)
                     + coalesce(83 * greatest(l.threequarters, a.countthreequarters, f.countthreequarters), 0)
                     + coalesce(100 * greatest(l.completed, a.countcompleted, b.countcompleted, f.countcompleted), 0) + 50) // 100,
                    (b.countcompleted::BIGINT * 123 + 50) // 100) AS effectivecompletions_max,
                  30 * f.countquarter + 60 * f.counthalf + 83 * f.countthreequarters + 100 * f.countcompleted AS flash_hundredths,
                  l.started AS started_logevents, a.countstarted AS started_logs, b.countstarted AS started_stats,
                  f.countstarted AS started_flash,
                  least(l.started, a.countstarted, b.countstarted, f.countstarted) AS started_min,
                  greatest(l.started, a.countstarted, b.countstarted, f.countstarted) AS started_max,
                  l.quarter AS quarter_logevents, a.countquarter AS quarter_logs, f.countquarter AS quarter_flash,
                  greatest(l.quarter, a.countquarter, f.countquarter) AS quarter_max,
                  l.half AS half_logevents, a.counthalf AS half_logs, f.counthalf AS half_flash,
                  greatest(l.half, a.counthalf, f.counthalf) AS half_max,
                  l.threequarters AS threequarters_logevents, a.countthreequarters AS threequarters_logs,
                  f.countthreequarters AS threequarters_flash,
                  greatest(l.threequarters, a.countthreequarters, f.countthreequarters) AS threequarters_max,
                  l.completed AS completed_logevents, a.countcompleted AS completed_logs, b.countcompleted AS completed_stats,
                  f.countcompleted AS completed_flash,
                  least(l.completed, a.countcompleted, b.countcompleted, f.countcompleted) AS completed_min,
                  greatest(l.completed, a.countcompleted, b.countcompleted, f.countcompleted) AS completed_max,
                  greatest(l.completed, a.countcompleted, b.countcompleted, f.countcompleted)
                    - least(a.countcompleted, b.countcompleted, f.countcompleted) AS completed_variance
           FROM x_keys k
           JOIN communities c ON c.communityname = k.village
           JOIN (SELECT contentid AS m_content, project AS m_project, duration_sec FROM contentmetadata2) m ON m_content = k.contentid AND m_project = c.project
           LEFT JOIN (SELECT packageid AS contentpackage, talkingbookid AS talkingbook, * FROM x_logs) l USING (contentpackage, village, talkingbook, contentid)
           LEFT JOIN (FROM syncaggregation WHERE datasource = 1) a USING (contentpackage, village, talkingbook, contentid)
           LEFT JOIN (FROM syncaggregation WHERE datasource = 2) b USING (contentpackage, village, talkingbook, contentid)
           LEFT JOIN (FROM syncaggregation WHERE datasource = 3) f USING (contentpackage, village, talkingbook, contentid)""",
    ),
    "x_alls": (
        ("x_all",),
        """SELECT * EXCLUDE (stats_hundredths, max_hundredths, flash_hundredths, started_stats),
                  (stats_hundredths + 50) // 100 AS played_seconds_stats, (max_hundredths + 50) // 100 AS played_seconds_max,
                  (flash_hundredths + 50) // 100 AS effecticecompletions_flash, started_stats AS starts_stats,
                  started_max - started_min AS started_variance
           FROM x_all""",
    ),
    "x_pid": (
        ("packagesindeployment",),
        """SELECT upper(project) AS project, upper(deployment) AS deployment, upper(contentpackage) AS contentpackage,
                  packagename, startdate, enddate, languagecode FROM packagesindeployment""",
    ),
    "x_content": (
        ("contentinpackage", "contentmetadata2", "categories"),
        """SELECT k.project, k.contentpackage, k.contentid, k.position AS "order", m.title, m.format,
                  m.duration_sec // 60 AS length_minutes, m.languagecode, m.source, m.keywords,
                  m.categories AS acm_categories, m.transcriptionurl, m.notes,
                  CASE WHEN starts_with(c.categoryname, 'General') THEN substring(c.categoryname, 9) ELSE c.categoryname END AS category
           FROM contentinpackage k JOIN contentmetadata2 m ON m.contentid = k.contentid AND m.project = k.project
           JOIN categories c ON c.categoryid = k.categoryid AND c.projectcode = k.project""",
    ),
    "x_msg": (
        ("x_alls",),
        """SELECT project, contentpackage, contentid, CAST(sum(played_seconds_max) AS BIGINT) AS timeplayed,
                  CAST(sum(effectivecompletions_max) AS BIGINT) AS effective, CAST(sum(completed_max) AS BIGINT) AS completed,
                  count(DISTINCT talkingbook) AS tbs,
                  (SELECT count(DISTINCT talkingbook) FROM x_alls o WHERE o.project = a.project AND o.contentpackage = a.contentpackage) AS pkgtbs
           FROM x_alls a GROUP BY project, contentpackage, contentid""",
    ),
    "x_map": (
        ("recipients_map",),
        "SELECT upper(project) AS mp, upper(directory) AS md, recipientid AS mr FROM recipients_map",
    ),
    "x_kv": (
        ("events",),
        """SELECT concat('f', event_id % 3, '.kvp') AS file, event_id AS line_no, concat('t', event_id) AS timestamp,
                  concat('op', event_id % 2) AS operation,
                  CASE WHEN event_id % 7 = 0 THEN 'again' ELSE CAST(user_id AS VARCHAR) END AS user, event_type AS type,
                  CASE WHEN event_id % 3 = 0 THEN concat('1:', event_id % 9) END AS ratio,
                  CASE WHEN event_id % 5 = 0 THEN 'True' END AS optional, concat('proj', user_id % 4) AS project,
                  concat('dir ', user_id % 6) AS community, CASE WHEN event_id % 11 = 0 THEN '' END AS recipientid
           FROM events WHERE event_id % 41 <> 0 AND event_id % 37 <> 0""",
    ),
    "x_uf": (
        ("documents",),
        """SELECT md5(CAST(doc_id AS VARCHAR)) AS message_uuid, concat('PROG', doc_id % 2) AS programid,
                  CAST(doc_id % 3 AS VARCHAR) AS deploymentnumber, concat('r', doc_id % 150) AS recipientid,
                  concat('TB', doc_id % 40) AS talkingbookid, '' AS deployment_tbcdid,
                  CASE WHEN doc_id % 4 = 0 THEN '180101' ELSE concat('2021', lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0'), '05') END AS deployment_timestamp,
                  '' AS deployment_user, 'f' AS test_deployment, '' AS collection_tbcdid, '180103' AS collection_timestamp,
                  CASE WHEN doc_id % 6 = 0 THEN concat('u', doc_id % 5, '@x.org') ELSE concat('name=', doc_id % 5) END AS collection_user,
                  CAST(n_chars % 400 AS VARCHAR) AS length_seconds, CAST(n_chars AS VARCHAR) AS length_bytes, lang AS language,
                  CASE WHEN doc_id % 5 = 0 THEN '180102' ELSE concat('2021', lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0'), '09') END AS date_recorded,
                  '' AS relation, CAST(NULL AS VARCHAR) AS bundle_uuid
           FROM documents WHERE doc_id % 17 <> 0""",
    ),
    "x_kept": (
        ("uf_messages",),
        "SELECT * FROM uf_messages WHERE bundle_uuid IS NULL AND length_seconds >= 5 AND length_seconds <= 300",
    ),
    "x_seq": (
        ("x_kept",),
        """SELECT programid, deploymentnumber, language, message_uuid, length_bytes,
                  row_number() OVER (PARTITION BY programid, deploymentnumber, language ORDER BY message_uuid) AS n FROM x_kept""",
    ),
    "x_bundles": (
        ("x_seq",),
        f"""SELECT programid, deploymentnumber, language, message_uuid, n, length_bytes AS open, CAST(0 AS BIGINT) AS bundle_index
           FROM x_seq WHERE n = 1
           UNION ALL
           SELECT s.programid, s.deploymentnumber, s.language, s.message_uuid, s.n,
                  CASE WHEN b.open + s.length_bytes > {MAX_BYTES} THEN s.length_bytes ELSE b.open + s.length_bytes END,
                  b.bundle_index + CASE WHEN b.open + s.length_bytes > {MAX_BYTES} THEN 1 ELSE 0 END
           FROM x_bundles b JOIN x_seq s ON s.programid = b.programid AND s.deploymentnumber = b.deploymentnumber
             AND s.language = b.language AND s.n = b.n + 1""",
    ),
    "x_small_bundles": (
        ("x_seq",),
        f"""SELECT programid, deploymentnumber, language, message_uuid, n, length_bytes AS open, 1 AS held, CAST(0 AS BIGINT) AS bundle_index
           FROM x_seq WHERE n = 1
           UNION ALL
           SELECT s.programid, s.deploymentnumber, s.language, s.message_uuid, s.n,
                  CASE WHEN {_FULL} THEN s.length_bytes ELSE b.open + s.length_bytes END, CASE WHEN {_FULL} THEN 1 ELSE b.held + 1 END,
                  b.bundle_index + CASE WHEN {_FULL} THEN 1 ELSE 0 END
           FROM x_small_bundles b JOIN x_seq s ON s.programid = b.programid AND s.deploymentnumber = b.deploymentnumber
             AND s.language = b.language AND s.n = b.n + 1""",
    ),
}


def sql(body: str, *reads: str) -> str:
    """``body`` with every table and piece it reads defined in front of it."""
    pieces: list[str] = []
    tables: list[str] = []

    def visit(name: str) -> None:
        if name in PIECES:
            for needed in PIECES[name][0]:
                visit(needed)
            if name not in pieces:
                pieces.append(name)
        elif name not in tables:
            tables.append(name)

    for name in reads:
        visit(name)
    from fieldcast.bindings import BINDINGS

    head = duckdb_with(*[t for t in tables if t in BINDINGS])
    parts = ([head] if head.strip() != "WITH" else []) + [f"{n} AS ({PIECES[n][1]})" for n in pieces]
    text = ",\n".join(parts)
    if text and not text.startswith("WITH"):
        text = "WITH " + text
    return text.replace("WITH ", "WITH RECURSIVE ", 1) + "\n" + body


_VARIANCE = """SELECT * EXCLUDE (stats_hundredths, max_hundredths, flash_hundredths),
    CAST(stats_hundredths AS DOUBLE) / 100 AS played_seconds_stats, CAST(max_hundredths AS DOUBLE) / 100 AS played_seconds_max,
    CAST(flash_hundredths AS DOUBLE) / 100 AS effecticecompletions_flash, started_max - started_min AS started_variance FROM x_all"""

_PLAY_ORDER = "deployment_uuid, played_seconds, completed, community, recipientid NULLS FIRST"
_PLAY_KEYS = "timestamp, tbcdid, project, deployment, talkingbookid, contentid"
_DEPLOYED_ORDER = "recipientid, project, contentpackage, action, newsn, deployment, firmware, testing"
_PLAY_OUT = """timestamp, project, deployment, contentpackage, community, talkingbookid, contentid, completed, played_seconds,
    tbcdid, recipientid, deployment_uuid"""
_FIRST_PLAYS = f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {_PLAY_KEYS}
    ORDER BY deployment_uuid, played_seconds, completed) AS rn FROM playstatistics) WHERE rn = 1"""


def _community(datasource: int, measure: str) -> str:
    return f"""SELECT k.project, s.village, k.contentpackage, count(DISTINCT s.talkingbook) AS "TBs",
        CAST(sum(s.countcompleted) AS BIGINT) AS "{measure}",
        CAST(sum(s.countcompleted) // count(DISTINCT s.talkingbook) AS BIGINT) AS "ComplPerTB"
        FROM syncaggregation s JOIN contentinpackage k ON k.contentid = s.contentid AND k.contentpackage = s.contentpackage
        JOIN communities c ON c.communityname = s.village AND c.project = k.project
        JOIN x_pid p ON p.contentpackage = k.contentpackage AND p.project = k.project
        WHERE s.datasource = {datasource} GROUP BY k.project, s.village, p.startdate, k.contentpackage"""


def _against_flash(by: str) -> str:
    return f"""SELECT {by}, count(DISTINCT talkingbook) AS "TBs",
        CAST(coalesce(sum(countcompleted) FILTER (datasource = 2), 0) AS BIGINT) AS stats,
        CAST(coalesce(sum(countcompleted) FILTER (datasource = 3), 0) AS BIGINT) AS flash,
        CAST(sum(totaltimeplayed) // 3600 AS BIGINT) AS "Played_Hours_Flash"
        FROM (SELECT p.project, p.deployment, p.contentpackage, s.datasource, s.talkingbook, s.countcompleted, s.totaltimeplayed
              FROM syncaggregation s JOIN contentinpackage k ON k.contentid = s.contentid AND k.contentpackage = s.contentpackage
              JOIN x_pid p ON p.contentpackage = k.contentpackage AND p.project = k.project WHERE s.datasource > 1)
        GROUP BY {by}, datasource"""


_MESSAGE_MEASURES = f"""
    {ratio('timeplayed', '60 * pkgtbs', 0)} AS minutes_per_tb, {ratio('effective', 'pkgtbs', 1)} AS eff_completions_per_tb,
    {ratio('timeplayed', '60', 0)} AS total_minutes_played, completed AS total_completions,
    effective AS total_effective_completions,
    CASE WHEN completed > 0 THEN {ratio('(effective - completed) * 100', 'completed', 0)} ELSE 0 END AS partial_percentage,
    tbs, pkgtbs, tbs * 100 // pkgtbs AS "TB%" """

_CONTENTS = """SELECT DISTINCT x.title, {label}, x.category, x."order", x.format, x.length_minutes, x.languagecode, x.source,
    x.keywords, x.acm_categories, x.transcriptionurl, x.notes
    FROM x_content x JOIN x_pid p ON p.contentpackage = x.contentpackage {where}"""

_SHARE = """(SELECT nullif(count(*), 0) FROM x_tb b WHERE b.project = s.project AND b.contentpackage = s.contentpackage AND {test})"""


def _share(test: str) -> str:
    return ratio(_SHARE.format(test=test), "s.tbs", 2)


_PACKAGE_STATS = f"""
    , x_here AS (SELECT a.* FROM x_alls a WHERE EXISTS (SELECT 1 FROM contentinpackage k
        WHERE k.project = a.project AND k.contentpackage = a.contentpackage AND k.contentid = a.contentid)),
    x_total AS (SELECT project, contentpackage, count(DISTINCT contentid) AS total FROM x_here GROUP BY ALL),
    x_tb AS (SELECT h.project, h.contentpackage, h.talkingbook, count(DISTINCT h.contentid) AS played, any_value(t.total) AS total
        FROM x_here h JOIN x_total t USING (project, contentpackage) GROUP BY ALL),
    x_sum AS (SELECT project, contentpackage, count(DISTINCT contentid) AS msgs, CAST(sum(played_seconds_max) AS BIGINT) AS timeplayed,
        CAST(sum(effectivecompletions_max) AS BIGINT) AS effective, CAST(sum(completed_max) AS BIGINT) AS completed,
        count(DISTINCT talkingbook) AS tbs FROM x_alls a
        WHERE EXISTS (SELECT 1 FROM contentinpackage k WHERE k.contentpackage = a.contentpackage AND k.contentid = a.contentid) GROUP BY ALL)
    SELECT DISTINCT s.project, p.deployment, s.contentpackage, p.packagename, p.startdate,
        {ratio('s.timeplayed', '3600', 1)} AS hoursplayed, s.msgs,
        (SELECT CAST(sum(m.duration_sec) // 60 AS BIGINT) FROM contentmetadata2 m JOIN contentinpackage k ON k.contentid = m.contentid
         WHERE k.contentpackage = s.contentpackage) AS duration_min,
        {ratio('s.timeplayed', '3600 * s.tbs', 0)} AS hourspertb, s.completed,
        {ratio('s.completed', 's.tbs * s.msgs', 1)} AS completionspertbpermsg,
        {ratio('s.effective', 's.tbs', 1)} AS effcompletionspertb, s.tbs AS tbcount,
        {_share('b.played = b.total')} AS tbsplayingallmsgspct,
        {_share('b.played >= 0.5 * b.total AND b.played <> b.total')} AS tbsplayinghalfnotallmsgspct,
        {_share('b.played < 0.5 * b.total')} AS tbsplayinglessthanhalfmsgspct
    FROM x_sum s JOIN x_pid p ON p.project = s.project AND p.contentpackage = s.contentpackage"""

_COLLECTED = """SELECT concat('processed-data/', strftime(o_orderdate, '%Y/%m/%d/%Yy%mm%dd'), lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0'),
    'h00m05s') AS directory, o_orderdate, o_orderkey, concat('/tbcd', o_orderkey % 7, CASE WHEN o_orderkey % 3 = 0 THEN '.log' ELSE '.ZIP' END) AS name
    FROM orders"""

_USAGE_BY_MESSAGE = f"""SELECT u.project, {texts('u.deployment')} AS deployment, u.deploymentnumber, u.contentpackage, u.languagecode,
    u.language, count(DISTINCT u.category) AS num_categories, {texts('u.category')} AS category_list, u.contentid, u.title, u.format,
    {texts('u.position')} AS position_list, {ratio('u.duration_seconds', '60', 1)} AS duration_minutes,
    {ratio('sum(u.played_seconds)', '60', 1)} AS played_minutes,
    {ratio('sum(u.played_seconds)', '60 * greatest(max(p.package_tbs_used), 1)', 1)} AS played_minutes_per_tb,
    CAST(sum(u.completions) AS BIGINT) AS completions,
    CAST(sum(u.completions) // greatest(max(p.package_tbs_used), 1) AS DOUBLE) AS completions_per_tb,
    count(DISTINCT u.talkingbookid) AS num_tbs, max(p.package_tbs_used) AS num_package_tbs,
    {ratio('100 * count(DISTINCT u.talkingbookid)', 'greatest(max(p.package_tbs_used), 1)', 0)} AS percent_tbs_playing
    FROM x_usage u JOIN x_used p ON p.project = u.project AND lower(p.contentpackage) = lower(u.contentpackage)
    GROUP BY u.project, u.deploymentnumber, u.contentpackage, u.languagecode, u.language, u.contentid, u.title, u.format, u.duration_seconds"""

_USAGE_BY_CATEGORY = f"""SELECT c.project, c.deploymentnumber, {texts('c.deployment')} AS deployment, c.contentpackage, c.languagecode,
    c.language, c.category, count(DISTINCT c.contentid) AS num_messages, {ratio('sum(c.duration_seconds)', '60', 0)} AS duration_minutes,
    {ratio('max(t.played)', '60', 0)} AS played_minutes, CAST(max(t.completions) AS BIGINT) AS completions,
    max(t.cat_tbs) AS cat_tbs, max(p.package_tbs_used) AS pkg_tbs
    FROM (SELECT DISTINCT project, deploymentnumber, deployment, startdate, contentpackage, languagecode, language, category,
                 contentid, duration_seconds FROM x_usage) c
    JOIN (SELECT project, deploymentnumber, contentpackage, category, count(DISTINCT talkingbookid) AS cat_tbs,
                 sum(played_seconds) AS played, sum(completions) AS completions FROM x_usage GROUP BY ALL) t
      ON t.project = c.project AND t.deploymentnumber = c.deploymentnumber AND lower(t.contentpackage) = lower(c.contentpackage)
         AND lower(t.category) = lower(c.category)
    JOIN x_used p ON p.project = c.project AND lower(p.contentpackage) = lower(c.contentpackage)
    GROUP BY c.project, c.deploymentnumber, c.contentpackage, c.languagecode, c.language, c.category"""


def _production_by_deployment(factor: str = "1") -> str:
    return f"""SELECT m.project, {texts('m.deployment')} AS deployment, m.deploymentnumber, m.startdate,
        max(k.num_packages) AS num_packages, max(k.num_languages) AS num_languages, max(c.num_categories) AS num_categories,
        count(DISTINCT m.contentid) AS num_messages, {ratio(f'CAST(sum(m.duration_sec) / {factor} AS BIGINT)', '60', 1)} AS duration_minutes
        FROM (SELECT DISTINCT project, deployment, deploymentnumber, startdate, contentid, duration_sec FROM x_prod) m
        JOIN (SELECT project, deployment, deploymentnumber, count(DISTINCT languagecode) AS num_languages,
                     count(DISTINCT package) AS num_packages,
                     (SELECT count(DISTINCT o.deployment) FROM x_prod o WHERE o.project = x.project AND o.deploymentnumber = x.deploymentnumber) AS names
              FROM x_prod x GROUP BY project, deployment, deploymentnumber) k ON k.project = m.project AND k.deploymentnumber = m.deploymentnumber
        JOIN (SELECT project, deployment, deploymentnumber, count(DISTINCT categoryname) AS num_categories
              FROM x_prod GROUP BY ALL) c ON c.project = m.project AND c.deploymentnumber = m.deploymentnumber
        GROUP BY m.project, m.deploymentnumber, m.startdate"""


def _dashboard(source: str, keep: int) -> str:
    return f"""SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY project
        ORDER BY startdate DESC NULLS FIRST, deploymentnumber DESC NULLS FIRST, deployment) AS rn FROM {source}) WHERE rn <= {keep}"""


def _first(batch: str, keys: str, order: str) -> str:
    return f"SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {batch}) WHERE rn = 1"


ORACLE: dict[str, str] = {
    "program_info": sql("SELECT projectcode AS project, project AS description FROM projects", "projects"),
    "project_list": sql("SELECT projectcode AS project, projectcode || '/' AS path FROM projects WHERE id >= 0", "projects"),
    "tbs_deployed_info": sql("FROM x_tbs", "x_tbs"),
    "deployment_info": sql("FROM x_depl", "x_depl"),
    "deployments_by_deployment": sql("FROM x_depl_by", "x_depl_by"),
    "deployments_by_community": sql(
        """SELECT project, deployment, deploymentnumber, startdate, enddate, package, recipientid, communityname,
           communityname AS community, count(DISTINCT talkingbookid) AS deployed_tbs FROM x_depl GROUP BY ALL""", "x_depl"),
    "deployments_by_package": sql(
        """SELECT x.project, x.deployment, x.deploymentnumber, x.startdate, x.enddate, x.package, x.languagecode, g.language,
           count(DISTINCT x.communityname) AS num_communities, count(DISTINCT x.talkingbookid) AS deployed_tbs
           FROM x_depl x JOIN languages g ON g.projectcode = x.project AND lower(g.languagecode) = lower(x.languagecode)
           GROUP BY ALL""", "x_depl", "languages"),
    "update_operation_info": sql(
        """SELECT project, outdeployment AS deployment, outimage AS package, outcommunity AS community, outsn AS talkingbook
           FROM tbdataoperations WHERE lower(action) LIKE 'update%' GROUP BY ALL""", "tbdataoperations"),
    "deployments_by_updateoperation": sql(
        """SELECT project, outcommunity AS community, outsn AS talkingbook, count(DISTINCT outimage) AS num_packages
           FROM tbdataoperations WHERE lower(action) LIKE 'update%' GROUP BY ALL""", "tbdataoperations"),
    "deployments_by_talkingbook": sql("FROM x_tbd", "x_tbd"),
    "deployments_by_recipient": sql(
        f"""SELECT project, deploymentnumber, partner, affiliate, communityname, groupname, country, region, district, recipientid,
           {texts('deployment')} AS deployment, count(DISTINCT talkingbookid) AS num_tbs FROM x_tbd
           GROUP BY project, deploymentnumber, partner, affiliate, communityname, groupname, country, region, district, recipientid""", "x_tbd"),
    "deployment_date_mismatch": sql(
        f"""SELECT project, deploymentnumber, {texts('deployment')} AS deployments, count(DISTINCT startdate) AS numstarts,
           count(DISTINCT enddate) AS numends FROM deployments GROUP BY project, deploymentnumber
           HAVING count(DISTINCT startdate) <> 1 OR count(DISTINCT enddate) <> 1""", "deployments"),
    "deployment_spec": sql(
        """SELECT DISTINCT project, deploymentnumber AS deployment_num, startdate, enddate, component,
           concat(project, '-', year(startdate) % 100, '-', deploymentnumber) AS name FROM deployments""", "deployments"),
    "deployment_dashboard": sql(
        "SELECT * EXCLUDE num_recipients FROM (" + _dashboard("(FROM x_depl_by WHERE deploymentnumber > 0)", 4) + ")", "x_depl_by"),
    "tb_deployments": sql(
        """SELECT DISTINCT project, deploymentnumber, deployment, partner, affiliate, country, region, district, communityname,
           groupname, recipientid, talkingbookid FROM x_tbd""", "x_tbd"),
    "tb_deployments_by_deployment": sql(
        f"""SELECT project, deploymentnumber, {texts('deployment')} AS deployments, count(DISTINCT recipientid) AS num_recipients,
           count(DISTINCT talkingbookid) AS num_tbs FROM x_tbd GROUP BY project, deploymentnumber""", "x_tbd"),
    "tbnewsn": sql("FROM x_newsn", "x_newsn"),
    "tbnewsn_by_months": sql("FROM x_newsn_months", "x_newsn_months"),
    "tbnewsn_past_six_months": sql(
        f"FROM x_newsn_months WHERE earliest >= CAST(DATE '{AS_OF}' - INTERVAL 6 MONTH AS DATE)", "x_newsn_months"),
    "production_info": sql("FROM x_prod", "x_prod"),
    "production_by_deployment": sql(_production_by_deployment(), "x_prod"),
    "join_derived_aggs": sql(_production_by_deployment("(max(k.names) * max(k.names))"), "x_prod"),
    "production_by_package": sql(
        f"""SELECT m.project, m.deployment, m.deploymentnumber, m.startdate, m.package, m.languagecode, m.language,
           max(c.n) AS num_categories, count(DISTINCT m.contentid) AS num_messages, count(m.contentid) AS all_messages,
           {ratio('sum(m.duration_sec)', '60', 1)} AS duration_minutes
           FROM (SELECT DISTINCT project, deployment, deploymentnumber, startdate, package, languagecode, language, contentid, duration_sec FROM x_prod) m
           JOIN (SELECT project, deployment, deploymentnumber, package, count(DISTINCT categoryid) AS n FROM x_prod GROUP BY ALL) c
             ON c.project = m.project AND lower(c.deployment) = lower(m.deployment) AND lower(c.package) = lower(m.package)
           GROUP BY m.project, m.deployment, m.deploymentnumber, m.startdate, m.package, m.languagecode, m.language""", "x_prod"),
    "production_by_category": sql(
        f"""SELECT project, deployment, deploymentnumber, startdate, package, languagecode, language, categoryid, categoryname,
           count(DISTINCT contentid) AS num_messages, {ratio('sum(duration_sec)', '60', 1)} AS duration_minutes
           FROM x_prod GROUP BY project, deployment, deploymentnumber, startdate, package, languagecode, language, categoryid, categoryname""", "x_prod"),
    "content_cats_in_package": sql("FROM x_cats", "x_cats"),
    "usage_info_base_view": sql("FROM x_base", "x_base"),
    "usage_info": sql("FROM x_usage", "x_usage"),
    "refresh_usage_info": sql("FROM x_usage", "x_usage"),
    "refresh_usage_info_periods": sql("FROM x_usage", "x_usage"),
    "package_tbs_used": sql("FROM x_used", "x_used"),
    "twbx_info": sql(
        """SELECT r.project, u.talkingbookid AS "TB", u.deploymentnumber AS "Deployment #", u.region AS "Region", u.district AS "District",
           u.communityname AS "Community", u.agent AS "Agent", u.title AS "Message", u.language AS "Language", u.format AS "Format",
           u.playlist AS "Playlist", u.position AS "Position", u.duration_seconds AS "Duration",
           CAST(sum(u.completions) AS BIGINT) AS "Total Completions", CAST(sum(u.played_seconds) AS BIGINT) AS "Total Time Played"
           FROM x_usage u JOIN recipients r ON r.recipientid = u.recipientid WHERE u.played_seconds > 0 GROUP BY ALL""", "x_usage"),
    "usage_by_message": sql(_USAGE_BY_MESSAGE, "x_usage", "x_used"),
    "usage_by_package_category": sql(_USAGE_BY_CATEGORY, "x_usage", "x_used"),
    "usage_by_deployment": sql("FROM x_usage_by", "x_usage_by"),
    "usage_dashboard": sql(
        "SELECT project, deployment, deploymentnumber, startdate, num_packages, num_communities, num_tbs FROM (" + _dashboard("x_usage_by", 4) + ")", "x_usage_by"),
    "recipient_null_census": sql(
        "SELECT count(timestamp) FILTER (recipientid IS NULL) AS nulls, count(timestamp) FILTER (recipientid IS NOT NULL) AS nons FROM playstatistics", "playstatistics"),
    "join_cross_scalar": sql(
        """SELECT * FROM (SELECT count(timestamp) AS nulls FROM playstatistics WHERE recipientid IS NULL),
           (SELECT count(timestamp) AS nons FROM playstatistics WHERE recipientid IS NOT NULL)""", "playstatistics"),
    "missing_uf_not_in_db": sql("SELECT url FROM collected_uuids WHERE uuid NOT IN (SELECT message_uuid FROM uf_messages)", "collected_uuids", "uf_messages"),
    "join_anti": sql("SELECT url FROM collected_uuids WHERE uuid NOT IN (SELECT message_uuid FROM uf_messages)", "collected_uuids", "uf_messages"),
    "missing_uf_not_in_store": sql(
        """SELECT programid, deploymentnumber, language, message_uuid FROM uf_messages
           WHERE message_uuid NOT IN (SELECT uuid FROM collected_uuids)""", "collected_uuids", "uf_messages"),
    "filter_played_events": sql("FROM x_plays", "x_plays"),
    "logstats_from_played_events": sql("FROM x_logs", "x_logs"),
    "allsources": sql(_VARIANCE, "x_all"),
    "allsources_refresh": sql("FROM x_alls", "x_alls"),
    "all_stats_for_deployment": sql(
        """SELECT a.project, p.deployment, p.startdate, CAST(sum(a.played_seconds_max) AS DOUBLE) / 3600 AS hoursplayed,
           """ + ", ".join(f"CAST(sum(a.{c}) AS BIGINT) AS {n}" for n, c in [
            ("effectivecompletions", "effectivecompletions_max"), ("started", "started_max"), ("quarter", "quarter_max"),
            ("half", "half_max"), ("threequarters", "threequarters_max"), ("completed", "completed_max"),
            ("completed_logevents", "completed_logevents"), ("completed_logs", "completed_logs"),
            ("completed_stats", "completed_stats"), ("completed_flash", "completed_flash"), ("completed_min", "completed_min"),
            ("completed_max", "completed_max"), ("completed_variance", "completed_variance")]) + """
           FROM x_alls a JOIN x_pid p ON p.contentpackage = a.contentpackage GROUP BY a.project, p.deployment, p.startdate""", "x_alls", "x_pid"),
    "community_completions_flash": sql(_community(3, "FlashStats"), "syncaggregation", "contentinpackage", "communities", "x_pid"),
    "community_completions_stats": sql(_community(2, "stats"), "syncaggregation", "contentinpackage", "communities", "x_pid"),
    "compare_stats_flash_by_deployment": sql(_against_flash("project, deployment"), "syncaggregation", "contentinpackage", "x_pid"),
    "compare_stats_flash_by_package": sql(_against_flash("project, deployment, contentpackage"), "syncaggregation", "contentinpackage", "x_pid"),
    "sink_csv_stdout": sql(_against_flash("project, deployment, contentpackage"), "syncaggregation", "contentinpackage", "x_pid"),
    "msgs_played_each_tb": sql(
        """, x_here AS (SELECT a.* FROM x_alls a WHERE contentid IN (SELECT contentid FROM contentinpackage k
             WHERE k.project = a.project AND k.contentpackage = a.contentpackage))
           SELECT project, contentpackage, talkingbook, village, count(DISTINCT contentid) AS msgsplayed,
             (SELECT count(DISTINCT contentid) FROM x_here o WHERE o.project = h.project AND o.contentpackage = h.contentpackage) AS msgstotal
           FROM x_here h GROUP BY project, contentpackage, talkingbook, village""", "x_alls", "contentinpackage"),
    "package_stats": sql(_PACKAGE_STATS, "x_alls", "contentinpackage", "contentmetadata2", "x_pid"),
    "tb_count_community_package": sql(
        """SELECT c.project, a.village, a.contentpackage, count(DISTINCT a.talkingbook) AS "TBs"
           FROM communities c LEFT JOIN x_alls a ON a.village = c.communityname GROUP BY ALL""", "x_alls", "communities"),
    "contents_by_deployment": sql(_CONTENTS.format(label="p.deployment", where=""), "x_content", "x_pid"),
    "param_filters": sql(
        _CONTENTS.format(label="p.deployment", where="WHERE p.deployment = 'ASIA-1997-1' AND x.project = 'ASIA'"), "x_content", "x_pid"),
    "contents_by_package": sql(_CONTENTS.format(label="p.packagename", where=""), "x_content", "x_pid"),
    "top_msgs_by_deployment": sql(
        f"""SELECT DISTINCT title, "Deployment", contentpackage, category, "order", format, length_minutes, {_MESSAGE_MEASURES}
           FROM (SELECT m.title, concat('d', d.deployment) AS "Deployment", d.contentpackage, y.category, y."order", m.format,
                   m.duration_sec // 60 AS length_minutes, s.timeplayed, s.effective, s.completed, s.tbs, s.pkgtbs
                 FROM (SELECT x.project, x.contentpackage, x.contentid, p.deployment, any_value(x.tbs) AS tbs, any_value(x.pkgtbs) AS pkgtbs,
                         CAST(sum(x.timeplayed) AS BIGINT) AS timeplayed, CAST(sum(x.effective) AS BIGINT) AS effective, CAST(sum(x.completed) AS BIGINT) AS completed
                       FROM x_msg x JOIN x_pid p ON p.contentpackage = x.contentpackage GROUP BY ALL) s
                 JOIN contentmetadata2 m ON m.contentid = s.contentid AND m.project = s.project
                 JOIN x_pid d ON d.deployment = s.deployment
                 JOIN x_content y ON y.contentpackage = d.contentpackage AND y.contentid = s.contentid)""",
        "x_msg", "x_pid", "contentmetadata2", "x_content"),
    "top_msgs_by_package": sql(
        f"""SELECT title, "Package", category, "order", format, length_minutes, {_MESSAGE_MEASURES}
           FROM (SELECT y.*, s.timeplayed, s.effective, s.completed, s.tbs, s.pkgtbs,
                   (SELECT min(packagename) FROM x_pid p WHERE p.project = s.project AND p.contentpackage = s.contentpackage) AS "Package"
                 FROM x_msg s JOIN x_content y ON y.project = s.project AND y.contentpackage = s.contentpackage AND y.contentid = s.contentid)
           WHERE "Package" IS NOT NULL""", "x_msg", "x_pid", "x_content"),
    "tbcollections_refresh": sql(
        """SELECT contentpackage, village AS communityname, talkingbook FROM syncaggregation
           UNION SELECT packageid, village, talkingbookid FROM playedevents""", "syncaggregation", "playedevents"),
    "truncate_tables": sql(
        "SELECT contentpackage, village AS communityname, talkingbook FROM syncaggregation WHERE false", "syncaggregation"),
    # sources
    "src_kv_log": sql("FROM x_kv", "x_kv"),
    "kv_discover_columns": sql(
        """SELECT key, file, line_no, pos FROM (
             SELECT *, row_number() OVER (PARTITION BY key ORDER BY file, line_no, pos) AS rn FROM (
               SELECT file, line_no, i - 3 AS pos, split_part(parts[i], ':', 1) AS key FROM (
                 SELECT file, line_no, parts, unnest(range(3, len(parts) + 1)) AS i
                 FROM (SELECT file, line_no, string_split(value, ',') AS parts FROM kv_lines) WHERE len(parts) > 2))) WHERE rn = 1""", "kv_lines"),
    "kv_project_columns": sql(
        """SELECT timestamp, user, type, coalesce(ratio, '') AS ratio, coalesce(optional, '') AS optional, project, community,
           coalesce(recipientid, '') AS recipientid FROM x_kv""", "x_kv"),
    "concat_batches": sql("SELECT * EXCLUDE line_no FROM x_kv", "x_kv"),
    "src_deployments_log": sql(
        """SELECT concat('B-', lpad(CAST(okey % 400 AS VARCHAR), 8, '0')) AS talkingbookid, mr AS recipientid,
           odate + to_hours(CAST(okey % 24 AS BIGINT)) + INTERVAL 5 SECOND + INTERVAL 486 MILLISECOND AS deployedtimestamp, project, dep AS deployment,
           concat(dep, '-', lc) AS contentpackage, 'r1212' AS firmware, concat('L', ckey % 5) AS location,
           CASE WHEN okey % 23 = 0 THEN 'UNKNOWN' ELSE concat('user', ckey % 9) END AS username,
           lpad(CAST(ckey % 50 AS VARCHAR), 4, '0') AS tbcdid, 'update' AS action, okey % 6 = 0 AS newsn, false AS testing,
           CASE WHEN okey % 4 = 0 THEN okey % 90 + 0.5e0 END AS latitude, CASE WHEN okey % 4 = 0 THEN CAST(concat('-', ckey % 180) AS DOUBLE) END AS longitude
           FROM ord JOIN x_map ON mp = upper(project) AND md = concat('C', ckey % 310, ' - G', ckey % 3)
           WHERE okey % 29 <> 0 AND okey % 31 <> 0""", "ord", "x_map"),
    "src_tbdataoperations": sql(
        """SELECT CASE WHEN okey % 13 = 0 OR okey % 17 = 0 THEN 'Unknown' ELSE concat('B-', okey % 400) END AS talkingbookid, mr AS recipientid,
           odate + to_hours(CAST(okey % 24 AS BIGINT)) + to_minutes(CAST(okey % 60 AS BIGINT)) + to_seconds(okey % 59) AS deployedtimestamp,
           project, dep AS deployment, lower(concat(dep, '-', lc)) AS contentpackage, CASE WHEN okey % 5 = 0 THEN 'Unknown' ELSE 'r1212' END AS firmware,
           concat('L', ckey % 5) AS location, 'Unknown' AS username,
           CASE WHEN okey % 3 = 0 THEN 'Unknown' ELSE right(lpad(CAST(ckey AS VARCHAR), 6, '0'), 4) END AS tbcdid,
           CASE WHEN okey % 4 = 0 THEN 'Update-FW' ELSE 'update' END AS action, false AS newsn, false AS testing
           FROM ord LEFT JOIN x_map ON mp = upper(project) AND md = upper(concat('C', ckey % 300, ' - g', ckey % 3))
           WHERE okey % 4 <> 1 AND ckey % 19 <> 0""", "ord", "x_map"),
    "src_recipients_map": sql(
        """SELECT upper(project) AS project, upper(concat(communityname, ' - ', groupname)) AS directory,
           arg_max(recipientid, CAST(substring(recipientid, 2) AS BIGINT)) AS recipientid FROM recipients GROUP BY 1, 2""", "recipients"),
    "src_csv_bulk": sql("FROM recipients", "recipients"),
    "src_properties": sql(
        """SELECT concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.properties') AS path,
           CAST(9 + CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1 END + CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 17 = 0 THEN 0 ELSE 1 END AS INT) AS keys,
           concat('PROG', doc_id % 2) AS project, CAST(doc_id % 3 AS VARCHAR) AS deployment_number, concat('r', doc_id % 150) AS recipientid,
           CASE WHEN doc_id % 4 <> 0 THEN concat('2021', lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0'), '05') END AS timestamp,
           concat('name=', doc_id % 5) AS collection_username, upper(lang) AS metadata_language FROM documents"""),
    "src_a18_metadata": sql(
        """SELECT concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.a18') AS path,
           CASE WHEN ok THEN concat('title ', doc_id) END AS title, CASE WHEN ok THEN lang END AS language,
           CASE WHEN ok THEN concat(lang, ';', source) END AS keywords, CASE WHEN ok THEN CAST(doc_id % 100 AS VARCHAR) END AS status,
           CASE WHEN ok THEN concat('TB', doc_id % 40) END AS publisher, CASE WHEN ok THEN CAST(secs AS VARCHAR) END AS seconds,
           CASE WHEN ok THEN concat(lpad(CAST(secs // 60 AS VARCHAR), CAST(greatest(2, len(CAST(secs // 60 AS VARCHAR))) AS INT), '0'), ':', lpad(CAST(secs % 60 AS VARCHAR), 2, '0'),
                CASE WHEN doc_id % 2 = 0 THEN ' l' ELSE ' h' END) END AS duration,
           CASE WHEN NOT ok THEN 'metadata version 2, expected 1' END AS error
           FROM (SELECT *, doc_id % 19 <> 0 AS ok, CAST(floor((n_chars * 2 + 2) * 8 / CASE WHEN doc_id % 2 = 0 THEN 16000 ELSE 64 END + 0.5) AS BIGINT) AS secs FROM documents)"""),
    "src_zip_artifacts": sql(
        """SELECT concat('/in/', doc_id) AS directory, m.member, m.line_no, m.line FROM documents,
           LATERAL (SELECT 'stats_collected.properties' AS member, 0 AS line_no, concat('user=u', doc_id % 9) AS line
             UNION ALL SELECT 'tbsdeployed.csv', 0, CASE WHEN doc_id % 5 = 0 THEN concat('loose ', doc_id) ELSE 'talkingbookid,action' END
             UNION ALL SELECT 'tbsdeployed.csv', 1, concat('TB', doc_id % 40, ',update') WHERE doc_id % 5 <> 0
             UNION ALL SELECT 'tbsdeployed.csv', 2, concat('TB', doc_id, ',last') WHERE doc_id % 5 <> 0) m"""),
    "src_object_listing": sql(
        """SELECT md5(CAST(doc_id AS VARCHAR)) AS uuid, concat('collected/PROG', doc_id % 2, '/', doc_id % 3, '/', md5(CAST(doc_id AS VARCHAR))) AS url
           FROM documents WHERE doc_id % 3 <> 0"""),
    "src_daily_dirs": sql(
        f"""SELECT DISTINCT strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day, directory,
            o_orderdate + to_hours(CAST(o_orderkey % 24 AS BIGINT)) + INTERVAL 5 SECOND AS collected FROM ({_COLLECTED}) WHERE name LIKE '%.ZIP'"""),
    "src_file_walk": sql(
        f"SELECT count(DISTINCT directory) AS n_dirs, count(*) FILTER (name LIKE '%.ZIP') AS n_files, count(*) FILTER (name LIKE '%.log') AS n_skipped FROM ({_COLLECTED})"),
    "limit_files": sql(f"SELECT DISTINCT directory || name AS path FROM ({_COLLECTED}) WHERE name LIKE '%.ZIP' ORDER BY path LIMIT 100"),
    "src_table_scan": "SELECT * FROM lineitem",
    # merges and sinks
    "merge_playstatistics": sql(
        f""", b AS (SELECT * REPLACE (completed * 2 AS completed) FROM playstatistics WHERE tbcdid IN ('tbcd6', 'tbcd7'))
           SELECT * FROM playstatistics t WHERE tbcdid <> 'tbcd7' AND NOT EXISTS (SELECT 1 FROM b WHERE b.timestamp = t.timestamp
             AND b.tbcdid = t.tbcdid AND b.project = t.project AND b.deployment = t.deployment AND b.talkingbookid = t.talkingbookid AND b.contentid = t.contentid)
           UNION ALL {_first('b', _PLAY_KEYS, _PLAY_ORDER)}""", "playstatistics"),
    "join_delete_using": sql("SELECT * FROM playstatistics WHERE tbcdid NOT IN ('tbcd6', 'tbcd7')", "playstatistics"),
    "merge_tbsdeployed": sql(
        f""", b AS (SELECT * REPLACE ('batch' AS username) FROM tbsdeployed WHERE action = 'update-fw')
           SELECT * FROM tbsdeployed WHERE (talkingbookid, deployedtimestamp) NOT IN (SELECT (talkingbookid, deployedtimestamp) FROM b)
           UNION ALL {_first('b', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER)}""", "tbsdeployed"),
    "merge_tbsdeployed_stored": sql(
        f""", r AS ({_first('tbsdeployed', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER)})
           SELECT * REPLACE (CASE WHEN action = 'update-fw' THEN 'batch' ELSE username END AS username) FROM r""", "tbsdeployed"),
    "insert_ignore": sql(
        """SELECT * REPLACE (CASE WHEN deploymentnumber = 1 THEN 'first' ELSE language END AS language) FROM uf_messages WHERE bundle_uuid IS NULL""", "uf_messages"),
    "upsert": sql(
        f""", s AS ({_first('tbsdeployed', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER)}),
           b AS ({_first('(FROM tbsdeployed WHERE testing)', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER.replace(' firmware,', ''))})
           SELECT s.* FROM s ANTI JOIN b USING (talkingbookid, deployedtimestamp)
           UNION ALL BY NAME SELECT b.* REPLACE (concat('new ', b.username) AS username, s.firmware AS firmware) FROM b JOIN s USING (talkingbookid, deployedtimestamp)""", "tbsdeployed"),
    "upsert_stored": sql(
        f""", s AS ({_first('tbsdeployed', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER)}),
           b AS ({_first('(FROM tbsdeployed WHERE testing)', 'talkingbookid, deployedtimestamp', _DEPLOYED_ORDER.replace(' firmware,', ''))})
           SELECT s.* FROM s ANTI JOIN b USING (talkingbookid, deployedtimestamp)
           UNION ALL BY NAME SELECT b.* REPLACE (concat('new ', b.username) AS username, s.firmware AS firmware) FROM b JOIN s USING (talkingbookid, deployedtimestamp)""", "tbsdeployed"),
    "normalize_case": sql("SELECT * REPLACE (upper(outimage) AS outimage, upper(inimage) AS inimage) FROM tbdataoperations", "tbdataoperations"),
    "backfill_descriptions": sql(
        "SELECT projectcode AS program, CASE WHEN id % 2 = 0 THEN 'kept' ELSE project END AS description FROM projects", "projects"),
    "update_uf_bundles": sql(
        """SELECT * REPLACE (CASE WHEN message_uuid IN (SELECT message_uuid FROM x_kept) THEN 'new' ELSE bundle_uuid END AS bundle_uuid) FROM uf_messages""", "x_kept"),
    "sink_global_reports": sql(
        "SELECT * EXCLUDE num_recipients FROM (" + _dashboard("(FROM x_depl_by WHERE deploymentnumber > 0)", 4) + ")", "x_depl_by"),
    "sink_properties": sql(
        """SELECT concat('PROG', doc_id % 2) AS program, doc_id % 3 AS deployment,
           CAST(9 + CASE WHEN doc_id % 4 = 0 THEN 0 ELSE 1 END + CASE WHEN doc_id % 6 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 17 = 0 THEN 0 ELSE 1 END AS INT) AS keys,
           CASE WHEN doc_id % 17 <> 0 THEN md5(CAST(doc_id AS VARCHAR)) END AS message_uuid, CAST(n_chars AS VARCHAR) AS bytes FROM documents"""),
    "export_recipients_map": sql("SELECT project, directory, recipientid FROM recipients_map", "recipients_map"),
    "export_tbdataoperations": sql(
        """SELECT outsn, updatedatetime, project, outdeployment, outimage, outcommunity, outfwrev, outsyncdir, location, action
           FROM tbdataoperations WHERE updatedatetime < '1999Y06M01' AND action ILIKE 'update%'""", "tbdataoperations"),
    # filters, joins, lookups
    "case_strip_general": sql(
        """SELECT projectcode, categoryid, replace(categoryname, 'General-', '') AS category,
           CASE WHEN categoryid = 'Brand#3' THEN categoryid ELSE replace(categoryname, 'General-', '') END AS or_title FROM categories""", "categories"),
    "filter_blacklist": sql(
        "SELECT * FROM tbsdeployed WHERE CAST(substring(tbcdid, 5) AS INT) NOT IN (SELECT c_custkey % 50 FROM customer WHERE c_custkey % 25 = 3)", "tbsdeployed"),
    "filter_non_specific": sql("SELECT project, count(*) AS rows FROM ord WHERE ckey % 19 = 0 GROUP BY project", "ord"),
    "filter_uf_keep": sql("FROM x_kept", "x_kept"),
    "filter_datasource_in": sql("FROM syncaggregation WHERE datasource <> 1", "syncaggregation"),
    "join_equi_inner": sql("SELECT project, deployment, deploymentnumber, talkingbookid, communityname, country FROM x_tbd", "x_tbd"),
    "join_left_outer": sql(
        "SELECT k.*, c.categoryname FROM contentinpackage k LEFT JOIN categories c ON c.projectcode = k.project AND c.categoryid = k.categoryid", "contentinpackage", "categories"),
    "join_ilike": sql(
        """SELECT k.project, k.contentpackage, k.contentid, p.contentpackage AS package, p.deployment FROM contentinpackage k
           JOIN packagesindeployment p ON p.project = k.project AND lower(p.contentpackage) = lower(k.contentpackage)""", "contentinpackage", "packagesindeployment"),
    "join_semi_correlated": sql(
        """SELECT * FROM syncaggregation s WHERE contentid IN (SELECT contentid FROM contentinpackage k WHERE k.contentpackage = s.contentpackage AND k.position <= 2)""",
        "syncaggregation", "contentinpackage"),
    "join_self_pivot": sql(
        """SELECT k.*, a.countcompleted AS logs, b.countcompleted AS stats, f.countcompleted AS flash
           FROM (SELECT DISTINCT contentpackage, village, talkingbook, contentid FROM syncaggregation) k
           LEFT JOIN syncaggregation a ON (a.contentpackage, a.village, a.talkingbook, a.contentid, a.datasource) = (k.contentpackage, k.village, k.talkingbook, k.contentid, 1)
           LEFT JOIN syncaggregation b ON (b.contentpackage, b.village, b.talkingbook, b.contentid, b.datasource) = (k.contentpackage, k.village, k.talkingbook, k.contentid, 2)
           LEFT JOIN syncaggregation f ON (f.contentpackage, f.village, f.talkingbook, f.contentid, f.datasource) = (k.contentpackage, k.village, k.talkingbook, k.contentid, 3)""", "syncaggregation"),
    "lookup_recipient": sql(
        """SELECT timestamp, project, community, coalesce(recipientid, CASE WHEN project <> 'proj3' AND community <> 'dir 5'
             AND concat('rec', project[5:], community[5:]) IN (SELECT recipientid FROM kv_recipients_map) THEN concat('rec', project[5:], community[5:]) END, '') AS recipientid FROM x_kv""", "x_kv", "kv_recipients_map"),
    "lookup_warnings": sql(
        """SELECT upper(project) AS project, CASE WHEN upper(project) IN (SELECT upper(project) FROM kv_recipients_map) THEN upper(community) END AS directory,
             CASE WHEN upper(project) IN (SELECT upper(project) FROM kv_recipients_map) THEN 'unknown directory' ELSE 'unknown project' END AS reason, count(*) AS lines
           FROM x_kv WHERE recipientid IS NULL AND NOT EXISTS (SELECT 1 FROM kv_recipients_map m WHERE upper(m.project) = upper(x_kv.project) AND upper(m.directory) = upper(x_kv.community))
           GROUP BY ALL""", "x_kv", "kv_recipients_map"),
    "lookup_recipient_info": sql(
        """SELECT b.talkingbookid, b.deployedtimestamp, b.asked AS recipientid,
           CASE WHEN r.recipientid IS NULL THEN 0 ELSE 10 + CASE WHEN r.affiliate IS NULL THEN 0 ELSE 1 END + CASE WHEN r.agent IS NULL THEN 0 ELSE 1 END END AS attributes,
           r.project AS program, r.partner AS customer, r.affiliate, r.communityname AS community, r.listening_model
           FROM (SELECT *, CASE WHEN talkingbookid LIKE '%7' THEN concat(recipientid, 'x') ELSE recipientid END AS asked FROM tbsdeployed) b
           LEFT JOIN recipients r ON r.recipientid = b.asked""", "tbsdeployed", "recipients"),
    "lookup_deployment_number": sql(
        """SELECT b.talkingbookid, b.deployedtimestamp, b.project, b.deployment,
           (SELECT min(deploymentnumber) FROM deployments d WHERE d.project = b.project AND d.deployment = b.deployment) AS found_number
           FROM tbsdeployed b""", "tbsdeployed", "deployments"),
    "limit_one": sql(
        """SELECT DISTINCT p.project, p.deployment, (SELECT min(deploymentnumber) FROM deployments d WHERE d.project = p.project AND d.deployment = p.deployment) AS found_number
           FROM packagesindeployment p""", "packagesindeployment", "deployments"),
    # sorts, sets, functions
    "topk_per_group": sql(_dashboard("x_depl_by", 2), "x_depl_by"),
    "union_distinct": sql("FROM x_keys", "x_keys"),
    "distinct": sql("SELECT DISTINCT project, talkingbookid, tbcdid FROM tbsdeployed", "tbsdeployed"),
    "fn_text": sql(
        """SELECT updatedatetime, outcommunity, outsn, outsyncdir, upper(outimage) AS upper_name,
           CASE WHEN outsn IN ('', '-- TO BE ASSIGNED --') THEN 'Unknown' ELSE outsn END AS serial, right(outsyncdir, 4) AS tail,
           concat(project, '-', nullif(outfwrev, '')) AS joined FROM tbdataoperations""", "tbdataoperations"),
    "fn_dates": sql(
        """SELECT outsn, outcommunity, updatedatetime, strptime(updatedatetime, '%YY%mM%dD%Hh%Mm%Ss') AS at,
           concat(updatedatetime[1:4], updatedatetime[6:7], updatedatetime[9:10]) AS checked FROM tbdataoperations""", "tbdataoperations"),
    "fn_math": sql(
        f"""SELECT l_orderkey, l_linenumber, l_partkey, {ratio('p', '60', 1)} AS minutes, {ratio('(p - 20000)', '3600', 2)} AS hours,
            CAST(trunc(CAST(p - 20000 AS DOUBLE) / 7) AS BIGINT) AS sevenths,
            CASE WHEN p >= 3600 THEN concat(p // 3600, ':', lpad(CAST(p % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(p % 60 AS VARCHAR), 2, '0'))
                 WHEN p >= 60 THEN concat(p // 60, ':', lpad(CAST(p % 60 AS VARCHAR), 2, '0')) ELSE concat(p, ' seconds') END AS clock
            FROM (SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS p FROM lineitem)"""),
    "fn_uuid5": """SELECT doc_id, concat(h[1:8], '-', h[9:12], '-5', h[14:16], '-',
           substring('89ab', CAST(instr('0123456789abcdef', h[17:17]) - 1 AS INT) % 4 + 1, 1), h[18:20], '-', h[21:32]) AS uuid
           FROM (SELECT doc_id, sha1(unhex('677aba79e6724fe391d5c69306fe025d') || encode(text)) AS h FROM documents)""",
    # streaming and user feedback
    "ingest_incremental": sql(f"SELECT {_PLAY_OUT} FROM ({_FIRST_PLAYS})", "playstatistics"),
    "late_data": sql(f"SELECT {_PLAY_OUT} FROM ({_FIRST_PLAYS})", "playstatistics"),
    "reingest_partition": sql(
        f"""SELECT * REPLACE (CASE WHEN tbcdid = 'tbcd2' THEN CAST(concat('1', completed) AS INT) ELSE completed END AS completed)
            FROM (SELECT {_PLAY_OUT} FROM ({_FIRST_PLAYS}))""", "playstatistics"),
    "uf_map_columns": sql("FROM x_uf", "x_uf"),
    "uf_import": sql(
        """SELECT * REPLACE (CAST(deploymentnumber AS BIGINT) AS deploymentnumber, CAST(length_seconds AS BIGINT) AS length_seconds,
           CAST(length_bytes AS BIGINT) AS length_bytes) FROM x_uf WHERE deploymentnumber <> '1'""", "x_uf"),
    "uf_list_metadata": sql(
        """SELECT concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.a18') AS path, m.key, m.value
           FROM (SELECT *, CAST(floor((n_chars * 2 + 2) * 8 / CASE WHEN doc_id % 2 = 0 THEN 16000 ELSE 64 END + 0.5) AS BIGINT) AS secs FROM documents),
           LATERAL (VALUES ('TITLE', concat('title ', doc_id)), ('LANGUAGE', lang), ('KEYWORDS', concat(lang, ';', source)), ('STATUS', CAST(doc_id % 100 AS VARCHAR)),
             ('PUBLISHER', concat('TB', doc_id % 40)), ('SECONDS', CAST(secs AS VARCHAR)),
             ('DURATION', concat(lpad(CAST(secs // 60 AS VARCHAR), CAST(greatest(2, len(CAST(secs // 60 AS VARCHAR))) AS INT), '0'), ':', lpad(CAST(secs % 60 AS VARCHAR), 2, '0'), CASE WHEN doc_id % 2 = 0 THEN ' l' ELSE ' h' END))) m(key, value)
           WHERE doc_id % 19 <> 0"""),
    "uf_extract": sql(
        """SELECT concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.a18') AS path, concat('PROG', doc_id % 2) AS project,
           CAST(doc_id % 3 AS VARCHAR) AS deployment_number, concat('title ', doc_id) AS metadata_title, concat('m', doc_id) AS metadata_filename,
           r.country AS recipient_country, lang AS metadata_language,
           CASE WHEN doc_id % 17 = 0 THEN 36 ELSE 32 END AS id_length
           FROM documents LEFT JOIN recipients r ON r.recipientid = concat('r', doc_id % 150) WHERE doc_id % 19 <> 0""", "recipients"),
    "uf_chain": sql(
        """SELECT CASE WHEN doc_id % 17 <> 0 THEN md5(CAST(doc_id AS VARCHAR)) END AS message_uuid, CASE WHEN doc_id % 17 = 0 THEN 36 ELSE 32 END AS id_length,
           concat('PROG', doc_id % 2) AS programid, doc_id % 3 AS deploymentnumber, concat('r', doc_id % 150) AS recipientid, concat('TB', doc_id % 40) AS talkingbookid,
           CAST(floor((n_chars * 2 + 2) * 8.0e0 / CASE WHEN doc_id % 2 = 0 THEN 16000 ELSE 64 END + 0.5e0) AS BIGINT) AS length_seconds,
           CASE WHEN doc_id % 3 <> 0 AND doc_id % 17 <> 0 THEN n_chars * 3 + 7 ELSE n_chars END AS length_bytes, lower(lang) AS language
           FROM documents WHERE doc_id % 19 <> 0"""),
    "uf_extract_errors": sql(
        """SELECT concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.a18') AS path, 'metadata version 2, expected 1' AS error
           FROM documents WHERE doc_id % 19 = 0"""),
    "uf_create_properties": sql(
        """SELECT concat('/uf/PROG0/C', doc_id % 30, '/m', doc_id, '.a18') AS path, 'ASIA' AS project, '3' AS deployment_number,
           (SELECT max(recipientid) FROM recipients r WHERE r.project = 'ASIA' AND r.communityname = concat('C', doc_id % 30)) AS recipientid,
           concat('TB', doc_id % 40) AS talkingbookid, concat('C', doc_id % 30) AS community, concat('title ', doc_id) AS metadata_title
           FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 2 = 0""", "recipients"),
    "uf_get_records": sql("FROM uf_messages", "uf_messages"),
    "uf_bundle": sql("SELECT programid, deploymentnumber, language, message_uuid, bundle_index FROM x_bundles", "x_bundles"),
    "uf_bundle_blocks": sql("SELECT programid, deploymentnumber, language, message_uuid, bundle_index FROM x_bundles", "x_bundles"),
    "uf_bundle_max_files": sql("SELECT programid, deploymentnumber, language, message_uuid, bundle_index FROM x_small_bundles", "x_small_bundles"),
    "uf_bundle_assign": sql(
        "SELECT programid, deploymentnumber, language, bundle_index, 1 AS ids, count(*) AS files FROM x_bundles GROUP BY ALL", "x_bundles"),
    "uf_bundle_regroup": sql(
        """SELECT programid, deploymentnumber, bundle_uuid, arg_min(language, message_uuid) AS language, count(*) AS files,
           CAST(sum(length_seconds) AS BIGINT) AS seconds, CAST(sum(length_bytes) AS BIGINT) AS bytes
           FROM uf_messages WHERE bundle_uuid IS NOT NULL GROUP BY ALL""", "uf_messages"),
    "uf_bundle_summary": sql(
        """SELECT *, CASE WHEN seconds >= 3600 THEN concat(seconds // 3600, ':', lpad(CAST(seconds % 3600 // 60 AS VARCHAR), 2, '0'), ':', lpad(CAST(seconds % 60 AS VARCHAR), 2, '0'))
                WHEN seconds >= 60 THEN concat(seconds // 60, ':', lpad(CAST(seconds % 60 AS VARCHAR), 2, '0')) ELSE concat(seconds, ' seconds') END AS total
           FROM (SELECT programid, deploymentnumber, bundle_uuid, arg_min(language, message_uuid) AS language, count(*) AS files,
           CAST(sum(length_seconds) AS BIGINT) AS seconds, CAST(sum(length_bytes) AS BIGINT) AS bytes
           FROM uf_messages WHERE bundle_uuid IS NOT NULL GROUP BY ALL)""", "uf_messages"),
    "uf_publish_manifest": sql(
        """SELECT programid, deploymentnumber, language, message_uuid, concat('collected/', programid, '/', deploymentnumber, '/', message_uuid, '.mp3') AS in_key,
           concat('root/deployment-', deploymentnumber, '/', arg_min(language, message_uuid) OVER (PARTITION BY programid, deploymentnumber, bundle_uuid), '/', bundle_uuid, '.zip') AS out_key FROM uf_messages WHERE bundle_uuid IS NOT NULL""", "uf_messages"),
    "uf_publish_manifest_flat": sql(
        """SELECT programid, deploymentnumber, language, message_uuid, concat('collected/', programid, '/', deploymentnumber, '/', message_uuid, '.mp3') AS in_key,
           concat('root/deployment-', deploymentnumber, '/', arg_min(language, message_uuid) OVER (PARTITION BY programid, deploymentnumber, bundle_uuid), '/', message_uuid, '.mp3') AS out_key FROM uf_messages WHERE bundle_uuid IS NOT NULL""", "uf_messages"),
}
ORACLE["order_by"] = ORACLE["production_by_category"]
ORACLE["sink_project_reports"] = ORACLE["production_by_package"].replace("SELECT m.project, m.deployment,", "SELECT m.project AS project_dir, m.project, m.deployment,", 1)
ORACLE["sink_project_reports"] = f"SELECT * FROM ({ORACLE['sink_project_reports']}) WHERE project IN (SELECT r_name FROM region WHERE r_regionkey >= 1)"
ORACLE["report_diff"] = sql(
    """, old_rows AS (SELECT project, deployment, deploymentnumber, startdate, enddate, package, recipientid, communityname,
           count(DISTINCT talkingbookid) AS n FROM x_depl GROUP BY ALL),
       new_rows AS (SELECT x.project, x.deployment, s.deploymentnumber, s.startdate, s.enddate, x.contentpackage AS package, x.recipientid, r.communityname,
           count(DISTINCT x.talkingbookid) AS n FROM tbsdeployed x JOIN recipients r USING (recipientid)
           LEFT JOIN deployments s ON s.project = x.project AND lower(s.deployment) = lower(x.deployment) WHERE NOT x.testing GROUP BY ALL)
       SELECT *, only_old = 0 AND only_new = 0 AS same FROM (
       SELECT 'deployments_by_community' AS report, (SELECT count(*) FROM (FROM old_rows EXCEPT ALL FROM new_rows)) AS only_old,
           (SELECT count(*) FROM (FROM new_rows EXCEPT ALL FROM old_rows)) AS only_new
       UNION ALL SELECT 'production_by_package', 0, 0)""", "x_depl", "tbsdeployed", "recipients", "deployments")
ORACLE["report_diff_stored"] = ORACLE["report_diff"]

_BASE_REPORTS = {name: sql(f"FROM {name}", name) for name in ("deployments", "recipients", "recipients_map", "tbsdeployed")}


def _run_rows() -> str:
    """Rows and columns of all reports of a run, those by project for active projects."""
    parts = []
    for name in PROJECT_REPORTS:
        body = _BASE_REPORTS.get(name) or ORACLE[name]
        parts.append(
            f"SELECT 'project' AS kind, '{name}' AS report, project, (SELECT count(*) FROM (DESCRIBE SELECT * FROM ({body}))) AS n_columns, count(*) AS n_rows"
            f" FROM ({body}) WHERE project IN (SELECT r_name FROM region WHERE r_regionkey >= 1) GROUP BY project"
        )
    for name in GLOBAL_REPORTS:
        parts.append(
            f"SELECT 'global', '{name}', NULL, (SELECT count(*) FROM (DESCRIBE SELECT * FROM ({ORACLE[name]}))), count(*) FROM ({ORACLE[name]}) HAVING count(*) > 0"
        )
    return "SELECT kind, report, project, CAST(n_columns AS INT) AS n_columns, n_rows FROM (" + " UNION ALL ".join(parts) + ")"


ORACLE["report_run"] = _run_rows()
