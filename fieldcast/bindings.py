"""Domain tables derived from the TPC-H-like test tables.

Each binding is SQL that Spark and DuckDB both run, so a mart and its check see the same
input.  ``{fan5}`` is the only dialect difference: a generator of 0..4.
Nothing here is needed in production, where these tables are stored as Parquet.
"""

from __future__ import annotations

import io
import zipfile
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from fieldcast.session import scratch_path, send_with_tasks
from fieldcast.tables import Tables

send_with_tasks(__name__)

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
FAN5 = {"spark": "explode(sequence(0, 4))", "duckdb": "unnest(range(0, 5))"}

#: the log line of a play
PLAY_LINE = """concat(CAST(timestamp AS STRING), ',play,project:', project, ',deployment:', deployment,
                      ',contentpackage:', contentpackage, ',community:', community, ',talkingbookid:', talkingbookid,
                      ',contentid:', contentid, ',started:', CAST(started AS STRING), ',quarter:', CAST(quarter AS STRING),
                      ',half:', CAST(half AS STRING), ',threequarters:', CAST(threequarters AS STRING),
                      ',completed:', CAST(completed AS STRING), ',played_seconds:', CAST(played_seconds AS STRING),
                      ',tbcdid:', tbcdid, ',deployment_timestamp:', CAST(deployment_timestamp AS STRING),
                      CASE WHEN recipientid IS NULL THEN '' ELSE concat(',recipientid:', recipientid) END,
                      ',deployment_uuid:', deployment_uuid)"""

#: name -> (tables it reads, SQL)
BINDINGS: dict[str, tuple[tuple[str, ...], str]] = {
    "ord": (
        ("orders", "customer", "nation", "region"),
        """
        SELECT o_orderkey AS okey, o_custkey AS ckey, o_orderstatus AS status, o_orderdate AS odate,
               r_name AS project, c_mktsegment AS seg, lower(substring(c_mktsegment, 1, 2)) AS lc,
               CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q,
               CAST((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) AS INT) AS num,
               concat(r_name, '-', CAST(year(o_orderdate) AS STRING), '-', CAST(quarter(o_orderdate) AS STRING)) AS dep
        FROM orders JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        """,
    ),
    "projects": (
        ("region",),
        "SELECT r_name AS projectcode, concat('Program ', r_name) AS project, r_regionkey - 1 AS id FROM region",
    ),
    "recipients": (
        ("customer", "nation", "region"),
        """
        SELECT concat('r', CAST(c_custkey AS STRING)) AS recipientid, r_name AS project, c_mktsegment AS partner,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('A', CAST(c_custkey % 7 AS STRING)) END AS affiliate,
               n_name AS country, r_name AS region,
               concat('D', CAST(c_custkey % 20 AS STRING)) AS district,
               concat('C', CAST(c_custkey % 300 AS STRING)) AS communityname,
               concat('G', CAST(c_custkey % 3 AS STRING)) AS groupname,
               CASE WHEN c_custkey % 5 = 0 THEN concat('agent', CAST(c_custkey % 11 AS STRING)) ELSE NULL END AS agent,
               lower(substring(c_mktsegment, 1, 2)) AS language,
               concat('S', CAST(c_custkey % 4 AS STRING)) AS supportentity,
               CASE WHEN c_custkey % 2 = 0 THEN 'Group' ELSE 'Household' END AS listening_model
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        """,
    ),
    "recipients_map": (
        ("recipients",),
        "SELECT project, concat(communityname, ' - ', groupname) AS directory, min(recipientid) AS recipientid "
        "FROM recipients GROUP BY project, communityname, groupname",
    ),
    "communities": (
        ("customer", "nation", "region"),
        """
        SELECT DISTINCT concat('C', CAST(c_custkey % 300 AS STRING)) AS communityname, r_name AS project
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        WHERE r_regionkey = (c_custkey % 300) % 5 OR (c_custkey % 300 % 10 = 0 AND r_regionkey = 0)
        """,
    ),
    "quarters": (
        ("ord",),
        "SELECT DISTINCT project, dep, num, make_date(y, (q - 1) * 3 + 1, 1) AS d0, "
        "last_day(make_date(y, q * 3, 1)) AS d1, make_date(y, (q - 1) * 3 + 1, 8) AS d8 FROM ord",
    ),
    "deployments": (
        ("quarters",),
        """
        SELECT project, dep AS deployment, num AS deploymentnumber,
               CASE WHEN num % 13 = 0 THEN NULL ELSE d0 END AS startdate, d1 AS enddate,
               concat('Deployment ', CAST(num AS STRING)) AS deploymentname,
               CASE WHEN num % 2 = 0 THEN 'A' ELSE 'B' END AS component
        FROM quarters
        UNION ALL
        SELECT project, concat(dep, '-B'), num, d8, d1, concat('Deployment ', CAST(num AS STRING), ' B'), 'B'
        FROM quarters WHERE num % 9 = 0
        """,
    ),
    "languages": (
        ("customer", "nation", "region"),
        """
        SELECT DISTINCT lower(substring(c_mktsegment, 1, 2)) AS languagecode, c_mktsegment AS language,
               r_name AS projectcode
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
        """,
    ),
    "packagesindeployment": (
        ("quarters", "languages"),
        """
        SELECT project, dep AS deployment, concat(dep, '-', languagecode) AS contentpackage,
               concat('Package ', dep, ' ', languagecode) AS packagename, d0 AS startdate, d1 AS enddate,
               upper(languagecode) AS languagecode
        FROM quarters JOIN languages ON projectcode = project
        UNION ALL
        SELECT project, concat(dep, '-B'), concat(dep, '-bu'), concat('Package ', dep, ' B'), d8, d1, 'BU'
        FROM quarters WHERE num % 9 = 0
        """,
    ),
    "tbsdeployed": (
        ("ord",),
        """
        SELECT concat('TB', CAST(okey % 400 AS STRING)) AS talkingbookid, concat('r', CAST(ckey AS STRING)) AS recipientid,
               odate AS deployedtimestamp, project,
               CASE WHEN okey % 10 = 0 THEN lower(dep) ELSE dep END AS deployment,
               concat(dep, '-', lc) AS contentpackage, concat('r12', CAST(okey % 3 AS STRING)) AS firmware,
               concat('L', CAST(ckey % 5 AS STRING)) AS location,
               concat('user', CAST(ckey % 9 AS STRING)) AS username,
               concat('tbcd', CAST(ckey % 50 AS STRING)) AS tbcdid,
               CASE WHEN okey % 4 = 0 THEN 'update-fw' ELSE 'update' END AS action,
               status = 'F' AS newsn, okey % 17 = 0 AS testing
        FROM ord
        """,
    ),
    "tbdataoperations": (
        ("ord",),
        """
        SELECT CASE WHEN okey % 13 = 0 THEN '' WHEN okey % 17 = 0 THEN '-- TO BE ASSIGNED --'
                    ELSE concat('B-', CAST(okey % 400 AS STRING)) END AS outsn,
               concat(CAST(y AS STRING), 'Y', substring(CAST(odate AS STRING), 6, 2), 'M',
                      substring(CAST(odate AS STRING), 9, 2), 'D', lpad(CAST(okey % 24 AS STRING), 2, '0'), 'h',
                      lpad(CAST(okey % 60 AS STRING), 2, '0'), 'm', lpad(CAST(okey % 59 AS STRING), 2, '0'), 's') AS updatedatetime,
               project, dep AS outdeployment, lower(concat(dep, '-', lc)) AS outimage,
               lower(concat(dep, '-', lc)) AS inimage,
               CASE WHEN ckey % 19 = 0 THEN 'Non-Specific'
                    ELSE concat('C', CAST(ckey % 300 AS STRING), ' - g', CAST(ckey % 3 AS STRING)) END AS outcommunity,
               CASE WHEN okey % 5 = 0 THEN '' ELSE 'r1212' END AS outfwrev,
               CASE WHEN okey % 3 = 0 THEN '' ELSE concat('d/', lpad(CAST(ckey AS STRING), 6, '0')) END AS outsyncdir,
               concat('L', CAST(ckey % 5 AS STRING)) AS location,
               CASE WHEN okey % 4 = 0 THEN 'Update-FW' WHEN okey % 4 = 1 THEN 'stats only' ELSE 'update' END AS action
        FROM ord
        """,
    ),
    "contentmetadata2": (
        ("part", "region"),
        """
        SELECT concat('P', CAST(p_partkey AS STRING)) AS contentid, r_name AS project,
               concat(p_name, ' ', CAST(p_partkey AS STRING)) AS title,
               CASE p_partkey % 5 WHEN 0 THEN 'au' WHEN 1 THEN 'bu' WHEN 2 THEN 'fu' WHEN 3 THEN 'ho' ELSE 'ma' END AS languagecode,
               p_size * 7 AS duration_sec, p_type AS format,
               CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('SDG', CAST(p_partkey % 17 AS STRING)) END AS sdg_goals,
               concat('T', CAST(p_partkey % 9 AS STRING)) AS sdg_targets,
               concat('src', CAST(p_partkey % 3 AS STRING)) AS source, p_name AS keywords, p_brand AS categories,
               CAST(NULL AS STRING) AS transcriptionurl, concat('note ', CAST(p_size AS STRING)) AS notes
        FROM (SELECT p_partkey, p_name, p_brand, p_type, p_size, {fan5} AS rk FROM part) p
        JOIN region ON r_regionkey = rk
        """,
    ),
    "categories": (
        ("part", "region"),
        """
        SELECT b AS categoryid, r_name AS projectcode,
               CASE WHEN TRY_CAST(substring(b, 7) AS INT) % 4 = 0 THEN concat('General-', b) ELSE concat('Topic ', b) END AS categoryname
        FROM (SELECT p_brand AS b, {fan5} AS rk FROM (SELECT DISTINCT p_brand FROM part) x) p
        JOIN region ON r_regionkey = rk
        WHERE TRY_CAST(substring(b, 7) AS INT) % 5 <> 0
        """,
    ),
    "contentinpackage": (
        ("lineitem", "ord", "part"),
        """
        SELECT project, upper(concat(dep, '-', lc)) AS contentpackage, concat('P', CAST(l_partkey AS STRING)) AS contentid,
               CASE WHEN TRY_CAST(substring(p_brand, 7) AS INT) % 5 = 0 THEN concat('P', CAST(l_partkey AS STRING)) ELSE p_brand END AS categoryid,
               min(l_linenumber) AS position
        FROM lineitem JOIN ord ON okey = l_orderkey JOIN part ON p_partkey = l_partkey
        GROUP BY project, dep, lc, l_partkey, p_brand
        """,
    ),
    "playstatistics": (
        ("lineitem", "ord"),
        """
        SELECT l_shipdate AS timestamp, project, dep AS deployment, concat(dep, '-', lc) AS contentpackage,
               concat('C', CAST(ckey % 300 AS STRING)) AS community, concat('TB', CAST(l_suppkey AS STRING)) AS talkingbookid,
               concat('P', CAST(l_partkey AS STRING)) AS contentid,
               CAST(l_quantity AS INT) + 4 AS started, CAST(l_quantity AS INT) + 3 AS quarter,
               CAST(l_quantity AS INT) + 2 AS half, CAST(l_quantity AS INT) + 1 AS threequarters,
               CAST(l_quantity AS INT) AS completed, CAST(floor(l_extendedprice) AS INT) AS played_seconds,
               concat('tbcd', CAST(l_linenumber AS STRING)) AS tbcdid, odate AS deployment_timestamp,
               concat('u', CAST(okey AS STRING)) AS deployment_uuid,
               CASE WHEN ckey % 97 = 0 THEN NULL ELSE concat('r', CAST(ckey AS STRING)) END AS recipientid
        FROM lineitem JOIN ord ON okey = l_orderkey
        """,
    ),
    "syncaggregation": (
        ("lineitem", "ord"),
        """
        SELECT upper(concat(dep, '-', lc)) AS contentpackage, concat('C', CAST(ckey % 300 AS STRING)) AS village,
               concat('TB', CAST(l_suppkey AS STRING)) AS talkingbook, concat('P', CAST(l_partkey AS STRING)) AS contentid,
               l_linenumber % 3 + 1 AS datasource,
               CAST(sum(CAST(l_quantity AS INT)) AS INT) AS countcompleted,
               CAST(sum(CAST(l_quantity AS INT) + 9) AS INT) AS countstarted,
               CAST(sum(CAST(l_quantity AS INT) % 7) AS INT) AS countquarter,
               CAST(sum(CAST(l_quantity AS INT) % 5) AS INT) AS counthalf,
               CAST(sum(CAST(l_quantity AS INT) % 3) AS INT) AS countthreequarters,
               CAST(sum(CAST(floor(l_extendedprice) AS INT)) AS INT) AS totaltimeplayed
        FROM lineitem JOIN ord ON okey = l_orderkey
        GROUP BY dep, lc, ckey % 300, l_suppkey, l_partkey, l_linenumber % 3
        """,
    ),
    "playedevents": (
        ("events",),
        """
        SELECT concat('PK', CAST(user_id % 5 AS STRING)) AS packageid, concat('C', CAST(user_id AS STRING)) AS village,
               concat('TB', CAST(user_id % 40 AS STRING)) AS talkingbookid,
               CASE WHEN event_id % 50 = 0 THEN 'dga' ELSE concat('P', CAST(event_id % 200 AS STRING)) END AS contentid,
               CAST(60 + event_id % 240 AS INT) AS totaltime,
               CAST((event_id * 7919) % 1000 AS DOUBLE) / 1000.0E0 AS percentdone,
               CAST(((60 + event_id % 240) * ((event_id * 7919) % 1000)
                     - ((60 + event_id % 240) * ((event_id * 7919) % 1000)) % 1000) / 1000 AS INT) AS timeplayed,
               event_type = 'purchase' AS isfinished
        FROM events
        """,
    ),
    "uf_messages": (
        ("documents",),
        """
        SELECT md5(CAST(doc_id AS STRING)) AS message_uuid, concat('PROG', CAST(doc_id % 2 AS STRING)) AS programid,
               CAST(doc_id % 3 AS INT) AS deploymentnumber, lang AS language,
               n_chars AS length_bytes, CAST(floor(n_chars / 16.0) AS INT) AS length_seconds,
               CASE WHEN doc_id % 11 = 0 THEN concat('b', CAST(doc_id % 44 AS STRING)) ELSE NULL END AS bundle_uuid
        FROM documents
        """,
    ),
    "collected_uuids": (
        ("documents",),
        """
        SELECT md5(CAST(doc_id AS STRING)) AS uuid,
               concat('collected/PROG', CAST(doc_id % 2 AS STRING), '/', CAST(doc_id % 3 AS STRING), '/', md5(CAST(doc_id AS STRING))) AS url
        FROM documents WHERE doc_id % 13 <> 0
        UNION ALL
        SELECT md5(concat('x', CAST(doc_id AS STRING))), concat('collected/PROG0/0/', md5(concat('x', CAST(doc_id AS STRING))))
        FROM documents WHERE doc_id % 29 = 0
        """,
    ),
    "kv_lines": (
        ("events",),
        """
        SELECT concat('f', CAST(event_id % 3 AS STRING), '.kvp') AS file, event_id AS line_no,
               CASE WHEN event_id % 41 = 0 THEN ''
                    WHEN event_id % 37 = 0 THEN concat('t', CAST(event_id AS STRING), ',short')
                    ELSE concat('t', CAST(event_id AS STRING), ',op', CAST(event_id % 2 AS STRING),
                                ',user:', CAST(user_id AS STRING), ',type:', event_type,
                                CASE WHEN event_id % 3 = 0 THEN concat(',ratio:1:', CAST(event_id % 9 AS STRING)) ELSE '' END,
                                CASE WHEN event_id % 5 = 0 THEN ',optional' ELSE '' END,
                                CASE WHEN event_id % 7 = 0 THEN ',user:again' ELSE '' END,
                                ',project:proj', CAST(user_id % 4 AS STRING),
                                ',community:dir ', CAST(user_id % 6 AS STRING),
                                CASE WHEN event_id % 11 = 0 THEN ',recipientid:' ELSE '' END) END AS value
        FROM events
        """,
    ),
    "play_lines": (
        ("playstatistics",),
        """
        SELECT tbcdid, deployment_uuid, contentid, played_seconds, completed,
               """ + PLAY_LINE + """ AS value
        FROM playstatistics
        """,
    ),
    "kv_recipients_map": (
        ("events",),
        "SELECT DISTINCT concat('Proj', CAST(user_id % 4 AS STRING)) AS project, concat('Dir ', CAST(user_id % 6 AS STRING)) AS directory, "
        "concat('rec', CAST(user_id % 4 AS STRING), CAST(user_id % 6 AS STRING)) AS recipientid "
        "FROM events WHERE user_id % 4 <> 3 AND user_id % 6 <> 5",
    ),
    "deployment_lines": (
        ("ord",),
        """
        SELECT 'd.log' AS file, okey AS line_no,
               concat(substring(CAST(odate AS STRING), 1, 10), 'T10:01:04.720,deployment,elapsedTime:0,action:update,tbcdid:',
                      lpad(CAST(ckey % 50 AS STRING), 4, '0'),
                      CASE WHEN okey % 23 = 0 THEN ',username:' ELSE concat(',username:user', CAST(ckey % 9 AS STRING)) END,
                      ',project:', project, ',deployment:', dep, ',package:', dep, '-', lc,
                      ',community:', CASE WHEN okey % 29 = 0 THEN 'non-specific' ELSE concat('C', CAST(ckey % 310 AS STRING), ' - G', CAST(ckey % 3 AS STRING)) END,
                      CASE WHEN okey % 31 = 0 THEN '' ELSE concat(',sn:B-', lpad(CAST(okey % 400 AS STRING), 8, '0')) END,
                      ',firmware:r1212,location:L', CAST(ckey % 5 AS STRING),
                      ',timestamp:', replace(substring(CAST(odate AS STRING), 1, 10), '-', ''), 'T', lpad(CAST(okey % 24 AS STRING), 2, '0'), '0005.486Z,duration:59',
                      CASE WHEN okey % 4 = 0 THEN concat(',coordinates:', CAST(okey % 90 AS STRING), '.5 -', CAST(ckey % 180 AS STRING)) ELSE '' END,
                      CASE WHEN okey % 6 = 0 THEN ',newsn:t' ELSE '' END) AS value
        FROM ord
        """,
    ),
    "uf_props": (
        ("documents", "recipients"),
        """
        SELECT concat('/uf/PROG', CAST(doc_id % 2 AS STRING), '/C', CAST(doc_id % 30 AS STRING), '/m', CAST(doc_id AS STRING), '.properties') AS path,
               doc_id,
               concat('# made for ', lang, chr(10), 'PROJECT=PROG', CAST(doc_id % 2 AS STRING), chr(10),
                      'DEPLOYMENT_NUMBER=', CAST(doc_id % 3 AS STRING), chr(10),
                      'RECIPIENTID=r', CAST(doc_id % 150 AS STRING), chr(10), 'TALKINGBOOKID=TB', CAST(doc_id % 40 AS STRING), chr(10),
                      CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('TIMESTAMP=2021', lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0'), '05', chr(10)) END,
                      CASE WHEN doc_id % 6 = 0 THEN concat('collection.USEREMAIL=u', CAST(doc_id % 5 AS STRING), '@x.org', chr(10)) ELSE '' END,
                      'collection.USERNAME=name=', CAST(doc_id % 5 AS STRING), chr(10),
                      'metadata.SECONDS=', CAST(n_chars % 400 AS STRING), chr(10), 'metadata.BYTES=', CAST(n_chars AS STRING), chr(10),
                      'metadata.LANGUAGE=', upper(lang), chr(10),
                      'metadata.DATE_RECORDED=', CASE WHEN doc_id % 5 = 0 THEN 'garbage' ELSE concat('2021/', lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0'), '/09') END, chr(10),
                      CASE WHEN doc_id % 17 = 0 THEN '' ELSE concat('metadata.MESSAGE_UUID=', md5(CAST(doc_id AS STRING)), chr(10)) END,
                      'no equals sign', chr(10)) AS value
        FROM documents
        """,
    ),
    "listing_lines": (
        ("documents",),
        """
        SELECT concat('2021-06-01 12:11:38 ', lpad(CAST(n_chars AS STRING), 10, ' '), ' collected/PROG', CAST(doc_id % 2 AS STRING), '/',
                      CAST(doc_id % 3 AS STRING), '/', md5(CAST(doc_id AS STRING)),
                      CASE WHEN doc_id % 3 = 0 THEN '.properties' ELSE '.mp3' END) AS value
        FROM documents
        """,
    ),
}


#: small tables: worked out once for a set of tables and stored, so that nothing scans the orders, customers or parts again for
#: them and Spark knows their size, as it does in production (it cannot know that of a DISTINCT, and shuffles what meets it)
SMALL = ("quarters", "languages", "communities", "categories", "packagesindeployment")

_PACKAGE_NAMES = "SELECT concat(dep, '-', languagecode) AS contentpackage FROM quarters JOIN languages ON projectcode = project"
#: where every name of a pattern column occurs (and perhaps others), for tables that take a shuffle of the facts to make; ids that
#: are a letter and a number need no place
NAMES: dict[str, tuple[tuple[str, ...], str]] = {
    "tbsdeployed": (("quarters",), "SELECT dep AS deployment FROM quarters"),
    "playstatistics": (("quarters", "languages"), _PACKAGE_NAMES),
    "contentinpackage": (
        ("quarters", "languages", "part"),
        "SELECT contentpackage, CAST(NULL AS STRING) AS contentid, CAST(NULL AS STRING) AS categoryid FROM (" + _PACKAGE_NAMES + ") "
        "UNION ALL SELECT NULL, NULL, p_brand FROM part",
    ),
}


def _le(value: str, size: int) -> str:
    """SQL for a whole number as little-endian bytes in hex."""
    digits = f"lpad(hex({value}), {size * 2}, '0')"
    return "concat(" + ", ".join(f"substring({digits}, {i * 2 + 1}, 2)" for i in range(size - 1, -1, -1)) + ")"


def _text_field(number: int, *values: str) -> str:
    """SQL for one text field of an audio file's metadata, in hex."""
    body = ", ".join(f"{_le(f'octet_length({v})', 2)}, hex(encode({v}, 'UTF-8'))" for v in values)
    length = " + ".join(["1", *[f"2 + octet_length({v})" for v in values]])
    return f"concat({_le(str(number), 2)}, {_le(length, 4)}, {_le(str(len(values)), 1)}, {body})"


def a18_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audio file with metadata for every document, put together byte by byte in SQL."""
    fields = [
        _text_field(1, "concat('title ', doc_id)"),
        _text_field(12, "lang"),
        _text_field(26, "lang", "source"),
        f"concat({_le('99', 2)}, {_le('3', 4)}, '010203')",
        f"concat({_le('33', 2)}, {_le('5', 4)}, '01', {_le('doc_id % 100', 4)})",
        _text_field(5, "concat('TB', doc_id % 40)"),
    ]
    version = _le("CASE WHEN doc_id % 19 = 0 THEN 2 ELSE 1 END", 4)
    content = (
        f"concat({_le('n_chars * 2 + 2', 4)}, {_le('CASE WHEN doc_id % 2 = 0 THEN 16000 ELSE 64 END', 2)}, "
        f"repeat('00', CAST(n_chars * 2 AS INT)), {version}, {_le(str(len(fields)), 4)}, {', '.join(fields)})"
    )
    return spark.sql(
        f"SELECT doc_id, concat('/uf/PROG', doc_id % 2, '/C', doc_id % 30, '/m', doc_id, '.a18') AS path, "
        f"unhex({content}) AS content FROM {{documents}}",
        documents=spark.read.parquet(f"{sf_dir}/documents.parquet"),
    )


def _zip_one(batches):
    for batch in batches:
        out = []
        for path, number in zip(batch["path"], batch["doc_id"]):
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w") as archive:
                archive.writestr("x/tbsdeployed.csv", f"talkingbookid,action\nTB{number % 40},update\nTB{number},last\n")
                archive.writestr("x/stats_collected.properties", f"user=u{number % 9}\n")
                archive.writestr("x/other.txt", "not wanted\n")
            out.append((path, buffer.getvalue()))
        yield pd.DataFrame(out, columns=["path", "content"])


def zip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loader zip for every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.selectExpr("doc_id", "concat('/in/', doc_id, '/tbcd', doc_id % 50, '.zip') AS path").mapInPandas(
        _zip_one, "path string, content binary"
    )


def _closure(names: list[str], without: tuple[str, ...] = ()) -> list[str]:
    """The bindings needed for ``names``, each after the ones it reads; not those in ``without`` nor what only they need."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BINDINGS and name not in order and name not in without:
            for needed in BINDINGS[name][0]:
                visit(needed)
            order.append(name)

    for name in names:
        visit(name)
    return order


def duckdb_with(*names: str) -> str:
    """A ``WITH`` clause that defines the named domain tables over the base views."""
    parts = [f"{n} AS ({BINDINGS[n][1].replace('{fan5}', FAN5['duckdb'])})" for n in _closure(list(names))]
    return "WITH " + ",\n".join(parts)


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE}


class _Bindings:
    """The domain tables over the Parquet files in ``sf_dir``; the small ones are stored when they are first needed."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._stored: dict[str, DataFrame] = {}

    def _source(self, name: str) -> DataFrame:
        if name not in BINDINGS:
            return self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
        if name not in self._stored:
            path = scratch_path(self._spark, f"small-{name}")
            self._select(*BINDINGS[name]).write.parquet(path)
            self._stored[name] = self._spark.read.parquet(path)
        return self._stored[name]

    def _select(self, needed: tuple[str, ...], sql: str) -> DataFrame:
        order = _closure(list(needed), SMALL)
        sources = sorted({*needed, *(t for n in order for t in BINDINGS[n][0])} - set(order))
        heads = [f"{t} AS (SELECT * FROM {{src_{t}}})" for t in sources]
        ctes = [f"{n} AS ({BINDINGS[n][1].replace('{fan5}', FAN5['spark'])})" for n in order]
        frames = {f"src_{t}": self._source(t) for t in sources}
        return self._spark.sql(f"WITH {', '.join(heads + ctes)} {sql.replace('{fan5}', FAN5['spark'])}", **frames)

    def table(self, name: str) -> DataFrame:
        return self._source(name) if name in SMALL else self._select((name,), f"SELECT * FROM {name}")

    def names(self, name: str) -> DataFrame:
        return self._select(*NAMES[name])


_FLAGS: dict[tuple[str, str], dict] = {}


def domain_tables(spark: SparkSession, sf_dir: str, **overrides: DataFrame) -> Tables:
    """Every domain table as a lazy frame over the Parquet files in ``sf_dir``."""
    bound = _Bindings(spark, sf_dir)
    frames = {name: partial(bound.table, name) for name in BINDINGS}
    names = {name: partial(bound.names, name) for name in NAMES if name not in overrides}
    flags = _FLAGS.setdefault((spark.sparkContext.applicationId, sf_dir), {})
    if overrides:
        flags = {k: v for k, v in flags.items() if k not in overrides}
    return Tables({**frames, **overrides}, flags, names)


def stored_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> Tables:
    """Domain tables written to Parquet in the shared folder, as they are stored in production."""
    root = scratch_path(spark, "tables")
    lazy = domain_tables(spark, sf_dir)
    files = spark.sparkContext.defaultParallelism
    for name in names:
        lazy[name].repartition(files).write.parquet(f"{root}/{name}")
    return Tables({name: spark.read.parquet(f"{root}/{name}") for name in names})
