"""The engine's table shapes, derived from the driver's star schema by SQL that Spark and DuckDB both read.

One text serves both, so a query and its oracle start from the same rows. {name} stands for a base table.
"""

from __future__ import annotations

import re
from collections.abc import Container, Mapping

from pyspark.sql import DataFrame, SparkSession

_ID = "lpad(CAST({0} AS STRING), 10, '0')"
_V = _ID.format("user_id")

SHAPES = {
    "spine": "SELECT DISTINCT CAST(ts AS DATE) AS extract_date FROM {events}",
    "users": "SELECT DISTINCT user_id FROM {events} WHERE user_id IS NOT NULL",
    # Raw tables, all text.
    "b_lfa1": f"""SELECT d.extract_date, {_V} AS LIFNR,
        CASE WHEN user_id % 29 = 1 THEN 'CPD' WHEN user_id % 13 = 0 THEN 'ZEMP' ELSE 'KRED' END AS KTOKK,
        concat('Vendor ', CAST(user_id % 97 AS STRING)) AS NAME1, concat('A', {_V}) AS ADRNR, '' AS STCD2,
        CASE WHEN user_id % 17 = 3 THEN 'X' ELSE '' END AS SPERR,
        CASE WHEN user_id % 19 = 4 AND day(d.extract_date) > 10 THEN 'X' ELSE '' END AS SPERZ,
        CASE WHEN user_id % 7 = 0 THEN 'X' ELSE '' END AS SPERM, CASE WHEN user_id % 23 = 5 THEN 'X' ELSE '' END AS LOEVM,
        CASE WHEN user_id % 29 = 1 THEN 'X' ELSE '' END AS XCPDK,
        CASE WHEN user_id % 31 = 2 THEN {_ID.format('user_id + 1')} ELSE '' END AS LNRZA, CASE WHEN user_id % 37 = 3 THEN 'X' ELSE '' END AS XZEMP,
        CASE WHEN user_id % 11 = 6 AND day(d.extract_date) BETWEEN 5 AND 20 THEN '1' WHEN user_id % 53 = 8 THEN '9' ELSE '' END AS CONFS,
        CASE WHEN user_id % 47 = 9 THEN '00000000' WHEN user_id % 5 = 0 THEN '20210615' ELSE '20231101' END AS ERDAT
        FROM users CROSS JOIN spine d""",
    "b_link": f"SELECT d.extract_date, concat('G', {_V}) AS PARTNER_GUID, {_V} AS VENDOR FROM users CROSS JOIN spine d WHERE user_id % 41 <> 7",
    "b_but000": f"SELECT d.extract_date, concat('G', {_V}) AS PARTNER_GUID, concat('P', {_V}) AS PARTNER, concat('Org ', CAST(user_id AS STRING)) AS NAME_ORG1 FROM users CROSS JOIN spine d WHERE user_id % 43 <> 8",
    "b_adrc": f"""SELECT d.extract_date, concat('A', {_V}) AS ADDRNUMBER, n.NATION, 'Name' AS NAME1, CASE WHEN user_id % 8 = 0 THEN '' ELSE concat(CAST(user_id AS STRING), ' Main St.') END AS STREET,
        CASE WHEN user_id % 8 = 0 THEN CAST(user_id AS STRING) ELSE '' END AS PO_BOX, 'Town' AS CITY1, CASE WHEN user_id % 61 = 10 THEN '12' ELSE lpad(CAST(10000 + user_id AS STRING), 5, '0') END AS POST_CODE1,
        'VA' AS REGION, CASE WHEN user_id % 59 = 11 THEN 'CA' ELSE 'US' END AS COUNTRY
        FROM users CROSS JOIN spine d CROSS JOIN (SELECT '' AS NATION UNION ALL SELECT 'I' AS NATION) n""",
    "b_lfb1": f"""SELECT d.extract_date, {_V} AS LIFNR, c.BUKRS, '160000' AS AKONT,
        CASE user_id % 5 WHEN 0 THEN 'NT30' WHEN 1 THEN 'NT45' WHEN 2 THEN 'NT60' WHEN 3 THEN '0001' ELSE 'XX99' END AS ZTERM, 'T' AS ZWELS, '' AS ZAHLS, '' AS SPERR, '' AS LOEVM,
        CASE WHEN user_id % 13 = 1 AND c.BUKRS = '1000' THEN '' ELSE 'X' END AS REPRF, CASE WHEN user_id % 43 = 5 AND c.BUKRS = '2000' THEN {_ID.format('user_id + 2')} ELSE '' END AS LNRZB,
        CASE WHEN user_id % 13 = 0 THEN lpad(CAST(user_id AS STRING), 8, '0') ELSE '' END AS PERNR, CASE WHEN user_id % 9 = 2 AND c.BUKRS = '1000' AND day(d.extract_date) > 12 THEN '2' ELSE '' END AS CONFS, '20220101' AS ERDAT
        FROM users CROSS JOIN spine d CROSS JOIN (SELECT '1000' AS BUKRS UNION ALL SELECT '2000' AS BUKRS) c""",
    "b_lfbk": f"""SELECT d.extract_date, {_V} AS LIFNR, CASE WHEN user_id % 67 = 12 THEN 'CA' ELSE 'US' END AS BANKS, CASE WHEN user_id % 71 = 13 THEN '12345678' ELSE '121000358' END AS BANKL,
        CASE WHEN user_id % 50 = 9 THEN '' ELSE lpad(CAST(user_id % 110 AS STRING), 8, '0') END AS BANKN, '' AS KOINH, '' AS BVTYP FROM users CROSS JOIN spine d""",
    "b_but0bk": f"""SELECT d.extract_date, concat('P', {_V}) AS PARTNER, '0001' AS BKVID, 'US' AS BANKS, '121000358' AS BANKL, CAST(user_id AS STRING) AS BANKN, '' AS IBAN, '' AS KOINH,
        CASE WHEN user_id % 4 = 0 THEN '20240115000000' ELSE '20200101000000' END AS BK_VALID_FROM, CASE WHEN user_id % 6 = 1 THEN '20240120235959' WHEN user_id % 77 = 14 THEN '20190101000000' ELSE '99991231235959' END AS BK_VALID_TO
        FROM users CROSS JOIN spine d""",
    # Each line comes once, and again when it is cleared; ledger 2L and offset lines are noise.
    "b_acdoca": f"""SELECT e.extract_date, l.RLDNR, e.RBUKRS, '2024' AS GJAHR, e.BELNR, '000001' AS DOCLN, l.KOART, e.LIFNR, e.BLART, e.BUDAT, e.NETDT, e.HSL, 'USD' AS RHCUR, e.AUGBL, e.AUGDT FROM (
        SELECT first_date AS extract_date, RBUKRS, BELNR, LIFNR, BLART, BUDAT, NETDT, HSL, '' AS AUGBL, '00000000' AS AUGDT FROM b_events
        UNION ALL SELECT first_date + gap AS extract_date, RBUKRS, BELNR, LIFNR, BLART, BUDAT, NETDT, HSL, concat('C', BELNR) AS AUGBL, BUDAT AS AUGDT FROM b_events WHERE gap > 0) e
        CROSS JOIN (SELECT '0L' AS RLDNR, 'K' AS KOART UNION ALL SELECT '2L' AS RLDNR, 'K' AS KOART UNION ALL SELECT '0L' AS RLDNR, 'S' AS KOART) l""",
    "b_events": """SELECT CASE WHEN event_id % 3 = 0 THEN '1000' ELSE '2000' END AS RBUKRS, lpad(CAST(event_id AS STRING), 10, '0') AS BELNR, lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR,
        CASE WHEN event_type = 'error' THEN 'ZZ' WHEN event_type = 'view' THEN 'KR' ELSE 'KZ' END AS BLART,
        replace(CAST(CAST(ts AS DATE) - CAST(CASE WHEN user_id % 6 = 0 THEN 600 ELSE 0 END AS INT) AS STRING), '-', '') AS BUDAT,
        replace(CAST(CAST(ts AS DATE) + CAST(event_id % 20 AS INT) AS STRING), '-', '') AS NETDT,
        CASE WHEN event_id % 201 = 0 THEN 'n/a' ELSE CAST(CAST(CASE WHEN event_type = 'view' THEN -value ELSE value END AS DECIMAL(23,2)) AS STRING) END AS HSL,
        CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS first_date, CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 10 + 1 END AS INT) AS gap
        FROM {events} WHERE event_type IN ('view', 'purchase') OR (event_type = 'error' AND event_id % 9 = 0)""",
    # Change feeds.
    "bank_feed": """SELECT lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR, 'US' AS BANKS, '121000358' AS BANKL, CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 4 AS STRING) AS BANKN, ts AS change_ts,
        lpad(CAST(event_id AS STRING), 10, '0') AS CHANGENR, CASE WHEN event_id % 10 = 0 THEN 'initial_load' ELSE 'CDPOS' END AS source, concat('U', CAST(event_id % 7 AS STRING)) AS changed_by
        FROM {events} WHERE event_type = 'signup'""",
    "controls_feed": """SELECT lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR, CASE WHEN event_type = 'click' THEN CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 2 AS STRING) END AS A,
        CASE WHEN event_type = 'view' THEN CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 3 AS STRING) END AS B, ts AS change_ts, lpad(CAST(event_id AS STRING), 10, '0') AS CHANGENR
        FROM {events} WHERE event_type IN ('click', 'view')""",
    "b_matches": """SELECT lpad(CAST(a.user_id AS STRING), 10, '0') AS LIFNR_A, lpad(CAST(b.user_id AS STRING), 10, '0') AS LIFNR_B, CAST(85.3 AS DOUBLE) + a.user_id % 13 AS score,
        CAST(80.0 AS DOUBLE) + a.user_id % 20 AS name_score, CAST(70.0 AS DOUBLE) + b.user_id % 30 AS address_score, a.user_id % 13 >= 6 AS above_threshold
        FROM users a JOIN users b ON a.user_id % 50 = b.user_id % 50 AND a.user_id < b.user_id""",
    # Change documents: headers, some of them delivered twice, and items, some of them without a header.
    "b_cdhdr": """SELECT 'KRED' AS OBJECTCLAS, lpad(CAST(user_id AS STRING), 10, '0') AS OBJECTID, lpad(CAST(event_id AS STRING), 10, '0') AS CHANGENR, concat('U', CAST(event_id % 7 AS STRING)) AS USERNAME,
        replace(CAST(CAST(ts AS DATE) AS STRING), '-', '') AS UDATE, concat(lpad(CAST(hour(ts) AS STRING), 2, '0'), lpad(CAST(minute(ts) AS STRING), 2, '0'), lpad(CAST(event_id % 60 AS STRING), 2, '0')) AS UTIME
        FROM {events} CROSS JOIN (SELECT 1 AS again UNION ALL SELECT 2 AS again) a WHERE event_type IN ('signup', 'click', 'view') AND event_id % 17 <> 3 AND (a.again = 1 OR event_id % 5 = 0)""",
    "b_cdpos": """SELECT CASE WHEN event_id % 23 = 0 THEN 'BUPA' ELSE 'KRED' END AS OBJECTCLAS, lpad(CAST(user_id AS STRING), 10, '0') AS OBJECTID, lpad(CAST(event_id AS STRING), 10, '0') AS CHANGENR,
        CASE event_type WHEN 'signup' THEN 'LFBK' WHEN 'click' THEN 'LFA1' ELSE 'LFB1' END AS TABNAME,
        concat('100', lpad(CAST(user_id AS STRING), 10, '0'), CASE event_type WHEN 'signup' THEN concat(rpad('US', 3, ' '), rpad('121000358', 15, ' '), rpad(concat('ACC ', CAST(event_id % 9 + h.half AS STRING)), 18, ' '))
          WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN '1000' WHEN event_id % 3 = 1 THEN '2000' ELSE '3000' END ELSE '' END) AS TABKEY,
        CASE event_type WHEN 'signup' THEN 'KEY' WHEN 'click' THEN CASE event_id % 6 WHEN 0 THEN 'SPERR' WHEN 1 THEN 'SPERZ' WHEN 2 THEN 'SPERM' WHEN 3 THEN 'LOEVM' WHEN 4 THEN 'CONFS' ELSE 'NAME1' END
          ELSE CASE event_id % 6 WHEN 0 THEN 'SPERR' WHEN 1 THEN 'LOEVM' WHEN 2 THEN 'ZAHLS' WHEN 3 THEN 'REPRF' WHEN 4 THEN 'CONFS' ELSE 'ZTERM' END END AS FNAME,
        CASE WHEN event_type <> 'signup' THEN CASE WHEN event_id % 29 = 5 THEN 'J' ELSE 'U' END WHEN h.half = 0 THEN 'D' ELSE 'I' END AS CHNGIND, CASE WHEN user_id % 2 = event_id % 4 THEN '' ELSE 'X' END AS VALUE_NEW
        FROM {events} CROSS JOIN (SELECT 0 AS half UNION ALL SELECT 1 AS half) h WHERE event_type = 'signup' OR (event_type IN ('click', 'view') AND h.half = 1)""",
    # Pay runs on two weekdays, invoices, and changes of fields that hold payments back.
    "p_runs": "SELECT extract_date AS run FROM spine WHERE day(extract_date) % 7 IN (2, 5)",
    "p_invoices": "SELECT event_id AS doc, lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR, CASE WHEN event_id % 3 = 0 THEN '1000' ELSE '2000' END AS BUKRS, CAST(ts AS DATE) AS budat, CAST(ts AS DATE) + CAST(event_id % 12 AS INT) AS netdt, CAST(value AS DECIMAL(23,2)) AS amount FROM {events} WHERE event_type = 'view'",
    "p_base": "SELECT lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR, CASE WHEN user_id % 9 = 1 THEN '1' ELSE '' END AS CONFS, '' AS SPERZ, CASE WHEN user_id % 31 = 4 THEN 'X' ELSE '' END AS SPERR, '' AS LOEVM FROM users",
    "p_changes": "SELECT lpad(CAST(user_id AS STRING), 10, '0') AS LIFNR, ts, event_id, CASE event_id % 4 WHEN 0 THEN 'CONFS' WHEN 1 THEN 'SPERZ' WHEN 2 THEN 'SPERR' ELSE 'NAME1' END AS FNAME, CASE WHEN event_id % 5 < 3 THEN '' ELSE 'X' END AS VALUE_NEW FROM {events} WHERE event_type = 'click' AND user_id % 3 = 0",
    # Orders as transactions with recipients, all text.
    "p_tx": """SELECT concat('U', CAST(o_custkey % 60 AS STRING)) AS uei, concat(' Firm  ', CAST(o_custkey % 7 AS STRING), CASE WHEN o_orderkey % 11 = 3 THEN ' Redacted due to' WHEN o_orderkey % 2 = 0 THEN ', Inc.' ELSE ' Incorporated' END) AS name_raw,
        '' AS dba_name, concat('P', CAST(o_custkey % 9 AS STRING)) AS parent_uei, '' AS parent_name_raw, CASE WHEN o_orderkey % 13 = 5 THEN ' ' ELSE concat(CAST(o_custkey % 4 AS STRING), ' North Road ') END AS address_line_1,
        concat('Town ', CAST(o_orderkey % 3 AS STRING)) AS city, 'VA' AS state, concat('22', CAST(100 + o_custkey % 8 AS STRING), '-1234') AS zip, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'CAN' ELSE 'USA' END AS country,
        concat('f', CAST(o_orderkey % 6 AS STRING)) AS source_file FROM {orders}""",
    # Parts as the parties to match; brands and sizes make the blocks.
    "parties": """SELECT lpad(CAST(p_partkey AS STRING), 10, '0') AS LIFNR, concat('The ', p_name, CASE WHEN p_partkey % 3 = 0 THEN ', Inc.' WHEN p_partkey % 3 = 1 THEN ' Incorporated' ELSE ' L.L.C.' END) AS name,
        concat(CAST(p_partkey % 40 AS STRING), ' North ', p_type, ' Street & Road') AS address, p_brand AS state, lpad(CAST(p_size AS STRING), 3, '0') || '-' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') AS zip,
        concat('U', CAST(p_partkey % 700 AS STRING)) AS uei, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('U', CAST(p_partkey % 90 AS STRING)) END AS parent_uei FROM {part}""",
}
BASES = "region nation customer supplier part orders lineitem events".split()


def _needs(sql: str) -> list[str]:
    return [n for n in SHAPES if re.search(rf"\b{n}\b", sql)]


def closed(names: list[str], known: Container[str] = ()) -> list[str]:
    """Shapes in the order in which they can be stated, without those that are known."""
    out: list[str] = []

    def add(n: str) -> None:
        for x in _needs(SHAPES[n]):
            if x != n and x not in out and x not in known:
                add(x)
        if n not in out:
            out.append(n)

    for n in names:
        add(n)
    return out


def stated(sql: str, names: list[str], more: dict[str, str] | None = None) -> str:
    """sql with the shapes (and further ones, in order) in front, for DuckDB."""
    parts = [(n, SHAPES[n]) for n in closed(names)] + list((more or {}).items())
    text = ("WITH RECURSIVE " + ",\n".join(f"{n} AS ({s})" for n, s in parts) + "\n" if parts else "") + sql
    return re.sub(r"\{(\w+)\}", lambda m: m[1] if m[1] in BASES else m[0], text)


def shape(spark: SparkSession, sf_dir: str, name: str, given: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A shape as a frame. given: shapes that are tables already, by name; they are read and not stated again."""
    given = given or {}
    text = ", ".join(f"{n} AS ({SHAPES[n]})" for n in closed([name], given)) + f" SELECT * FROM {name}"
    for n in given:
        text = re.sub(rf"\b{n}\b", "{" + n + "}", text)
    bases = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in BASES if "{" + b + "}" in text}
    return spark.sql(f"WITH {text}", **bases, **{n: df for n, df in given.items() if "{" + n + "}" in text})
