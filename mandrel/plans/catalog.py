"""Registered queries over the driver's tables, and the SQL that each must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mandrel.functions.normalize import ADDRESS_FORMS, NAME_FORMS, normalize_address, normalize_name, zip5
from mandrel.functions.similarity import JARO_WINKLER
from mandrel.operators import conform, matching, rules, temporal, verify
from mandrel.operators.expectations import guarded, violations
from mandrel.operators.scd2 import END, START, scd2
from mandrel.plans.adapters import shape, stated
from mandrel.session import shared_folder, written
from mandrel.sources import archives
from mandrel.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

#: Windows that fit a month of events.
W = rules.Windows(second_change=2, completed_stays=10, payment_after_change=3, change_stays=10)


def query(oracle: str | None = None, shapes: str = "", also: str = "", money: str = ""):
    """Register a query; the oracle sees the named shapes and the further tables of _SQL. Columns in `money` are exact decimals, given out as doubles by both."""

    def add(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.col(c).cast("double") for c in money.split()})

        _QUERIES[f.__name__] = run if money else f
        if oracle:
            whole = f"SELECT * REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in money.split())}) FROM ({oracle})" if money else oracle
            _ORACLES[f.__name__] = stated(whole, shapes.split(), {n: _SQL[n] for n in also.split()})
        return f

    return add


# Oracle side: the conformed tables in DuckDB's dialect -------------------------------------------------------

_dats = lambda c: f"CASE WHEN {c} NOT IN ('', '00000000') THEN strptime({c}, '%Y%m%d')::DATE END"


def _clean(c: str) -> str:
    out = f"replace(replace(upper(coalesce({c}, '')), '.', ''), '&', ' & ')"
    return f"trim(regexp_replace(regexp_replace({out}, '[^A-Z0-9& ]+', ' ', 'g'), '\\s+', ' ', 'g'))"


def _short(c: str, forms: dict[str, str]) -> str:
    for form in sorted(forms, key=len, reverse=True):
        c = f"regexp_replace({c}, '\\b{form}\\b', '{forms[form]}', 'g')"
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def _name(c: str) -> str:
    spaced = f"trim(regexp_replace(replace({_short(_clean(c), NAME_FORMS)}, '&', ' & '), '\\s+', ' ', 'g'))"
    return f"trim(regexp_replace(regexp_replace({spaced}, ' THE$', ' '), '^THE ', ''))"


def _address(c: str) -> str:
    return _short(f"replace({_clean(c)}, '&', ' AND ')", ADDRESS_FORMS)


_digits = "regexp_replace(zip, '\\D', '', 'g')"
_SQL = {
    "s_vendor": f"""SELECT a.extract_date, a.LIFNR, b.PARTNER, a.KTOKK, a.NAME1, b.NAME_ORG1, a.KTOKK = 'ZEMP' AS is_employee, r.STREET, r.PO_BOX, r.CITY1, r.POST_CODE1, r.REGION, r.COUNTRY,
        a.STCD2, a.SPERR, a.SPERZ, a.SPERM, a.LOEVM, a.XCPDK, a.LNRZA, a.XZEMP, a.CONFS, {_dats('a.ERDAT')} AS created_on
        FROM b_lfa1 a LEFT JOIN b_link c ON c.VENDOR = a.LIFNR AND c.extract_date = a.extract_date
        LEFT JOIN b_but000 b ON b.PARTNER_GUID = c.PARTNER_GUID AND b.extract_date = a.extract_date
        LEFT JOIN b_adrc r ON r.ADDRNUMBER = a.ADRNR AND r.extract_date = a.extract_date AND r.NATION = ''""",
    "s_code": f"""SELECT extract_date, LIFNR, BUKRS, AKONT, ZTERM, CASE ZTERM WHEN 'NT30' THEN 30 WHEN 'NT45' THEN 45 WHEN 'NT60' THEN 60 WHEN '0001' THEN 0 END::INT AS term_days,
        ZWELS, ZAHLS, SPERR, LOEVM, REPRF, LNRZB, PERNR, CONFS, {_dats('ERDAT')} AS created_on FROM b_lfb1""",
    "s_bank": "SELECT * FROM b_lfbk WHERE BANKL <> '' AND BANKN <> ''",
    "s_lines_all": f"""SELECT RBUKRS, GJAHR, BELNR, DOCLN, arg_max(LIFNR, extract_date) AS LIFNR, arg_max(BLART, extract_date) AS BLART, {_dats('arg_max(BUDAT, extract_date)')} AS BUDAT, {_dats('arg_max(NETDT, extract_date)')} AS NETDT,
        TRY_CAST(arg_max(HSL, extract_date) AS DECIMAL(23,2)) AS HSL, arg_max(RHCUR, extract_date) AS RHCUR, arg_max(AUGBL, extract_date) AS AUGBL, {_dats('arg_max(AUGDT, extract_date)')} AS AUGDT,
        min(extract_date) AS first_extract_date, min(CASE WHEN AUGBL <> '' THEN extract_date END) AS cleared_extract_date
        FROM b_acdoca WHERE RLDNR = '0L' AND KOART = 'K' GROUP BY RBUKRS, GJAHR, BELNR, DOCLN""",
    "s_lines": "SELECT * FROM s_lines_all WHERE HSL IS NOT NULL AND LIFNR <> '' AND BLART IN ('KR', 'KZ')",
    "dates": "SELECT DISTINCT extract_date FROM b_lfa1",
    "s_open": """SELECT d.extract_date, LIFNR, RBUKRS AS BUKRS, GJAHR, BELNR, DOCLN, BLART, BUDAT, NETDT, HSL, abs(HSL) AS amount FROM s_lines, dates d
        WHERE first_extract_date <= d.extract_date AND (cleared_extract_date IS NULL OR cleared_extract_date > d.extract_date)""",
    "s_pay": "SELECT LIFNR, RBUKRS AS BUKRS, GJAHR, BELNR, BUDAT, HSL, first_extract_date FROM s_lines WHERE BLART = 'KZ'",
    "hist": """SELECT *, lead(change_ts) OVER w AS until_ts, lead(CHANGENR) OVER w AS until_nr FROM (SELECT *, row_number() OVER w = 1 OR (BANKS, BANKL, BANKN) IS DISTINCT FROM (lag(BANKS) OVER w, lag(BANKL) OVER w, lag(BANKN) OVER w) AS opens
        FROM bank_feed WINDOW w AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR)) WHERE opens WINDOW w AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR)""",
    "chg": """SELECT * FROM (SELECT LIFNR, BANKN, CHANGENR, changed_by, source, change_ts AS ts, lag(BANKN) OVER w AS prev, lead(change_ts) OVER w AS nts, lead(BANKN) OVER w AS nbank, lead(changed_by) OVER w AS nby, lead(CHANGENR) OVER w AS nnr
        FROM hist WINDOW w AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR)) WHERE source = 'CDPOS' AND prev IS NOT NULL""",
    "active": """SELECT v.extract_date, v.LIFNR, v.NAME1 FROM s_vendor v WHERE LOEVM = '' AND SPERR = '' AND (EXISTS (SELECT 1 FROM s_open o WHERE o.LIFNR = v.LIFNR AND o.extract_date = v.extract_date)
        OR EXISTS (SELECT 1 FROM s_pay p WHERE p.LIFNR = v.LIFNR AND p.first_extract_date <= v.extract_date AND p.BUDAT <= v.extract_date AND p.BUDAT > v.extract_date - 90))""",
    "r01": """SELECT a.extract_date, 'R01' AS rule_id, 'Medium' AS severity, s.LIFNR, '' AS BUKRS, s.other AS related_lifnr, printf('Possible duplicate of %s (%s), match score %.1f', s.other, s.nm, m.score) AS detail
        FROM b_matches m JOIN active a ON a.LIFNR = m.LIFNR_A JOIN active b ON b.LIFNR = m.LIFNR_B AND b.extract_date = a.extract_date,
        LATERAL (SELECT m.LIFNR_A AS LIFNR, m.LIFNR_B AS other, b.NAME1 AS nm UNION ALL SELECT m.LIFNR_B, m.LIFNR_A, a.NAME1) s WHERE m.above_threshold""",
    "r02": """SELECT d.extract_date, 'R02' AS rule_id, 'High' AS severity, LIFNR, BUKRS, '' AS related_lifnr, printf('Bank changed %s by %s, paid %s on %s, changed again %s by %s', strftime(ts, '%Y-%m-%d %H:%M'), changed_by,
        format('{:,.2f}', amount::DOUBLE), strftime(pdate, '%Y-%m-%d'), strftime(nts, '%Y-%m-%d %H:%M'), nby) AS detail
        FROM (SELECT c.LIFNR, ts, changed_by, CHANGENR, BANKN, prev, nts, nby, nnr, nbank, min(p.BUKRS) AS BUKRS, min(p.BELNR) AS belnr, min(p.BUDAT) AS pdate, sum(p.HSL) AS amount
              FROM chg c JOIN s_pay p ON p.LIFNR = c.LIFNR AND p.BUDAT BETWEEN ts::DATE AND nts::DATE WHERE nts <= ts + INTERVAL 2 DAY GROUP BY ALL) h
        JOIN dates d ON nts::DATE <= d.extract_date AND nts::DATE + 10 >= d.extract_date""",
    "r03g": """SELECT b.extract_date, BANKS, BANKL, BANKN, list_sort(list(DISTINCT b.LIFNR)) AS holders, bool_or(coalesce(e.x, false)) AS emp FROM s_bank b
        LEFT JOIN (SELECT DISTINCT extract_date, LIFNR, true AS x FROM s_code WHERE PERNR <> '') e ON e.extract_date = b.extract_date AND e.LIFNR = b.LIFNR GROUP BY 1, 2, 3, 4 HAVING len(holders) > 1""",
    "r03": """SELECT b.extract_date, 'R03' AS rule_id, CASE WHEN emp THEN 'High' ELSE 'Medium' END AS severity, b.LIFNR, '' AS BUKRS, array_to_string(list_filter(holders, lambda x: x <> b.LIFNR), ',') AS related_lifnr,
        printf('Bank %s/%s also used by %s%s', b.BANKL, b.BANKN, array_to_string(list_filter(holders, lambda x: x <> b.LIFNR), ','), CASE WHEN emp THEN ' (employee-linked)' ELSE '' END) AS detail
        FROM s_bank b JOIN r03g g ON g.extract_date = b.extract_date AND g.BANKS = b.BANKS AND g.BANKL = b.BANKL AND g.BANKN = b.BANKN""",
    "lastp": "SELECT d.extract_date, LIFNR, max(BUDAT) AS last_posting FROM s_lines l JOIN dates d ON l.first_extract_date <= d.extract_date GROUP BY 1, 2",
    "r04x": """SELECT v.extract_date, v.LIFNR, v.SPERM, coalesce(last_posting, created_on) AS la FROM s_vendor v LEFT JOIN lastp p ON p.extract_date = v.extract_date AND p.LIFNR = v.LIFNR WHERE SPERR = '' AND SPERZ = '' AND LOEVM = ''""",
    "r04": """SELECT extract_date, 'R04' AS rule_id, 'Low' AS severity, LIFNR, '' AS BUKRS, '' AS related_lifnr, printf('No postings since %s (%d months); SPERR, SPERZ, LOEVM not set%s', strftime(la, '%Y-%m-%d'),
        datesub('month', la, extract_date), CASE WHEN SPERM <> '' THEN ', only SPERM set' ELSE '' END) AS detail FROM r04x WHERE la <= (extract_date - INTERVAL 18 MONTH)::DATE""",
    "r05": "SELECT extract_date, 'R05' AS rule_id, 'Medium' AS severity, LIFNR, BUKRS, '' AS related_lifnr, 'LFB1-REPRF blank in company code ' || BUKRS AS detail FROM s_code WHERE REPRF = ''",
    "r06": """SELECT extract_date, 'R06' AS rule_id, 'Medium' AS severity, LIFNR, '' AS BUKRS, LNRZA AS related_lifnr, CASE WHEN LNRZA <> '' THEN 'Alternative payee ' || LNRZA || ' (LFA1-LNRZA)' ELSE 'Payee in document allowed (LFA1-XZEMP)' END AS detail
        FROM s_vendor WHERE LNRZA <> '' OR XZEMP <> ''
        UNION ALL SELECT extract_date, 'R06', 'Medium', LIFNR, BUKRS, LNRZB, 'Alternative payee ' || LNRZB || ' in company code ' || BUKRS || ' (LFB1-LNRZB)' FROM s_code WHERE LNRZB <> ''
        UNION ALL SELECT v.extract_date, 'R06', 'Medium', v.LIFNR, '', '', printf('One-time vendor paid %d times in 90 days (LFA1-XCPDK)', n) FROM s_vendor v JOIN
        (SELECT d.extract_date, LIFNR, count(DISTINCT BELNR) AS n FROM s_pay p JOIN dates d ON p.first_extract_date <= d.extract_date AND p.BUDAT > d.extract_date - 90 GROUP BY 1, 2) x
        ON x.extract_date = v.extract_date AND x.LIFNR = v.LIFNR WHERE XCPDK <> '' AND n >= 2""",
    "r07": """SELECT o.extract_date, 'R07' AS rule_id, 'Medium' AS severity, o.LIFNR, o.BUKRS, '' AS related_lifnr, printf('Payment will be held: unconfirmed sensitive change; %d open item(s) (%s) due by %s', n, format('{:,.2f}', due::DOUBLE), strftime(first, '%Y-%m-%d')) AS detail
        FROM (SELECT extract_date, LIFNR, BUKRS, sum(amount) AS due, min(NETDT) AS first, count(*) AS n FROM s_open WHERE NETDT <= extract_date + 7 GROUP BY 1, 2, 3) o
        JOIN s_code c ON c.extract_date = o.extract_date AND c.LIFNR = o.LIFNR AND c.BUKRS = o.BUKRS JOIN s_vendor v ON v.extract_date = o.extract_date AND v.LIFNR = o.LIFNR WHERE v.CONFS <> '' OR c.CONFS <> ''""",
    "r08x": """SELECT d.extract_date, c.LIFNR, c.ts, c.CHANGENR, c.changed_by, min({'a': p.BUDAT, 'b': p.BELNR, 'c': p.BUKRS}) AS f, count(*) AS n, sum(p.HSL) AS amount FROM chg c JOIN s_pay p ON p.LIFNR = c.LIFNR AND p.BUDAT BETWEEN ts::DATE AND ts::DATE + 3
        JOIN dates d ON p.BUDAT <= d.extract_date AND d.extract_date <= ts::DATE + 10 GROUP BY 1, 2, 3, 4, 5""",
    "r08": """SELECT extract_date, 'R08' AS rule_id, 'Medium' AS severity, LIFNR, f.c AS BUKRS, '' AS related_lifnr, printf('Bank changed %s by %s, then %d payment(s) totalling %s from %s', strftime(ts, '%Y-%m-%d %H:%M'), changed_by, n, format('{:,.2f}', amount::DOUBLE), strftime(f.a, '%Y-%m-%d')) AS detail
        FROM r08x QUALIFY row_number() OVER (PARTITION BY extract_date, LIFNR ORDER BY ts, CHANGENR) = 1""",
    "exc": " UNION ALL ".join(f"SELECT * FROM r0{k}" for k in range(1, 9)),
    "expo": "SELECT extract_date, LIFNR, sum(amount) AS exposure FROM s_open GROUP BY 1, 2",
    "risk": """SELECT *, row_number() OVER (PARTITION BY extract_date ORDER BY risk DESC, severity_tier DESC, LIFNR) AS risk_rank FROM (SELECT e.extract_date, e.LIFNR, severity_tier, rules, exception_count, coalesce(exposure, 0)::DECIMAL(23,2) AS exposure, v.NAME1,
        (coalesce(exposure, 0) * severity_tier)::DECIMAL(25,2) AS risk FROM (SELECT extract_date, LIFNR, max(CASE severity WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END) AS severity_tier, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules, count(*) AS exception_count FROM exc GROUP BY 1, 2) e
        LEFT JOIN expo x ON x.extract_date = e.extract_date AND x.LIFNR = e.LIFNR LEFT JOIN s_vendor v ON v.extract_date = e.extract_date AND v.LIFNR = e.LIFNR)""",
    "runs": """SELECT p.extract_date, p.rule_id, sum(n)::BIGINT AS exceptions, count(*) AS vendors_flagged, count(*) FILTER (WHERE q.LIFNR IS NULL) AS new_vendors, sum(coalesce(exposure, 0))::DECIMAL(23,2) AS exposure_flagged
        FROM (SELECT extract_date, rule_id, LIFNR, count(*) AS n FROM exc GROUP BY 1, 2, 3) p LEFT JOIN (SELECT DISTINCT extract_date + 1 AS extract_date, rule_id, LIFNR FROM exc) q ON q.extract_date = p.extract_date AND q.rule_id = p.rule_id AND q.LIFNR = p.LIFNR
        LEFT JOIN expo x ON x.extract_date = p.extract_date AND x.LIFNR = p.LIFNR GROUP BY 1, 2""",
    "wq": """SELECT e.*, f.first_flagged, coalesce(r.exposure, 0)::DECIMAL(23,2) AS exposure, r.NAME1, CASE WHEN e.rule_id = 'R02' OR (e.rule_id = 'R03' AND e.severity = 'High') THEN 1
        WHEN e.rule_id IN ('R03', 'R06', 'R07', 'R08') OR (e.rule_id = 'R01' AND regexp_extract(e.detail, 'score ([0-9.]+)$', 1)::DOUBLE >= 95) THEN 2 ELSE 3 END AS queue, (e.extract_date - f.first_flagged)::INT AS days_open,
        CASE e.severity WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS tier
        FROM exc e JOIN (SELECT rule_id, LIFNR, BUKRS, min(extract_date) AS first_flagged FROM exc GROUP BY 1, 2, 3) f ON f.rule_id = e.rule_id AND f.LIFNR = e.LIFNR AND f.BUKRS = e.BUKRS LEFT JOIN risk r ON r.extract_date = e.extract_date AND r.LIFNR = e.LIFNR""",
    "pv": f"SELECT LIFNR, name, address, state, {_name('name')} AS name_norm, {_address('address')} AS address_norm, CASE WHEN length({_digits}) >= 5 THEN left({_digits}, 5) ELSE '' END AS zip5, uei, parent_uei FROM parties",
    "keys": "SELECT *, CASE WHEN state <> '' AND length(left(zip5, 3)) = 3 THEN state || '|' || left(zip5, 3) ELSE '' END AS area, split_part(name_norm, ' ', 1) AS first_token FROM pv",
    "apairs": "SELECT a.LIFNR AS LIFNR_A, b.LIFNR AS LIFNR_B FROM keys a JOIN keys b ON a.area = b.area AND a.LIFNR < b.LIFNR WHERE a.area <> '' AND a.area IN (SELECT area FROM keys GROUP BY 1 HAVING count(*) <= 1000)",
    "pairs": """SELECT * FROM apairs UNION SELECT a.LIFNR, b.LIFNR FROM keys a JOIN keys b ON a.first_token = b.first_token AND a.LIFNR < b.LIFNR WHERE a.first_token <> '' AND a.first_token IN (SELECT first_token FROM keys GROUP BY 1 HAVING count(*) <= 1000)""",
    "truth": "SELECT a.LIFNR AS LIFNR_A, b.LIFNR AS LIFNR_B FROM pv a JOIN pv b ON a.uei = b.uei AND a.LIFNR < b.LIFNR",
    "lab": """SELECT LIFNR_A, LIFNR_B, CASE WHEN a.uei = b.uei THEN 'match' WHEN (a.parent_uei <> '' AND a.parent_uei = b.parent_uei) OR a.parent_uei = b.uei OR b.parent_uei = a.uei THEN 'related' ELSE 'non_match' END AS label
        FROM pairs JOIN pv a ON a.LIFNR = LIFNR_A JOIN pv b ON b.LIFNR = LIFNR_B""",
    "sc": """SELECT l.*, 100.0::DOUBLE * (1 - levenshtein(a.name_norm, b.name_norm)::DOUBLE / greatest(length(a.name_norm), length(b.name_norm), 1)) AS name_one, 100.0::DOUBLE * (1 - levenshtein(a.address_norm, b.address_norm)::DOUBLE / greatest(length(a.address_norm), length(b.address_norm), 1)) AS address_score
        FROM lab l JOIN pv a ON a.LIFNR = l.LIFNR_A JOIN pv b ON b.LIFNR = l.LIFNR_B""",
}

_RAW = "b_lfa1 b_link b_but000 b_adrc b_lfb1 b_lfbk b_acdoca bank_feed b_matches"
_VENDOR = "s_vendor s_code s_bank"
_LINES = "s_lines_all s_lines dates s_open s_pay"
_ALL = f"{_VENDOR} {_LINES} hist chg active r01 r02 r03g r03 lastp r04x r04 r05 r06 r07 r08x r08 exc expo risk runs wq"
_MATCH = "pv keys apairs pairs truth lab sc"


#: What the rules, and what is made of their hits, read of conformed tables.
_RULED = {
    "silver_vendor": ["extract_date", "LIFNR", "NAME1", "SPERR", "SPERZ", "SPERM", "LOEVM", "XCPDK", "LNRZA", "XZEMP", "CONFS", "created_on"],
    "silver_vendor_company_code": ["extract_date", "LIFNR", "BUKRS", "ZWELS", "REPRF", "LNRZB", "PERNR", "CONFS"],
    "silver_vendor_bank": ["extract_date", "LIFNR", "BANKS", "BANKL", "BANKN"],
    "silver_journal_lines": ["*"],
}


class Frames:
    """The shapes and conformed tables of one folder, each built once for one query."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.known, self.given = spark, sf_dir, {}, {}

    def read(self, name: str) -> DataFrame:
        if name not in self.known:
            if name in conform.SILVER:
                df = guarded(conform.SILVER[name](self.read), [e for e in conform.EXPECTATIONS.get(name, []) if e.action == "drop"], name)
                self.known[name] = df.frame
            else:
                alias = {"bronze_cvi_vend_link": "b_link"}
                self.known[name] = shape(self.spark, self.dir, alias.get(name, name.replace("bronze_", "b_")), self.given)
        return self.known[name]

    @property
    def dates(self) -> DataFrame:
        if "dates" not in self.known:
            self.known["dates"] = temporal.spine(self.read("bronze_lfa1"))
        return self.known["dates"]

    @property
    def history(self) -> DataFrame:
        if "history" not in self.known:
            self.known["history"] = scd2(self.read("bank_feed"), ["LIFNR"], ["change_ts", "CHANGENR"], ["BANKS", "BANKL", "BANKN"])
        return self.known["history"]

    def hold(self, *names: str) -> None:
        """Write tables that one query reads many times to the shared folder, as the graph does; a lost executor costs nothing."""
        for n in names:
            self.known[n] = written({"history": lambda: self.history, "changes": lambda: self.changes}.get(n, lambda: self.read(n))(), n)  # noqa: B023

    @property
    def changes(self) -> DataFrame:
        """Bank changes beside their neighbours, which two rules read."""
        if "changes" not in self.known:
            self.known["changes"] = rules.bank_changes(self.history)
        return self.known["changes"]

    @property
    def active(self) -> DataFrame:
        if "active" not in self.known:
            self.known["active"] = written(rules.active_vendors(self.read("silver_vendor"), self.read("silver_open_items"), self.read("silver_payments"), self.dates), "active")
        return self.known["active"]

    def undated(self, k: int) -> DataFrame:
        """A rule's hits; those that say the same on many dates come once, with `dates`."""
        if k == 1:
            return rules.r01_undated(self.read("b_matches"), self.active, written)
        if k == 3:
            return rules.r03_undated(self.read("silver_vendor_bank"), self.read("silver_vendor_company_code"))
        return self.rule(k)

    def rule(self, k: int) -> DataFrame:
        r, d = self.read, self.dates
        if k in (1, 3):
            return rules.spread(self.undated(k))
        if k == 2:
            return rules.r02_change_pay_change(self.changes, r("silver_payments"), d, W)
        if k == 4:
            return rules.r04_dormant(r("silver_vendor"), rules.last_postings(r("silver_journal_lines"), d))
        if k == 5:
            return rules.r05_check_off(r("silver_vendor_company_code"))
        if k == 6:
            return rules.r06_payee(r("silver_vendor"), r("silver_vendor_company_code"), r("silver_payments"), d)
        if k == 7:
            return rules.r07_held(r("silver_vendor"), r("silver_vendor_company_code"), r("silver_open_items"))
        return rules.r08_paid_after_change(self.changes, r("silver_payments"), d, W)

    def delivered_held(self) -> None:
        """What rules read of delivered tables, made once."""
        if "delivered" not in self.known:
            # What all delivered tables are made of is found once, and shared out evenly.
            parts = self.spark.sparkContext.defaultParallelism
            self.given = {n: written(shape(self.spark, self.dir, n).repartition(k), n) for n, k in (("spine", 1), ("users", parts))}
            self.known = {n: df for n, df in self.known.items() if n not in _RULED}
            for n, columns in _RULED.items():
                df = self.read(n).select(*columns)
                # A vendor's lines lie together, so what is counted by vendor from them is small before it is shuffled.
                self.known[n] = written(df.repartition("LIFNR") if n == "silver_journal_lines" else df, n)
            self.known["delivered"] = True

    def _rules_held(self) -> None:
        if "held" not in self.known:
            self.delivered_held()
            self.hold("silver_open_items", "silver_payments", "changes")
            self.known["held"] = True

    @property
    def exceptions(self) -> DataFrame:
        """All hits with their text, made where they are read: as many as pairs times dates, so they are never written on the way."""
        if "exc" not in self.known:
            self.known["exc"] = self.told(lambda hits: hits)
        return self.known["exc"]

    def told(self, then: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """All hits as `then` makes them of hits that may still have `dates` in place of a date: what it makes is made once for all of these."""
        self._rules_held()
        return rules.exceptions([rules.spread(then(self.undated(k))) for k in range(1, 9)])

    @property
    def summary(self) -> DataFrame:
        """All hits by date, vendor and company code, counted; what only counts hits reads this."""
        if "summary" not in self.known:
            self._rules_held()
            others = [self.rule(3), self.known["rest"]] if "rest" in self.known else [self.rule(k) for k in range(2, 9)]
            told = [rules.r01_summed(self.read("b_matches"), self.active, written, self.known.get("partners")), *map(rules.summed, others)]
            self.known["summary"] = written(rules.exceptions(told), "summary")
        return self.known["summary"]

    @property
    def risk(self) -> DataFrame:
        return rules.vendor_risk(self.summary, self.read("silver_open_items"), self.read("silver_vendor"))

    @property
    def history_of_runs(self) -> DataFrame:
        return rules.run_history(self.summary, self.read("silver_open_items"))

    @property
    def queue(self) -> DataFrame:
        """All hits with what the queue says of them. Pairs and accounts meet what is said of a vendor before they are spread over dates."""
        self._rules_held()
        # Hits of rules without squares are few: made once, for their own rows and for the summary.
        rest = self.known["rest"] = written(rules.exceptions([self.rule(k) for k in (2, 4, 5, 6, 7, 8)]), "rest")
        risk = written(self.risk.select("extract_date", "LIFNR", "exposure", "NAME1"), "risk")
        own = written(rules.beside(risk, self.summary), "beside")
        pairs = rules.r01_undated(self.read("b_matches"), self.active, written, own)
        accounts = rules.r03_undated(self.read("silver_vendor_bank"), self.read("silver_vendor_company_code"), own)
        return rules.exceptions([*map(rules.queued, (pairs, accounts)), rules.work_queue(rest, risk, self.summary)])

    @property
    def cases(self) -> DataFrame:
        """One row for each vendor and date, led by its most urgent hit: from counted hits, with the text of those alone that lead."""
        self._rules_held()
        found = rules.partners(self.read("b_matches"), self.active, written)
        found = self.known["partners"] = replace(found, met=written(found.met, "met"))
        leads = written(rules.led(rules.work_queue(self.summary, self.risk)), "leads")
        rest = rules.exceptions([self.rule(k) for k in (2, 4, 5, 6, 7, 8)])
        return rules.told(leads, self.read("b_matches"), self.active, found, self.read("silver_vendor_bank"), self.read("silver_vendor_company_code"), rest, written)

    @property
    def parties(self) -> DataFrame:
        p = shape(self.spark, self.dir, "parties")
        v = p.withColumns({"name_norm": normalize_name("name"), "address_norm": normalize_address("address"), "zip5": zip5("zip")})
        return matching.block_keys(v)

    @property
    def scored(self) -> DataFrame:
        v = self.parties
        pairs = matching.label_pairs(matching.candidate_pairs(v), v)
        both = pairs
        for side in "AB":
            both = both.join(v.select(F.col("LIFNR").alias(f"LIFNR_{side}"), F.col("name_norm").alias(f"n{side}"), F.col("address_norm").alias(f"a{side}")), f"LIFNR_{side}")
        like = lambda a, b: F.lit(100.0) * (1 - F.levenshtein(a, b).cast("double") / F.greatest(F.length(a), F.length(b), F.lit(1)))
        return both.select("LIFNR_A", "LIFNR_B", "label", like("nA", "nB").alias("name_one"), like("aA", "aB").alias("address_score"), F.round(100 * JARO_WINKLER("nA", "nB"), 6).alias("name_two"))

    @property
    def labelled(self) -> DataFrame:
        """Blocked pairs with their label, their fold and the real scores."""
        v = self.parties
        pairs = matching.label_pairs(matching.candidate_pairs(v), v)
        return matching.score_pairs(pairs, v).join(pairs, ["LIFNR_A", "LIFNR_B"])


# Conformed tables -----------------------------------------------------------------------------------------


@query("SELECT * FROM s_vendor", _RAW, "s_vendor")
def vendor_conformed(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_vendor")


@query("SELECT * FROM s_code", _RAW, "s_code")
def company_code_terms(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_vendor_company_code")


@query("SELECT * FROM s_bank", _RAW, "s_bank")
def expect_drop_bank(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_vendor_bank")


@query(
    """SELECT extract_date, PARTNER, BKVID, BANKN, strftime(f, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(t, '%Y-%m-%d %H:%M:%S') AS valid_to, f <= e AND e <= t AS is_valid, f > e AS is_future_dated
    FROM (SELECT *, strptime(BK_VALID_FROM, '%Y%m%d%H%M%S') AS f, strptime(BK_VALID_TO, '%Y%m%d%H%M%S') AS t, extract_date + INTERVAL '23:59:59' AS e FROM b_but0bk) WHERE f <= t""",
    "b_but0bk",
)
def validity_flags(spark, sf_dir):
    df = Frames(spark, sf_dir).read("silver_bp_bank")
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("extract_date", "PARTNER", "BKVID", "BANKN", at("valid_from"), at("valid_to"), "is_valid", "is_future_dated")


@query("SELECT extract_date, ADDRNUMBER, NAME1, STREET, PO_BOX, CITY1, POST_CODE1, REGION, COUNTRY FROM b_adrc", "b_adrc")
def address_table(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_address")


@query("SELECT * FROM s_lines", _RAW, "s_lines_all s_lines", money="HSL")
def journal_lines(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_journal_lines")


@query("SELECT * FROM s_open", _RAW, _LINES, money="HSL amount")
def open_items_asof(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_open_items")


@query("SELECT * FROM s_pay", _RAW, _LINES, money="HSL")
def payment_lines(spark, sf_dir):
    return Frames(spark, sf_dir).read("silver_payments")


def _expected(table: str, source: str) -> str:
    out = []
    for e in conform.EXPECTATIONS[table]:
        p = e.predicate.replace(" RLIKE ", " SIMILAR TO ").replace("'^", "'").replace("$'", "'")
        out.append(f"SELECT '{table}' AS dataset, '{e.name}' AS expectation, '{e.action}' AS action, count(*) FILTER (WHERE coalesce({p}, false)) AS passed, count(*) FILTER (WHERE NOT coalesce({p}, false)) AS failed FROM {source}")
    return " UNION ALL ".join(out)


_GUARDED = {"silver_vendor": "s_vendor", "silver_vendor_company_code": "s_code", "silver_vendor_bank": "b_lfbk", "silver_address": "b_adrc", "silver_journal_lines": "s_lines_all", "silver_open_items": "s_open"}


@query(" UNION ALL ".join(_expected(t, s) for t, s in _GUARDED.items()), _RAW, f"s_vendor s_code {_LINES}")
def expect_metrics(spark, sf_dir):
    f = Frames(spark, sf_dir)
    return rules.exceptions([violations(conform.SILVER[t](f.read), conform.EXPECTATIONS[t], t) for t in _GUARDED])


# Versions and history -------------------------------------------------------------------------------------


@query("""SELECT l_orderkey, l_linenumber, arg_max(l_partkey, k) AS l_partkey, arg_max(l_quantity, k) AS l_quantity, arg_max(l_returnflag, k) AS l_returnflag, min(l_shipdate)::DATE AS first_ship, min(CASE WHEN l_returnflag = 'R' THEN l_shipdate END)::DATE AS first_return, count(*) AS versions
    FROM (SELECT *, {'a': l_shipdate, 'b': l_partkey, 'c': l_suppkey, 'd': l_extendedprice} AS k FROM lineitem) GROUP BY 1, 2""")
def latest_version(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    extra = [F.to_date(F.min("l_shipdate")).alias("first_ship"), F.to_date(F.min(F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")))).alias("first_return"), F.count("*").alias("versions")]
    return temporal.latest_version(rows, ["l_orderkey", "l_linenumber"], order, ["l_partkey", "l_quantity", "l_returnflag"], extra)


_TS = "yyyy-MM-dd HH:mm:ss"


def _versions(df: DataFrame, columns: list[str]) -> DataFrame:
    at = lambda c: F.date_format(F.col(c), _TS)
    return df.select(*columns, at(f"{START}.change_ts").alias("from_ts"), at(f"{END}.change_ts").alias("to_ts"), F.col(f"{END}.CHANGENR").alias("to_nr"))


@query("SELECT LIFNR, BANKS, BANKL, BANKN, CHANGENR, source, changed_by, strftime(change_ts, '%Y-%m-%d %H:%M:%S') AS from_ts, strftime(until_ts, '%Y-%m-%d %H:%M:%S') AS to_ts, until_nr AS to_nr FROM hist", "bank_feed", "hist")
def scd2_bank(spark, sf_dir):
    return _versions(Frames(spark, sf_dir).history, ["LIFNR", "BANKS", "BANKL", "BANKN", "CHANGENR", "source", "changed_by"])


@query(
    """SELECT LIFNR, A, B, CHANGENR, strftime(change_ts, '%Y-%m-%d %H:%M:%S') AS from_ts, strftime(lead(change_ts) OVER w, '%Y-%m-%d %H:%M:%S') AS to_ts, lead(CHANGENR) OVER w AS to_nr
    FROM (SELECT *, row_number() OVER w = 1 OR A IS DISTINCT FROM lag(A) OVER w OR B IS DISTINCT FROM lag(B) OVER w AS opens
      FROM (SELECT LIFNR, change_ts, CHANGENR, last_value(A IGNORE NULLS) OVER s AS A, last_value(B IGNORE NULLS) OVER s AS B FROM controls_feed WINDOW s AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR ROWS UNBOUNDED PRECEDING))
      WINDOW w AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR)) WHERE opens WINDOW w AS (PARTITION BY LIFNR ORDER BY change_ts, CHANGENR)""",
    "controls_feed",
)
def scd2_controls_ignore_null(spark, sf_dir):
    return _versions(scd2(shape(spark, sf_dir, "controls_feed"), ["LIFNR"], ["change_ts", "CHANGENR"], ["A", "B"], ignore_null=True), ["LIFNR", "A", "B", "CHANGENR"])


@query("SELECT LIFNR, BANKN, CHANGENR, changed_by, prev, nbank AS next_BANKN, nnr AS next_CHANGENR, nby AS next_changed_by, strftime(nts, '%Y-%m-%d %H:%M:%S') AS next_at FROM chg", "bank_feed", "hist chg")
def lag_lead_versions(spark, sf_dir):
    df = Frames(spark, sf_dir).changes
    return df.select("LIFNR", "BANKN", "CHANGENR", "changed_by", "prev", "next_BANKN", "next_CHANGENR", "next_changed_by", F.date_format("next_ts", _TS).alias("next_at"))


@query("SELECT d.extract_date, p.LIFNR, count(*) AS n, sum(HSL) AS paid FROM s_pay p JOIN dates d ON first_extract_date <= d.extract_date AND BUDAT <= d.extract_date AND BUDAT > d.extract_date - 90 GROUP BY 1, 2", _RAW, _LINES, money="paid")
def spine_recent_payments(spark, sf_dir):
    f = Frames(spark, sf_dir)
    return temporal.recent(f.read("silver_payments"), f.dates, 90, booked=True).groupBy("extract_date", "LIFNR").agg(F.count("*").alias("n"), F.sum("HSL").alias("paid"))


@query("SELECT c.LIFNR, c.CHANGENR, p.BELNR, p.BUDAT FROM chg c JOIN s_pay p ON p.LIFNR = c.LIFNR AND p.BUDAT BETWEEN c.ts::DATE AND c.ts::DATE + 3", _RAW, f"{_LINES} hist chg")
def interval_join_payments(spark, sf_dir):
    f = Frames(spark, sf_dir)
    day = F.to_date("ts")
    return temporal.within(f.changes, f.read("silver_payments"), "LIFNR", F.col("BUDAT"), day, F.date_add(day, 3)).select("LIFNR", "CHANGENR", "BELNR", "BUDAT")


@query("SELECT * FROM lastp", _RAW, f"{_LINES} lastp")
def last_postings(spark, sf_dir):
    f = Frames(spark, sf_dir)
    return rules.last_postings(f.read("silver_journal_lines"), f.dates)


@query("SELECT * FROM active", _RAW, f"s_vendor {_LINES} active")
def semi_active(spark, sf_dir):
    f = Frames(spark, sf_dir)
    return rules.active_vendors(f.read("silver_vendor"), f.read("silver_open_items"), f.read("silver_payments"), f.dates)


@query(
    """SELECT c_custkey, c_nationkey, c_mktsegment, bucket, array_to_string(holders, ',') AS holders, any_marked FROM (SELECT *, floor(c_acctbal / 1000)::BIGINT AS bucket FROM customer) JOIN
    (SELECT c_nationkey, c_mktsegment, floor(c_acctbal / 1000)::BIGINT AS bucket, list_sort(list(DISTINCT c_custkey)) AS holders, bool_or(c_acctbal < 0) AS any_marked FROM customer GROUP BY 1, 2, 3 HAVING count(DISTINCT c_custkey) > 1) USING (c_nationkey, c_mktsegment, bucket)"""
)
def shared_holders(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").withColumn("bucket", F.floor(F.col("c_acctbal") / 1000).cast("long"))
    key = ["c_nationkey", "c_mktsegment", "bucket"]
    out = rules.shared_keys(c.select(*key, "c_custkey"), key, "c_custkey", c.where("c_acctbal < 0"), ["c_custkey"])
    return out.select("c_custkey", *key, F.array_join("holders", ",").alias("holders"), "any_marked")


# Rules ----------------------------------------------------------------------------------------------------

_HIT = ["extract_date", "rule_id", "severity", "LIFNR", "BUKRS", "related_lifnr", "detail"]


def _rule(k: int, name: str) -> None:
    def run(spark, sf_dir):
        return Frames(spark, sf_dir).rule(k).select(*_HIT)

    run.__name__ = name
    query(f"SELECT * FROM r0{k}", _RAW, _ALL)(run)


for _k, _n in enumerate(("duplicate", "change_pay_change", "shared_bank", "dormant", "check_off", "payee", "held", "paid_after_change"), 1):
    _rule(_k, f"rule_r0{_k}_{_n}")


@query(
    """SELECT d.extract_date, LIFNR, CHANGENR AS first_changenr, prev AS original_bankn, BANKN AS temporary_bankn, belnr AS payment_belnr, amount AS payment_amount, nnr AS second_changenr, (nbank = prev)::VARCHAR AS reverted FROM
    (SELECT c.LIFNR, ts, changed_by, CHANGENR, BANKN, prev, nts, nby, nnr, nbank, min(p.BELNR) AS belnr, sum(p.HSL) AS amount FROM chg c JOIN s_pay p ON p.LIFNR = c.LIFNR AND p.BUDAT BETWEEN ts::DATE AND nts::DATE WHERE nts <= ts + INTERVAL 2 DAY GROUP BY ALL)
    JOIN dates d ON nts::DATE <= d.extract_date AND nts::DATE + 10 >= d.extract_date""",
    _RAW, f"{_LINES} hist chg", money="payment_amount")
def evidence_fields(spark, sf_dir):
    """Evidence is JSON text; its fields are compared, not its spelling."""
    get = lambda k: F.get_json_object("evidence", f"$.{k}")
    names = ["first_changenr", "original_bankn", "temporary_bankn", "payment_belnr", "second_changenr"]
    df = Frames(spark, sf_dir).rule(2)
    return df.select("extract_date", "LIFNR", *[get(n).alias(n) for n in names], get("payment_amount").cast("decimal(33,2)").alias("payment_amount"), get("reverted_to_original").alias("reverted"))


@query("SELECT * FROM exc", _RAW, _ALL)
def exceptions(spark, sf_dir):
    return Frames(spark, sf_dir).exceptions.select(*_HIT)


@query("SELECT * FROM risk", _RAW, _ALL, money="exposure risk")
def vendor_risk(spark, sf_dir):
    return Frames(spark, sf_dir).risk.withColumn("rules", F.array_join("rules", ","))


@query("SELECT extract_date, LIFNR, risk, risk_rank FROM risk WHERE extract_date = (SELECT max(extract_date) FROM risk) AND risk_rank <= 100", _RAW, _ALL, money="risk")
def top100_risk(spark, sf_dir):
    """A report of fixed length: the hundred vendors with the greatest risk on the last date."""
    f = Frames(spark, sf_dir)
    last = F.broadcast(f.summary.agg(F.max("extract_date").alias("extract_date")))  # one row
    on_last = lambda df: df.join(last, "extract_date")
    # Only the last date is ranked, and a rank with a limit is a top-k.
    r = rules.vendor_risk(on_last(f.summary), on_last(f.read("silver_open_items")), on_last(f.read("silver_vendor")))
    return r.where("risk_rank <= 100").select("extract_date", "LIFNR", "risk", "risk_rank")


@query("SELECT * FROM runs", _RAW, _ALL, money="exposure_flagged")
def run_history(spark, sf_dir):
    return Frames(spark, sf_dir).history_of_runs


@query(
    """SELECT d.extract_date, r.rule_id, coalesce(vendors_flagged, 0) AS vendors_flagged, coalesce(new_vendors, 0) AS new_vendors, coalesce(exposure_flagged, 0)::DECIMAL(23,2) AS exposure_flagged
    FROM dates d CROSS JOIN (SELECT DISTINCT rule_id FROM exc) r LEFT JOIN runs h ON h.extract_date = d.extract_date AND h.rule_id = r.rule_id""",
    _RAW, _ALL, money="exposure_flagged")
def densified_history(spark, sf_dir):
    f = Frames(spark, sf_dir)
    h = f.history_of_runs
    every = f.dates.crossJoin(f.summary.select("rule_id").distinct())  # dates times rules: a report's grid
    zero = lambda c: F.coalesce(c, F.lit(0)).cast(h.schema[c].dataType).alias(c)
    return every.join(h, ["extract_date", "rule_id"], "left").select("extract_date", "rule_id", *[zero(c) for c in ("vendors_flagged", "new_vendors", "exposure_flagged")])


@query("SELECT extract_date, rule_id, LIFNR, BUKRS, detail, first_flagged, exposure, NAME1, queue, days_open, tier FROM wq", _RAW, _ALL, money="exposure")
def work_queue(spark, sf_dir):
    return Frames(spark, sf_dir).queue.select("extract_date", "rule_id", "LIFNR", "BUKRS", "detail", "first_flagged", "exposure", "NAME1", "queue", "days_open", "tier")


@query(
    """SELECT extract_date, LIFNR, min(queue) AS queue, string_agg(DISTINCT rule_id, ', ' ORDER BY rule_id) AS rules, min(first_flagged) AS first_flagged, bool_or(first_flagged > extract_date - 1) AS new,
    arg_min(detail, {'a': queue, 'b': -tier, 'c': rule_id, 'd': BUKRS, 'e': detail}) AS detail, max(exposure) AS exposure FROM wq GROUP BY 1, 2""",
    _RAW, _ALL, money="exposure")
def case_rollup(spark, sf_dir):
    return Frames(spark, sf_dir).cases.select("extract_date", "LIFNR", "queue", "rules", "first_flagged", "new", "detail", "exposure")


@query("SELECT extract_date, rule_id, sum(vendors_flagged)::BIGINT AS vendors FROM runs GROUP BY GROUPING SETS ((extract_date, rule_id), (rule_id))", _RAW, _ALL)
def flagged_by_rule(spark, sf_dir):
    h = Frames(spark, sf_dir).history_of_runs
    day, rule = F.col("extract_date"), F.col("rule_id")
    return h.groupingSets([[day, rule], [rule]], day, rule).agg(F.sum("vendors_flagged").alias("vendors"))


_SQL["man"] = """SELECT rule_id, LIFNR, BUKRS, min(extract_date) AS expected_first, right(LIFNR, 1) <> '7' AS expected_flag FROM exc WHERE extract_date = (SELECT max(extract_date) FROM exc) AND right(LIFNR, 1) <> '3' GROUP BY 1, 2, 3"""


@query(
    """SELECT rule_id, count(*) FILTER (WHERE e) AS expected, count(*) FILTER (WHERE d) AS detected, count(*) FILTER (WHERE e AND d) AS matched, count(*) FILTER (WHERE e AND NOT d) AS missed, count(*) FILTER (WHERE NOT e AND d) AS extra FROM
    (SELECT coalesce(m.rule_id, x.rule_id) AS rule_id, coalesce(m.e, false) AS e, coalesce(x.d, false) AS d FROM (SELECT rule_id, LIFNR, CASE WHEN rule_id = 'R05' THEN BUKRS ELSE '' END AS cc, bool_or(expected_flag) AS e FROM man GROUP BY 1, 2, 3) m
     FULL JOIN (SELECT rule_id, LIFNR, CASE WHEN rule_id = 'R05' THEN BUKRS ELSE '' END AS cc, bool_or(extract_date = (SELECT max(extract_date) FROM exc)) AS d FROM exc GROUP BY 1, 2, 3) x ON x.rule_id = m.rule_id AND x.LIFNR = m.LIFNR AND x.cc = m.cc) GROUP BY 1""",
    _RAW, _ALL + " man",
)
def reconcile(spark, sf_dir):
    """Against a key drawn from the last date's hits, with some left out and some marked as decoys."""
    hits = Frames(spark, sf_dir).summary
    last = hits.agg(F.max("extract_date").alias("extract_date"))
    key = hits.join(F.broadcast(last), "extract_date").where(F.right("LIFNR", F.lit(1)) != "3").groupBy("rule_id", "LIFNR", "BUKRS").agg(F.min("extract_date").alias("expected_first"))  # one row
    return verify.reconcile(hits, key.withColumn("expected_flag", F.right("LIFNR", F.lit(1)) != "7")).select("rule_id", "expected", "detected", "matched", "missed", "extra")


# Entity resolution ----------------------------------------------------------------------------------------


@query("SELECT LIFNR, name_norm, address_norm, zip5 FROM pv", "parties", "pv")
def normalized_parties(spark, sf_dir):
    return Frames(spark, sf_dir).parties.select("LIFNR", "name_norm", "address_norm", "zip5")


@query("SELECT LIFNR, area, first_token FROM keys", "parties", "pv keys")
def block_keys(spark, sf_dir):
    return Frames(spark, sf_dir).parties.select("LIFNR", "area", "first_token")


@query(
    """SELECT pass, key, count(*) AS n, count(*) > 1000 AS skipped, CASE WHEN count(*) > 1000 THEN 0 ELSE count(*) * (count(*) - 1) // 2 END::BIGINT AS pairs
    FROM (SELECT 'area' AS pass, area AS key FROM keys UNION ALL SELECT 'first_token', first_token FROM keys) WHERE key <> '' GROUP BY 1, 2 HAVING count(*) > 1""",
    "parties", "pv keys",
)
def block_stats(spark, sf_dir):
    return matching.blocks(Frames(spark, sf_dir).parties)


@query("SELECT * FROM pairs", "parties", "pv keys apairs pairs")
def candidate_pairs(spark, sf_dir):
    return matching.candidate_pairs(Frames(spark, sf_dir).parties)


@query("SELECT LIFNR_A, LIFNR_B, round(jaro_winkler_similarity(a.name_norm, b.name_norm), 6) AS jw FROM pairs JOIN pv a ON a.LIFNR = LIFNR_A JOIN pv b ON b.LIFNR = LIFNR_B", "parties", "pv keys apairs pairs")
def jw_scores(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    df = matching.candidate_pairs(v)
    for side in "AB":
        df = df.join(v.select(F.col("LIFNR").alias(f"LIFNR_{side}"), F.col("name_norm").alias(f"n{side}")), f"LIFNR_{side}")
    return df.select("LIFNR_A", "LIFNR_B", F.round(JARO_WINKLER("nA", "nB"), 6).alias("jw"))


@query()
def wratio_scores(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    return matching.candidates(matching.score_pairs(matching.candidate_pairs(v), v), "WRatio", 0.9, 91)


@query("SELECT * FROM truth", "parties", "pv truth")
def positive_pairs(spark, sf_dir):
    return matching.positive_pairs(Frames(spark, sf_dir).parties)


@query("SELECT *, (concat('0x', left(md5(LIFNR_A || '|' || LIFNR_B), 8))::BIGINT % 2)::INT AS fold FROM lab", "parties", "pv keys apairs pairs lab")
def label_and_fold(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    return matching.label_pairs(matching.candidate_pairs(v), v).withColumn("fold", matching.fold())


_CURVE = """SELECT {by} t::DOUBLE AS threshold, tp, fp, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1 END::DOUBLE AS p, coalesce(tp / nullif((SELECT count(*) FROM truth), 0), 0)::DOUBLE AS r
    FROM (SELECT {by} t, count(*) FILTER (WHERE label = 'match' AND score >= t) AS tp, count(*) FILTER (WHERE label = 'non_match' AND score >= t) AS fp FROM {rows}, range(40, 101) x(t) GROUP BY ALL))"""


@query(_CURVE.replace("{by}", "").replace("{rows}", "(SELECT label, name_one AS score FROM sc)"), "parties", _MATCH)
def pr_curve(spark, sf_dir):
    frames = Frames(spark, sf_dir)
    return matching.curve(frames.scored, "name_one", matching.positives(frames.parties))


@query(
    _CURVE.replace("{by}", "choice, weight,").replace("{rows}", "(SELECT label, choice, w AS weight, w * name_one + v * address_score AS score FROM sc, (VALUES " + ", ".join(f"({k}, {w!r}::DOUBLE, {1 - w!r}::DOUBLE)" for k, w in enumerate(matching.WEIGHTS)) + ") c(choice, w, v))"),
    "parties", _MATCH,
)
def grid_curves(spark, sf_dir):
    frames = Frames(spark, sf_dir)
    return matching.grid(frames.scored, matching.positives(frames.parties), scorers=("one",)).drop("scorer")


@query("SELECT label, count(*) FILTER (WHERE f = 0) AS dev, count(*) FILTER (WHERE f = 1) AS test FROM (SELECT *, concat('0x', left(md5(LIFNR_A || '|' || LIFNR_B), 8))::BIGINT % 2 AS f FROM lab) GROUP BY 1", "parties", "pv keys apairs pairs lab")
def crosstab_labels(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    df = matching.label_pairs(matching.candidate_pairs(v), v).withColumn("f", F.when(matching.fold() == 0, "dev").otherwise("test"))
    return df.groupBy("label").pivot("f", ["dev", "test"]).count().na.fill(0)


@query("SELECT LIFNR, state FROM (SELECT LIFNR, state, row_number() OVER (PARTITION BY state ORDER BY md5('7|' || LIFNR), LIFNR) AS r FROM pv) WHERE (state = 'Brand#1' AND r <= 9) OR (state = 'Brand#2' AND r <= 5)", "parties", "pv")
def stratified_sample(spark, sf_dir):
    """A sampling operator: fixed numbers for each stratum."""
    return matching.stratified(Frames(spark, sf_dir).parties, "state", {"Brand#1": 9, "Brand#2": 5}, ["LIFNR"]).select("LIFNR", "state")


@query(
    """SELECT g_name, g_address, g_zip, count(*) AS n FROM (SELECT CASE WHEN a.name_norm = '' OR b.name_norm = '' THEN -1 WHEN a.name_norm = b.name_norm THEN 4 WHEN jn >= 0.95 THEN 3 WHEN jn >= 0.88 THEN 2 WHEN jn >= 0.8 THEN 1 ELSE 0 END AS g_name,
    CASE WHEN a.address_norm = '' OR b.address_norm = '' THEN -1 WHEN a.address_norm = b.address_norm THEN 3 WHEN ja >= 0.95 THEN 2 WHEN ja >= 0.85 THEN 1 ELSE 0 END AS g_address, CASE WHEN a.zip5 = '' OR b.zip5 = '' THEN -1 WHEN a.zip5 = b.zip5 THEN 1 ELSE 0 END AS g_zip
    FROM pairs JOIN pv a ON a.LIFNR = LIFNR_A JOIN pv b ON b.LIFNR = LIFNR_B, LATERAL (SELECT jaro_winkler_similarity(a.name_norm, b.name_norm) AS jn, jaro_winkler_similarity(a.address_norm, b.address_norm) AS ja)) GROUP BY 1, 2, 3""",
    "parties", "pv keys apairs pairs",
)
def fs_gamma_counts(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    return matching.comparisons(matching.candidate_pairs(v), v).groupBy(*matching.GAMMAS).agg(F.count("*").alias("n"))


@query()
def fellegi_sunter(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    return matching.fellegi_sunter(v, matching.candidate_pairs(v, carried=matching.COMPARED))


@query(
    """SELECT count(*) AS vendor_rows, count(DISTINCT uei) AS distinct_ueis, (SELECT count(*) FROM (SELECT uei FROM pv GROUP BY 1 HAVING count(DISTINCT name) >= 2)) AS ueis_multi_spelling,
    (SELECT count(*) FROM pv a JOIN pv b ON a.uei = b.uei AND a.LIFNR < b.LIFNR) AS positive_pairs_all, (SELECT count(*) FROM (SELECT uei FROM pv GROUP BY 1 HAVING count(DISTINCT name_norm) >= 2)) AS ueis_multi_after_normalization,
    (SELECT count(*) FROM pv a JOIN pv b ON a.uei = b.uei AND a.LIFNR < b.LIFNR AND a.name <> b.name) AS positive_pairs_diff_name, (SELECT count(*) FROM pv a JOIN pv b ON a.uei = b.uei AND a.LIFNR < b.LIFNR AND a.name_norm <> b.name_norm) AS positive_pairs_diff_norm_name,
    (SELECT count(*) FROM pv a JOIN pv b ON a.parent_uei = b.parent_uei AND a.LIFNR < b.LIFNR AND a.uei <> b.uei WHERE a.parent_uei NOT IN ('', a.uei) AND b.parent_uei NOT IN ('', b.uei)) AS related_pairs_same_parent FROM pv""",
    "parties", "pv",
)
def pair_stats(spark, sf_dir):
    v = Frames(spark, sf_dir).parties
    return archives.pair_stats(v.withColumnRenamed("name", "name_raw"))


# Verification ---------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def stream_ingest(spark, sf_dir):
    """A file stream run twice over one checkpoint: the second run finds nothing new."""
    schema = spark.read.parquet(f"{sf_dir}/customer.parquet").schema
    folder = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    for _ in range(2):
        rows = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(sf_dir)
        ingest.run(rows, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query()
def fingerprint(spark, sf_dir):
    return verify.fingerprint(Frames(spark, sf_dir).history)


def _all() -> None:
    """Load the modules that register more."""
    from mandrel.plans import catalog_more  # noqa: F401


def queries() -> dict[str, Query]:
    _all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(_ORACLES)
