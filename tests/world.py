"""A small seeded world of vendors with an answer key: daily extracts in which every rule has cases and decoys.

Cases go to vendors by their number, so each vendor has one story. A fixture for tests and demonstrations:
its size is a parameter of the driver, and its files are written from the driver.
"""

from __future__ import annotations

import random
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from mandrel.sources.bronze import COLUMNS

OPEN_END = "99991231235959"
FIRST, EMPLOYEE, ONE_TIME = 100001, 900001, 800001
STORIES = 24


@dataclass(frozen=True)
class World:
    seed: int = 42
    start: date = date(2026, 9, 1)
    days: int = 6
    vendors: int = 60
    employees: int = 3
    second_code: float = 0.5

    @property
    def dates(self) -> list[date]:
        return [self.start + timedelta(k) for k in range(self.days)]


@dataclass
class Case:
    rule_id: str
    variant: str
    expected_flag: bool
    LIFNR: str
    BUKRS: str = ""
    OTHER_LIFNR: str = ""
    expected_first: date | None = None


@dataclass
class _State:
    tables: dict[str, dict[tuple, dict]] = field(default_factory=lambda: defaultdict(dict))
    lines: list[dict] = field(default_factory=list)
    changes: dict[date, list[tuple[datetime, str, list[dict]]]] = field(default_factory=lambda: defaultdict(list))
    cases: list[Case] = field(default_factory=list)


def _dats(d: date) -> str:
    return f"{d:%Y%m%d}"


def _row(table: str, **values: str) -> dict[str, str]:
    return {c: values.get(c, "") for c in COLUMNS[table].split()}


class Simulator:
    def __init__(self, world: World = World()):  # noqa: B008
        self.w, self.rng, self.s = world, random.Random(world.seed), _State()
        self.documents = 0

    # Master data

    def _vendor(self, number: int, group: str) -> str:
        lifnr, w = f"{number:010d}", self.w
        t = self.s.tables
        created = _dats(w.start - timedelta(100 if group != "KRED" else 900))
        t["LFA1"][lifnr,] = _row("LFA1", LIFNR=lifnr, KTOKK=group, NAME1=f"VENDOR {number} INC", ADRNR=f"A{number}", LAND1="US", ERDAT=created, XCPDK="X" if group == "CPD" else "")
        partner, guid = f"P{number}", f"{self.rng.getrandbits(128):032X}"
        t["BUT000"][partner,] = _row("BUT000", PARTNER=partner, PARTNER_GUID=guid, TYPE="2", NAME_ORG1=f"VENDOR {number} INC")
        t["CVI_VEND_LINK"][lifnr,] = _row("CVI_VEND_LINK", PARTNER_GUID=guid, VENDOR=lifnr)
        t["ADRC"][f"A{number}", ""] = _row("ADRC", ADDRNUMBER=f"A{number}", DATE_FROM="00010101", NAME1=f"VENDOR {number} INC", STREET=f"{number % 99 + 1} MAIN ST", CITY1="TOWN", POST_CODE1=f"{20000 + number % 7000}", REGION="VA", COUNTRY="US")
        t["DFKKBPTAXNUM"][partner,] = _row("DFKKBPTAXNUM", PARTNER=partner, TAXTYPE="US1", TAXNUM=f"00-{number:07d}")
        t["LFBK"][lifnr,] = _row("LFBK", LIFNR=lifnr, BANKS="US", BANKL="121000358", BANKN=f"{self.rng.randrange(10**9):012d}{number % 1000:03d}")
        bank = t["LFBK"][lifnr,]
        t["BUT0BK"][partner, "0001"] = _row("BUT0BK", PARTNER=partner, BKVID="0001", BANKS="US", BANKL=bank["BANKL"], BANKN=bank["BANKN"], BK_VALID_FROM="20200101000000", BK_VALID_TO=OPEN_END)
        codes = ["1000"] + (["2000"] if group == "KRED" and self.rng.random() < w.second_code else [])
        for code in codes:
            t["LFB1"][lifnr, code] = _row("LFB1", LIFNR=lifnr, BUKRS=code, AKONT="160000", ZTERM="NT30", ZWELS="T", REPRF="X", PERNR=f"{number % 10**6:08d}" if group == "ZEMP" else "", ERDAT=created)
        return lifnr

    # Journal: a vendor line, its offset, both ledgers

    def _post(self, lifnr: str, kind: str, day: date, amount: float, due: date | None = None, cleared: date | None = None, by: str = "", code: str = "1000") -> str:
        self.documents += 1
        number = f"{self.documents:010d}"
        if kind == "KZ":  # a payment clears itself with what it pays
            cleared, by = day, number
        for ledger in ("0L", "2L"):
            for line, (account, sign) in enumerate((("K", 1), ("S", -1)), 1):
                self.s.lines.append({
                    "day": day, "cleared": cleared, "by": by,
                    "row": _row("ACDOCA", RLDNR=ledger, RBUKRS=code, GJAHR=str(day.year), BELNR=number, DOCLN=f"{line:06d}", KOART=account, RACCT="160000", LIFNR=lifnr if account == "K" else "", BLART=kind, BUDAT=_dats(day), HSL=f"{sign * amount:.2f}", RHCUR="USD", NETDT=_dats(due) if due and account == "K" else ""),
                })
        return number

    def _bought(self, lifnr: str, day: date, due: date, paid: date | None = None) -> None:
        amount = round(self.rng.uniform(50, 5000), 2)
        by = self._post(lifnr, "KZ", paid, amount) if paid else ""
        self._post(lifnr, "KR", day, -amount, due, paid, by)

    # Change documents

    def _change(self, day: date, clock: str, lifnr: str, items: Iterable[dict]) -> None:
        self.s.changes[day].append((datetime.strptime(f"{day} {clock}", "%Y-%m-%d %H:%M"), lifnr, list(items)))

    def _set(self, day: date, lifnr: str, table: str, name: str, value: str, code: str = "", clock: str = "10:00") -> None:
        key = "100" + lifnr + code
        self._change(day, clock, lifnr, [{"TABNAME": table, "TABKEY": key, "FNAME": name, "CHNGIND": "U", "VALUE_NEW": value}])

    def _new_bank(self, day: date, clock: str, lifnr: str, account: str) -> None:
        key = f"100{lifnr}{'US':<3}{'121000358':<15}{account:<18}"
        self._change(day, clock, lifnr, [{"TABNAME": "LFBK", "TABKEY": key, "FNAME": "KEY", "CHNGIND": c, "VALUE_NEW": account if c == "I" else ""} for c in "DI"])

    # Stories

    def _case(self, rule: str, variant: str, lifnr: str, first: date | None, flag: bool = True, code: str = "", other: str = "") -> None:
        self.s.cases.append(Case(rule, variant, flag, lifnr, code, other, first))

    def _tell(self, v: list[str], staff: list[str], once: list[str]) -> None:
        w, t, day = self.w, self.s.tables, self.w.dates
        start, past = w.start, w.start - timedelta(40)
        quiet = {6, 7, 8, 15}
        for k, lifnr in enumerate(v):
            if k not in quiet:
                self._bought(lifnr, past - timedelta(10), past, past)
                self._bought(lifnr, past, start + timedelta(60))
        account = lambda k: t["LFBK"][v[k],]["BANKN"]
        # Changed, paid and changed again: within a day, and over days; a decoy without payment.
        self._new_bank(day[2], "08:15", v[0], "777000")
        self._bought(v[0], past, day[2], day[2])
        self._new_bank(day[2], "16:45", v[0], account(0))
        self._case("R02", "same_day", v[0], day[2])
        self._new_bank(day[1], "09:00", v[1], "777001")
        self._bought(v[1], past, day[2], day[2])
        self._new_bank(day[3], "09:00", v[1], account(1))
        self._case("R02", "over_days", v[1], day[3])
        self._new_bank(day[1], "09:00", v[2], "777002")
        self._new_bank(day[2], "09:00", v[2], account(2))
        self._case("R02", "no_payment", v[2], None, flag=False)
        for k in (0, 1):
            self._case("R08", "after_change", v[k], day[2])
        # One account, two holders; one with an employee.
        for k, other in ((3, v[4]), (5, staff[0])):
            for c in ("BANKS", "BANKL", "BANKN"):
                t["LFBK"][v[k],][c] = t["LFBK"][other,][c]
            for a, b in ((v[k], other), (other, v[k])):
                self._case("R03", "shared", a, start, other=b)
        # Dormant: open, blocked, and with a purchasing block only.
        for k in (6, 7, 8):
            self._bought(v[k], start - timedelta(700), start - timedelta(650), start - timedelta(640))
            t["LFA1"][v[k],].update(SPERR="X" if k == 7 else "", SPERM="X" if k == 8 else "")
            self._case("R04", "dormant", v[k], start if k != 7 else None, flag=k != 7)
        t["LFB1"][v[9], "1000"]["REPRF"] = ""
        self._case("R05", "from_start", v[9], start, code="1000")
        self._set(day[2], v[10], "LFB1", "REPRF", "", "1000")
        self._case("R05", "changed", v[10], day[2], code="1000")
        t["LFA1"][v[11],]["LNRZA"] = v[20]
        t["LFB1"][v[12], "1000"]["LNRZB"] = v[20]
        t["LFA1"][v[13],]["XZEMP"] = "X"
        for k in (11, 12, 13):
            self._case("R06", "payee", v[k], start)
        self._bought(once[0], past, past, past + timedelta(3))
        self._bought(once[0], past, past, past + timedelta(6))
        self._case("R06", "one_time_repeat", once[0], start)
        self._bought(once[1], past, past, past + timedelta(3))
        self._case("R06", "one_time_single", once[1], None, flag=False)
        # An unconfirmed change with an item due; and without.
        self._bought(v[14], past, start + timedelta(3))
        for k in (14, 15):
            self._set(day[1], v[k], "LFA1", "CONFS", "1")
            self._case("R07", "unconfirmed", v[k], day[1] if k == 14 else None, flag=k == 14)
        self._bought(v[15], start - timedelta(100), past, past)
        # A bank change with and without a payment after it.
        for k in (16, 17):
            self._new_bank(day[1], "11:00", v[k], f"88800{k}")
        self._bought(v[16], past, day[3], day[3])
        self._case("R08", "after_change", v[16], day[3])
        self._case("R08", "no_payment", v[17], None, flag=False)
        # Defects of the data.
        t["LFBK"][v[18],]["BANKN"] = ""
        self._post(v[19], "ZZ", past, 10.0)
        t["LFBK"][v[20],]["BANKL"] = "12100035"
        t["LFB1"][v[21], "1000"]["ZTERM"] = "XX99"
        del t["CVI_VEND_LINK"][v[22],]
        t["ADRC"][f"A{int(v[23])}", ""]["COUNTRY"] = "CA"
        for k, name in enumerate(("bank_key_present", "known_doc_type", "routing_number_9_digits", "known_payment_terms", "has_business_partner", "us_address"), 18):
            self._case("DQ", name, v[k], None, flag=False)

    # Days

    def _apply(self, day: date, number: int) -> tuple[list[dict], list[dict], int]:
        heads, items = [], []
        for at, lifnr, changed in sorted(self.s.changes.get(day, []), key=lambda x: (x[0], x[1])):
            number += 1
            nr = f"{number:010d}"
            heads.append(_row("CDHDR", OBJECTCLAS="KRED", OBJECTID=lifnr, CHANGENR=nr, USERNAME="CLERK", UDATE=f"{at:%Y%m%d}", UTIME=f"{at:%H%M%S}", TCODE="XK02", CHANGE_IND="U"))
            for c in changed:
                items.append(_row("CDPOS", OBJECTCLAS="KRED", OBJECTID=lifnr, CHANGENR=nr, **c))
                if c["TABNAME"] == "LFBK" and c["CHNGIND"] == "I":
                    self.s.tables["LFBK"][lifnr,]["BANKN"] = c["VALUE_NEW"]
                elif c["TABNAME"] == "LFA1":
                    self.s.tables["LFA1"][lifnr,][c["FNAME"]] = c["VALUE_NEW"]
                elif c["TABNAME"] == "LFB1":
                    self.s.tables["LFB1"][lifnr, c["TABKEY"][13:17]][c["FNAME"]] = c["VALUE_NEW"]
        return heads, items, number

    def _journal(self, day: date) -> list[dict]:
        """New and newly cleared lines; the first day brings all history."""
        out = []
        for x in self.s.lines:
            fresh = x["day"] == day or (day == self.w.start and x["day"] < day)
            done = x["cleared"] is not None and x["cleared"] <= day
            just = x["cleared"] == day and x["day"] < day
            if fresh or just:
                out.append(x["row"] | ({"AUGBL": x["by"], "AUGDT": _dats(x["cleared"])} if done else {}))
        return out

    def run(self) -> tuple[dict[date, dict[str, list[dict]]], list[Case]]:
        w = self.w
        v = [self._vendor(FIRST + k, "KRED") for k in range(max(w.vendors, STORIES + 1))]
        staff = [self._vendor(EMPLOYEE + k, "ZEMP") for k in range(w.employees)]
        once = [self._vendor(ONE_TIME + k, "CPD") for k in range(2)]
        self._tell(v, staff, once)
        out, number = {}, 0
        for day in w.dates:
            heads, items, number = self._apply(day, number)
            shot = {n: [dict(r) for r in rows.values()] for n, rows in self.s.tables.items()}
            out[day] = shot | {"ACDOCA": self._journal(day), "CDHDR": heads, "CDPOS": items}
        return out, self.s.cases


def write(extracts: dict[date, dict[str, list[dict]]], staging: str) -> None:
    """<table>/extract_date=<day>/<table>.parquet, all columns text; empty days stay typed."""
    for day, tables in extracts.items():
        for name, text in COLUMNS.items():
            schema = pa.schema([(c, pa.string()) for c in text.split()])
            folder = Path(staging) / name / f"extract_date={day}"
            folder.mkdir(parents=True, exist_ok=True)
            pq.write_table(pa.Table.from_pylist(tables.get(name, []), schema), folder / f"{name}.parquet")
