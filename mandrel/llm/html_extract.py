"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over a page's token stream: tags, constant texts, text slots,
optional groups and repeated groups. It is inferred by aligning pages of one host in turn: tandem repeats of
a page fold into repeated groups, equal items stay, unequal texts become slots, and what only one side has
becomes an optional group.

The wrapper tells where a host's articles are: its content path is found from the body down, into the one
container that has four fifths of the characters that fill slots and loses no heading, and ends at an article. What a
page has outside of it is no article text; what recurs inside of it is, and stays. A host without a wrapper is left with the
article element, if any. Where a page has neither, it is folded and matched with its host's wrapper, which tells the host's constant
texts from the slots that its pages fill: a block of which every text is constant is the host's and goes.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments inside go by their
element or class. A class counts as a whole: `sidebar` and `sidebar-box` mark a part, `has-sidebar` doesn't. No class drops
html or body. Where that leaves no article with text, the one with most text that is no advert or reader comment
stays, with all that it lies in, so a form around a whole page takes nothing away.

A text is constant only by pages that differ: copies count once, and of pages that share more than half of
their text one is fitted, so that what near copies share is not taken for the host's. Without two such pages a
host has no wrapper, and elements and classes alone decide. Texts that differ within a repeated group are slots.

Alignment takes n log n steps at any length: texts that are equal and single on both sides anchor it, between
them single tags, between those the k-th of each shape.

A wrapper is fitted on FITTED pages of a host at most, those whose ids hash lowest of its distinct ones; every page is extracted
whole. Wrappers, and ids of pages to fit, go to every task where their measured size allows, so no page moves;
beyond that they are joined by a shuffle, in which a host that a third of all pages share is split as skewed.

Defined results: a null or empty html has the text ''; a null or hostless url has no wrapper, and elements
and classes alone decide; pages whose ids hash alike are chosen by id; repeated rows are extracted each on its own, and
repeated ids with different html are different pages; very long pages are read whole; an empty table gives no rows and
no wrappers; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mandrel.llm.common import PARTS, small, staged

FITTED, PERIOD = 8, 8

#: Elements whose content is no text, that are never article text, and that break lines.
RAW = frozenset("script style noscript template svg math iframe object textarea title select".split())
NEVER = RAW | frozenset("nav footer aside form button dialog menu head".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that can hold an article, and those that name one.
CONTAINER = frozenset("body main article section div td center".split())
HEADING = frozenset("h1 h2".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role that mark what is no article; those of the second row only outside of one.
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion sidebar nav navbar navigation menu footer "
    "cookie cookies consent gdpr notice notices popup modal overlay comment comments disqus replies share sharing social related "
    "breadcrumb breadcrumbs newsletter subscribe subscription widget login signup contentinfo complementary search".split()
)
OUTSIDE = frozenset("header masthead banner topbar toolbar alert".split())
#: Of the first row, what is never an article; words that say no more of a part than where or how it is shown; names of an article.
FOREIGN = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion comment comments disqus replies hidden".split())
SHOWN = frozenset("area bar block body bottom box button buttons center container form frame inner item items left link links list outer panel right section site slot top unit wrap wrapper".split())
MAIN = frozenset("main main-content content-main".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_SPACE = re.compile(r"\s+")

#: kind, name, mark: ("open", element, class words), ("close", element, ""), ("text", text, "").
Token = tuple[str, str, str]


def tokenise(page: str) -> list[Token]:
    out: list[Token] = []
    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            out.append(("text", page[at:], ""))
            break
        if m.start() > at:
            out.append(("text", page[at : m.start()], ""))
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            out.append(("close", name, ""))
            continue
        words: set[str] = set()
        for key, value in _ATTRIBUTE.findall(m[3]) if m[3].strip() else ():
            value = value.strip("\"'").lower()
            if key.lower() in ("hidden", "aria-hidden"):
                words |= {"hidden"} if value != "false" else set()
            else:
                words |= set(value.split())
        out.append(("open", name, " ".join(sorted(words))))
        if name in RAW and not m[3].rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            out.append(("close", name, ""))
    return [t for t in out if t[0] != "text" or t[1].strip()]


def fold(items: list) -> list:
    """Collapse tandem repeats: items that repeat with a period become ["*", group, count]."""
    key = [shape(x) for x in items]
    out: list = []
    at, n = 0, len(items)
    while at < n:
        for period in range(1, PERIOD + 1):
            if key[at : at + period] == key[at + period : at + 2 * period] and at + 2 * period <= n:
                times = 2
                while key[at : at + period] == key[at + times * period : at + (times + 1) * period]:
                    times += 1
                group = items[at : at + period]
                for k in range(1, times):
                    group = [merged(a, b) for a, b in zip(group, items[at + k * period : at + (k + 1) * period], strict=True)]
                out.append(["*", group, times])
                at += times * period
                break
        else:
            out.append(items[at])
            at += 1
    return out


def shape(item) -> str:
    """What must be equal for two items to align; texts always may."""
    if item[0] == "text":
        return "#"
    if item[0] in ("*", "?"):
        return "*(" + " ".join(map(shape, item[1])) + ")"
    return f"{item[0]} {item[1]} {item[2]}"


def merged(a, b):
    """Two items of one shape: equal texts stay constant, others become a slot (None), with the characters of both."""
    if a[0] == "text":
        return ["text", a[1] if a[1] == b[1] else None, a[2] + b[2]]
    if a[0] in ("*", "?"):
        return [a[0], [merged(x, y) for x, y in zip(a[1], b[1], strict=True)], *a[2:]]
    return list(a)


def rising(a: dict, b: dict) -> list[tuple[int, int]]:
    """The most pairs of places of common keys that rise on both sides. a is in the order of its places."""
    pairs = [(i, b[k]) for k, i in a.items() if k in b]
    ends: list[int] = []
    at: list[int] = []
    before = [-1] * len(pairs)
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before[n] = at[k - 1] if k else -1
        ends[k : k + 1], at[k : k + 1] = [j], [n]
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _keys(items: list, shapes: list[str], low: int, high: int, level: int) -> dict:
    """Places by what anchors a level: single texts with what is before them, single shapes, the k-th of each shape."""
    seen: Counter = Counter()
    out = {}
    for i in range(low, high):
        key: object = shapes[i]
        if level == 0:
            if key != "#" or items[i][1] is None:
                continue
            key = (shapes[i - 1] if i else "", items[i][1])
        seen[key] += 1
        out[(key, seen[key]) if level == 2 else key] = i
    return out if level == 2 else {k: i for k, i in out.items() if seen[k] == 1}


def aligned(a: list, b: list) -> list[tuple[int, int]]:
    """Places of items of one shape, in order: three levels of anchors, each between those of the one before."""
    sa, sb = [shape(x) for x in a], [shape(x) for x in b]
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b), 0)]
    while work:
        a0, a1, b0, b1, level = work.pop()
        while level and a0 < a1 and b0 < b1 and sa[a0] == sb[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while level and a0 < a1 and b0 < b1 and sa[a1 - 1] == sb[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if level == 3 or a0 == a1 or b0 == b1:
            continue
        for i, j in [*rising(_keys(a, sa, a0, a1, level), _keys(b, sb, b0, b1, level)), (a1, b1)]:
            work.append((a0, i, b0, j, level + 1))
            if i < a1:
                out.append((i, j))
            a0, b0 = i + 1, j + 1
    return sorted(out)


def align(wrapper: list, page: list) -> list:
    """One step of inference: the least wrapper of both, without unions."""
    out: list = []
    a = b = 0
    for i, j in [*aligned(wrapper, page), (len(wrapper), len(page))]:
        out += [["?", [blank(x)]] for x in wrapper[a:i] + page[b:j]]
        if i < len(wrapper):
            out.append(merged(wrapper[i], page[j]))
        a, b = i + 1, j + 1
    return out


def blank(item):
    """An item with slots for its texts: what not every page has is no constant of the host."""
    if item[0] == "text":
        return ["text", None, item[2]]
    return [item[0], [blank(x) for x in item[1]], *item[2:]] if item[0] in ("*", "?") else item


def unlike(pages: list[str]) -> list[str]:
    """Pages of which no two share more than half of the shorter one's text; the first of near copies stays."""
    out: list[str] = []
    known: list[set[str]] = []
    size = lambda blocks: sum(map(len, blocks))
    for page in pages:
        blocks = set(extract(page).split("\n\n"))
        if size(blocks) and all(2 * size(blocks & x) <= min(size(blocks), size(x)) for x in known):
            out.append(page)
            known.append(blocks)
    return out


def infer(pages: list[str]) -> list:
    """The wrapper of same-host pages; empty without two pages that differ."""
    pages = unlike(pages)
    if len(pages) < 2:
        return []
    wrapper: list | None = None
    for page in pages:
        folded = fold([[*t[:2], len(t[1].strip())] if t[0] == "text" else list(t) for t in tokenise(page)])
        wrapper = folded if wrapper is None else flat(align(flat(wrapper), folded))
    return wrapper or []


def flat(wrapper: list) -> list:
    """Optional groups as their items, marked, so that a later page can align with them."""
    out = []
    for x in wrapper:
        if x[0] == "?":
            out += x[1]
        else:
            out.append(x)
    return out


def constants(wrapper: list, tokens: list[Token]) -> set[int]:
    """Positions of the page's text tokens that the wrapper holds as constant, those of repeated groups too."""
    folded = fold([list(t) for t in tokens])
    starts, at = [], 0
    for x in folded:
        starts.append(at)
        at += len(x[1]) * x[2] if x[0] == "*" else 1
    found = set()
    for i, j in aligned(wrapper, folded):
        group, times = (wrapper[i][1], folded[j][2]) if folded[j][0] == "*" else ([wrapper[i]], 1)
        for k in range(len(group) * times):
            want, at = group[k % len(group)], starts[j] + k
            if want[0] == "text" and want[1] is not None and want[1] == tokens[at][1]:
                found.add(at)
    return found


def unfolded(items: list, many: bool = False) -> Iterator[tuple]:
    """(item, whether it is one of many) for every plain item, groups opened."""
    for x in items:
        if x[0] in ("*", "?"):
            yield from unfolded(x[1], many or x[0] == "*")
        else:
            yield x, many


def step(path: list[str], kind: str, name: str, mark: str) -> bool:
    """Follow the containers of a token stream; whether one opened. Other elements, often left open, are no part of a path."""
    if name not in CONTAINER:
        return False
    if kind == "open":
        path.append(f"{name} {mark}".rstrip())
        return True
    for up in range(len(path) - 1, -1, -1):
        if path[up].split(" ", 1)[0] == name:
            del path[up:]
            break
    return False


def is_article(step: str) -> bool:
    name, _, mark = step.partition(" ")
    return name in ("article", "main") or not MAIN.isdisjoint(mark.split())


@lru_cache(maxsize=1 << 12)
def marked(mark: str, by: frozenset[str]) -> bool:
    """Whether a class is a word of by, or made of these and of words that mark a part too or only tell how it is shown."""
    for name in mark.split():
        parts = set(re.split(r"[^a-z0-9]+", name)) - {""}
        if not parts.isdisjoint(by) and parts <= MARKED | OUTSIDE | SHOWN | by:
            return True
    return False


class Elements:
    """Every element of a token stream: what it lies in, and whether it is an article, or none."""

    def __init__(self, tokens: list[Token], starts: set[int]):
        self.at: dict[int, int] = {}  # token to element
        self.owner = [-1] * len(tokens)  # the element that a token lies in
        self.up: list[int] = []
        self.away: list[bool] = []
        self.foreign: list[bool] = []
        self.start: list[bool] = []
        inside: list[bool] = []
        stack: list[int] = []
        names: list[str] = []
        for k, (kind, name, mark) in enumerate(tokens):
            self.owner[k] = stack[-1] if stack else -1
            if kind == "open" and name not in VOID:
                up = self.owner[k]
                self.at[k] = len(self.up)
                inside.append((up >= 0 and inside[up]) or k in starts)
                classed = name not in ("html", "body")
                outer = not inside[-1] and (name == "header" or (classed and marked(mark, OUTSIDE)))
                self.away.append(name in NEVER or outer or (classed and (marked(mark, MARKED) or "hidden" in mark.split())))
                self.foreign.append((up >= 0 and self.foreign[up]) or (classed and marked(mark, FOREIGN)))
                self.start.append(k in starts)
                stack.append(len(self.up))
                names.append(name)
                self.up.append(up)
            elif kind == "close":
                for n in range(len(names) - 1, -1, -1):
                    if names[n] == name:
                        del stack[n:], names[n:]
                        break
        self.size = [0] * len(self.up)
        for k, (kind, name, _) in enumerate(tokens):
            if kind == "text" and self.owner[k] >= 0:
                self.size[self.owner[k]] += len(name.strip())

    def dropped(self) -> list[bool]:
        out: list[bool] = []
        for up, away in zip(self.up, self.away, strict=True):
            out.append(away or (up >= 0 and out[up]))
        return out

    def below(self, keep: list[bool]) -> list[int]:
        """Characters of text below each element, in elements that are kept."""
        out = [n if k else 0 for n, k in zip(self.size, keep, strict=True)]
        for n in range(len(out) - 1, -1, -1):
            if self.up[n] >= 0:
                out[self.up[n]] += out[n]
        return out

    def settle(self) -> bool:
        """Decide which articles count, so that one with text is kept if any is; whether there is one."""
        dropped = self.dropped()
        kept = self.below([not d for d in dropped])
        if any(s and not d and n for s, d, n in zip(self.start, dropped, kept, strict=True)):
            return True
        whole = self.below([True] * len(self.up))
        best = max((n for n, s in enumerate(self.start) if s and whole[n] and not self.foreign[n]), key=lambda n: whole[n], default=None)
        self.start = [n == best for n in range(len(self.up))]
        if best is None:
            return False
        while best >= 0:
            self.away[best] = False
            best = self.up[best]
        return True

    def inside(self) -> list[bool]:
        out: list[bool] = []
        for up, start in zip(self.up, self.start, strict=True):
            out.append(start or (up >= 0 and out[up]))
        return out


def content_path(wrapper: list) -> list[str]:
    """The containers down to the one where slots are; empty if that is the whole page."""
    path: list[str] = []
    size: Counter = Counter()  # characters in slots, and of them in headings
    heads: Counter = Counter()
    opened: Counter = Counter()
    heading = False
    for (kind, name, mark), many in unfolded(wrapper):
        if kind == "text":
            if name is None:
                for n in range(len(path) + 1):
                    size[tuple(path[:n])] += mark
                    heads[tuple(path[:n])] += mark if heading else 0
        elif name in HEADING:
            heading = kind == "open"
        elif step(path, kind, name, mark):
            opened[tuple(path)] += 2 if many else 1
    at: tuple = ()
    while not (at and is_article(at[-1])):
        below = [x for x in size if len(x) == len(at) + 1 and x[: len(at)] == at]
        best = max(below, key=lambda x: (size[x], x), default=None)
        if best is None or opened[best] > 1 or 5 * size[best] < 4 * size[at] or heads[best] < heads[at]:
            break
        at = best
    return list(at) if len(at) > 1 or (at and is_article(at[-1])) else []


def extract(page: str | None, wrapper: list | None = None, root: list[str] | None = None) -> str:
    """The main text: blocks in page order, joined by an empty line. root: the wrapper's content path, if it is known already."""
    tokens = tokenise(page or "")
    root = content_path(wrapper) if wrapper and root is None else root or []
    path: list[str] = []
    steps = [tuple(path) if step(path, *t) else None for t in tokens]
    starts = {k for k, (t, at) in enumerate(zip(tokens, steps, strict=True)) if (at and list(at) == root) or (t[0] == "open" and is_article(f"{t[1]} {t[2]}"))}
    elements = Elements(tokens, starts)
    has_article = elements.settle()
    dropped, inside = [*elements.dropped(), False], [*elements.inside(), not has_article]  # the last is the page itself
    if not has_article:
        inside = [True] * len(inside)
    # Constants of the host tell only where no container does.
    fixed = constants(wrapper, tokens) if wrapper and not has_article else set()
    blocks, line = [], []
    slots = False

    def flush() -> None:
        nonlocal slots
        text = _SPACE.sub(" ", html.unescape("".join(line))).strip()
        if text and slots:
            blocks.append(text)
        line.clear()
        slots = False

    for k, (kind, name, _) in enumerate(tokens):
        if kind == "text":
            owner = elements.owner[k]
            if not dropped[owner] and inside[owner]:
                line.append(name)
                slots = slots or k not in fixed
        elif name == "br":
            line.append(" ")
        elif name in BLOCK or name in NEVER:
            flush()
    flush()
    return "\n\n".join(blocks)


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    """At most FITTED pages, in a fixed order; no row without a wrapper."""
    wrapper = infer(sorted(group["html"].dropna().unique())[:FITTED])
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(wrapper)]}) if wrapper else pd.DataFrame({"host": [], "wrapper": []}, dtype=str)


def wrappers(pages: DataFrame, fitted: int = FITTED) -> DataFrame:
    """(host, wrapper) for hosts with two pages or more that differ. Of equal pages the one whose id hashes lowest counts."""
    pages = pages.select("page_id", "url", "html")
    order = Window.partitionBy("host").orderBy(F.xxhash64("page_id"), "page_id")
    single = pages.where("html is not null").groupBy(host().alias("host"), F.xxhash64("html").alias("copy")).agg(F.min_by("page_id", F.struct(F.xxhash64("page_id"), "page_id")).alias("page_id"))
    # Ranked by parts of a host first, so that a host that most pages share sends few rows to one task.
    in_part = Window.partitionBy("host", "part").orderBy(F.xxhash64("page_id"), "page_id")
    ids = single.where("host != ''").withColumn("part", F.pmod(F.xxhash64("page_id", F.lit(1)), F.lit(PARTS)))
    ids = ids.withColumn("r", F.row_number().over(in_part)).where(F.col("r") <= fitted).withColumn("r", F.row_number().over(order)).where(F.col("r") <= fitted)
    many = ids.groupBy("host").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    chosen = staged(ids.join(many, "host").select("page_id", "copy").distinct(), "fitted")
    sample = pages.withColumn("copy", F.xxhash64("html")).join(small(chosen, F.lit(64)), ["page_id", "copy"], "left_semi")
    # Rows that repeat a page are one; so a host has `fitted` pages in its group, and no more.
    sample = sample.select(host().alias("host"), "html", "copy").dropDuplicates(["host", "copy"]).select("host", "html")
    return sample.groupBy("host").applyInPandas(_fit, "host string, wrapper string")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[list, list[str]]] = {}
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            texts = []
            for page, text in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                if text is not None and text not in known:
                    if len(known) >= 64:
                        known.clear()
                    wrapper = flat(json.loads(text))
                    known[text] = (wrapper, content_path(wrapper))
                texts.append(extract(page, *known.get(text, ())))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text for every page."""
    pages = pages.select("page_id", "url", "html")
    found = staged(wrappers(pages), "wrappers")
    found = small(found, F.octet_length("host") + F.octet_length("wrapper") + 64)
    joined = pages.withColumn("host", host()).join(found, "host", "left")
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(_extracted, schema)
