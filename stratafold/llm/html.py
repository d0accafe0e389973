"""HTML to text by layout-aware rendering.

A page is parsed into a stream of properly nested elements: a builder implies the tags that HTML lets authors leave out (paragraphs, list
items, table parts) and closes what is left open. Visibility rules drop what a browser wouldn't show: elements that hide by kind, attribute, style or
a rule of the page's own style sheets with a simple selector, closed details but for their summary, all but the chosen option of a menu. A renderer then lays out what is left: blocks
on lines of their own, with blank lines where margins are; lists with markers and indents; preformatted text as it is; tables as rows with
cells padded to their columns, those of several rows or columns in their places. Both work on a stack of their own, so deep nesting needs no recursion.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import in_batches, lean, table

# Fixed sets of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style template noscript iframe canvas audio video datalist meta link base area map defs desc metadata symbol clippath annotation annotation-xml".split())
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure form fieldset hr".split())
BLOCK = MARGIN | frozenset("html body div section article aside header footer nav main address li dt dd figcaption details summary dialog legend center caption tr td th thead tbody tfoot".split())
CLOSE_P = BLOCK - frozenset("html body caption tr td th thead tbody tfoot".split())
#: An opening tag closes open elements of the first set, up to the nearest one of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    **{x: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for x in ("thead", "tbody", "tfoot")},
    "body": ({"head"}, {"html"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
}
#: Ends of inner elements stop at these.
SCOPE = frozenset({"table", "td", "th", "caption", "html"})
_SPACE = re.compile("[ \t\n\f\r]+")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*(none\b)?", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
_AT_RULE = re.compile(r"@[^{;]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})")
_RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
_SELECTOR = re.compile(r"([a-z][a-z0-9-]*)?((?:[.#][\w-]+)*)", re.I)


def _shown(style: str) -> tuple[bool | None, bool | None]:
    """What declarations say: whether the element is there, and whether it is visible; None where they don't say."""
    display, visibility = _DISPLAY.findall(style), _VISIBILITY.findall(style)
    return (not display[-1] if display else None), (visibility[-1].lower() == "visible" if visibility else None)


def _rules(sheet: str) -> list[tuple[str, frozenset[str], tuple]]:
    """(tag or nothing, classes and ids with their marks, what the declarations say) of the rules with simple selectors that show or hide. Rules
    for some media only are left."""
    found = []
    for selectors, style in _RULE.findall(_AT_RULE.sub("", re.sub(r"/\*.*?\*/", "", sheet, flags=re.S))):
        said = _shown(style)
        for selector in selectors.split(",") if said != (None, None) else ():
            match = _SELECTOR.fullmatch(selector.strip())
            if match and match[0]:
                found.append(((match[1] or "").lower(), frozenset(re.findall(r"[.#][\w-]+", match[2])), said))
    return found


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in text)


class _Flow:
    """Lines of a block, in the making."""

    def __init__(self, pre: bool = False) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False
        self.pre = pre

    def text(self, data: str) -> None:
        if self.pre:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.inline.append(first)
            for line in rest:
                self.end(keep=True)
                self.inline.append(line)
        else:
            self.inline.append(data)

    def end(self, keep: bool = False) -> None:
        """Ends the line; keep: even an empty one."""
        line = "".join(self.inline)
        self.inline = []
        line = line.rstrip() if self.pre else _SPACE.sub(" ", line).strip(" ")
        if line or keep:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.gap and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = False
        self.lines += lines

    def margin(self) -> None:
        self.end()
        self.gap = True

    def done(self) -> list[str]:
        self.end()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []  # lines, columns and rows of each cell
        self.caption: list[str] = []

    def _placed(self) -> list[list[tuple[int, list[str], int]]]:
        """(first column, lines, columns) of each row's cells; where a cell of an earlier row reaches down there is a cell without lines."""
        out, down = [], {}  # column: (rows left, columns) of the cell that begins there
        for row in self.rows:
            cells, at, waiting = [], 0, list(row)
            while waiting or any(c >= at for c in down):
                if at in down:
                    left, wide = down.pop(at)
                    cells.append((at, [], wide))
                    if left > 1:
                        down[at] = left - 1, wide
                    at += wide
                    if left > 1:
                        continue
                elif waiting:
                    lines, wide, high = waiting.pop(0)
                    nearest = min((c for c in down if c > at), default=at + wide)
                    wide = min(wide, nearest - at)  # it can't reach into a column that is taken
                    cells.append((at, lines, wide))
                    if high > 1:
                        down[at] = high - 1, wide
                    at += wide
                else:
                    ahead = min(c for c in down if c >= at)
                    cells.append((at, [], ahead - at))
                    at = ahead
                    continue
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        rows = self._placed()
        widths = [0] * max((at + wide for row in rows for at, _, wide in row), default=0)
        for row in rows:
            for at, lines, wide in row:
                if wide == 1:
                    widths[at] = max([widths[at], *map(_width, lines)])
        for row in rows:  # a spanning cell widens its last column
            for at, lines, wide in row:
                if wide > 1:
                    have = sum(widths[at : at + wide]) + 3 * (wide - 1)
                    widths[at + wide - 1] += max(0, max(map(_width, lines), default=0) - have)
        out = list(self.caption)
        for row in rows:
            for i in range(max((len(lines) for _, lines, _ in row), default=0)):
                line = []
                for at, lines, wide in row:
                    text = lines[i] if i < len(lines) else ""
                    line.append(text + " " * (sum(widths[at : at + wide]) + 3 * (wide - 1) - _width(text)))
                out.append(" | ".join(line).rstrip())
        return out


#: Kinds of elements whose content is laid out by itself.
_OWN_FLOW = ("indent", "pre", "cell", "caption", "table", "menu", "option", "area")


class _Page(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []  # names of open elements
        self.count: Counter[str] = Counter()  # and how often each is among them
        self.dark = 0  # how many of them, the outer ones left out, are invisible
        self.flows: list[_Flow] = [_Flow()]
        self.tables: list[_Table] = []
        self.lists: list[list] = []  # [ordered, next number]
        self.links: list[tuple] = []  # what each open element has to do when it ends
        self.seen: list[bool] = [True]  # whether text is visible, in each open element that isn't dark
        self.menus: list[list[tuple[list[str], bool]]] = []  # lines of options, and whether they are chosen
        self.sheet: list[str] = []  # what the style element that is open holds
        self.rules: list[tuple[str, frozenset[str], tuple]] = []

    # The builder

    def _has(self, tag: str, stop: frozenset | set = SCOPE) -> bool:
        for name in reversed(self.open if self.count[tag] else []):
            if name == tag:
                return True
            if name in stop:
                return False
        return False

    def _close_within(self, tags: set, stop: set) -> None:
        """Closes open elements up to the outermost one of tags inside the nearest one of stop."""
        if not any(self.count[x] for x in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] in stop:
                break
        else:
            i = -1
        for j in range(i + 1, len(self.open)):
            if self.open[j] in tags:
                while len(self.open) > j:
                    self._end()
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in IMPLIED:
            self._close_within(*IMPLIED[tag])
        if tag in CLOSE_P and self._has("p"):
            self._close_within({"p"}, SCOPE)
        if tag in ("td", "th") and self.tables and not self._has("tr", {"table"}):
            self._start("tr", {})
        attributes = {}
        for name, value in attrs:
            attributes.setdefault(name, value)
        self._start(tag, attributes)
        if tag in VOID:
            self._end()

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self._has("p"):
            self._start("p", {})
        if tag == "br":
            self.handle_starttag("br", [])
        elif self.count[tag] and (tag in SCOPE or self._has(tag)):
            while self.open[-1] != tag:
                self._end()
            self._end()

    def handle_data(self, data: str) -> None:
        if self.open[-1:] == ["style"]:
            self.sheet.append(data)
        elif not self.dark and self.seen[-1] and self.links[-1:] != [("closed",)] and (data.strip(" \t\n\f\r") or self.open[-1:] != ["tr"] and self.open[-1:] != ["table"]):
            self.flows[-1].text(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Outside of XML, all that begins with <![ is a comment up to the next >."""
        end = self.rawdata.find(">", i + 3)
        return end + 1 if end >= 0 else -1

    def _shows(self, tag: str, attributes: dict) -> tuple[bool, bool]:
        """Whether an element is there, and whether its text is visible."""
        there, visible = not (tag in HIDDEN or "hidden" in attributes or (tag == "dialog" and "open" not in attributes) or (tag == "input" and (attributes.get("type") or "").lower() == "hidden")), self.seen[-1]
        if self.links[-1:] == [("closed",)] and tag != "summary":
            there = False
        if self.rules and there:
            own = {f".{x}" for x in (attributes.get("class") or "").split()} | {f"#{attributes.get('id')}"}
            for name, marks, (display, visibility) in self.rules:
                if name in ("", tag) and marks <= own:
                    there = there if display is None else display
                    visible = visible if visibility is None else visibility
        display, visibility = _shown(attributes.get("style") or "")
        if display is not None and tag not in HIDDEN:
            there = display and "hidden" not in attributes
        return there, visible if visibility is None else visibility

    # The renderer

    def _start(self, tag: str, attributes: dict) -> None:
        self.open.append(tag)
        self.count[tag] += 1
        there, visible = (False, False) if self.dark else self._shows(tag, attributes)
        if not there:
            self.dark += 1
            self.links.append(("dark",))
            return
        self.seen.append(visible)
        flow, kind = self.flows[-1], ("plain",)
        if tag == "br":
            flow.end(keep=True)
        elif tag in MARGIN:
            flow.margin()
        elif tag in BLOCK:
            flow.end()
        if tag in ("ul", "ol", "menu"):
            start = attributes.get("start") or ""
            self.lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            if len(self.lists) > 1:
                flow.gap = False  # lists within lists have no margin
            kind = ("list",)
        elif tag == "li":
            mark = "- "
            if self.lists and self.lists[-1][0]:
                value = attributes.get("value") or ""
                self.lists[-1][1] = int(value) if re.fullmatch(r"-?\d{1,9}", value) else self.lists[-1][1]
                mark = f"{self.lists[-1][1]}. "
                self.lists[-1][1] += 1
            kind = ("indent", mark)
        elif tag in ("dd", "blockquote"):
            kind = ("indent", "    " if tag == "dd" else "> ")
        elif tag == "pre":
            kind = ("pre",)
        elif tag == "table":
            self.tables.append(_Table())
            kind = ("table", self.lists)
            self.lists = []
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th") and self.tables:
            wide, high = (min(max(int(x), 1), 1000) if re.fullmatch(r"[0-9]{1,4}", x) else 1 for x in (attributes.get("colspan") or "", attributes.get("rowspan") or ""))
            kind = ("cell", wide, high)
        elif tag == "caption" and self.tables:
            kind = ("caption",)
        elif tag == "q":
            flow.text("“")
            kind = ("quote",)
        elif tag == "details" and "open" not in attributes:
            kind = ("closed",)
        elif tag == "select":
            self.menus.append([])
            size = attributes.get("size") or ""
            kind = ("menu", "multiple" in attributes or (re.fullmatch(r"[0-9]{1,4}", size) is not None and int(size) > 1))
        elif tag == "option" and self.menus:
            kind = ("option", "selected" in attributes)
        elif tag == "textarea":
            kind = ("area",)
        if kind[0] in _OWN_FLOW:
            self.flows.append(_Flow(pre=kind[0] in ("pre", "area") or (flow.pre and kind[0] == "indent")))
        self.links.append(kind)

    def _end(self) -> None:
        tag, kind = self.open.pop(), self.links.pop()
        self.count[tag] -= 1
        if kind[0] == "dark":
            self.dark -= 1
            if tag == "style":
                self.rules += _rules("".join(self.sheet))
                self.sheet.clear()
            return
        self.seen.pop()
        if kind[0] in _OWN_FLOW:
            lines = self.flows.pop().done()
        flow = self.flows[-1]
        if kind[0] == "indent":
            mark = kind[1]
            rest = "> " if mark == "> " else " " * len(mark)
            if lines:
                flow.add([(mark if i == 0 else rest if x else rest.rstrip()) + x for i, x in enumerate(lines)])
        elif kind[0] == "pre":
            flow.add(lines)
        elif kind[0] == "cell":
            self.tables[-1].rows[-1].append((lines, kind[1], kind[2]))
        elif kind[0] == "caption":
            self.tables[-1].caption += lines
        elif kind[0] == "table":
            done = self.tables.pop().lines()
            self.lists = kind[1]
            flow.add(lines)  # what stood between rows comes before the table
            if done:
                flow.add(done)
        elif kind[0] == "list":
            self.lists.pop()
        elif kind[0] == "quote":
            flow.text("”")
        elif kind[0] == "area":
            flow.end()
            flow.add(lines)
        elif kind[0] == "option":
            self.menus[-1].append((lines, kind[1]))
        elif kind[0] == "menu":
            options = self.menus.pop()
            chosen = [x for x, on in options if on][-1:] or [x for x, _ in options][:1]
            flow.text(" " + " ".join(line for option in ([x for x, _ in options] if kind[1] else chosen) for line in option) + " ")
        if tag in MARGIN:
            nested = kind[0] == "list" and self.lists
            flow.end() if nested else flow.margin()
        elif tag in BLOCK:
            flow.end()

    def text(self) -> str:
        while self.open:
            self._end()
        return "\n".join(self.flows[0].done())


def render(html: str | None) -> str:
    """The visible text of a page; null as an empty page. Whatever can't be parsed as a tag is text, and there is text for every page: where the
    parser gives up on a declaration or a character's number, these are taken out and the rest is parsed anew."""
    for attempt in range(2):
        page = _Page()
        try:
            page.feed(html or "")
            page.close()
            return page.text()
        except (AssertionError, ValueError):
            if attempt:
                raise
            html = re.sub(r"&#[0-9]{8,};?", "\ufffd", html).replace("<!", "&lt;!")
    return ""


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of pages. Null and empty pages give the empty text; null ids and repeated rows stay as they are; other columns,
    whatever their names, are not read; an empty table gives an empty result. Each page is handled alone, within the memory for its tree, however long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first in range(0, b.num_rows, 256):
                lot = b.slice(first, 256)
                yield pa.RecordBatch.from_arrays([lot.column("page_id"), lot.column("url"), pa.array([render(x) for x in lot.column("html").to_pylist()], pa.string())], ["page_id", "url", "text"])

    return in_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(lean(run), "page_id long, url string, text string")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))
