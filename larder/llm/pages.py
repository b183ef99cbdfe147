"""Layout-aware HTML rendering.

A small tree builder supplies implied tags (open paragraphs, items and cells end where the
next one begins, void elements never open) and visibility rules (metadata, scripts,
``hidden``, and the cascade of ``display`` and ``visibility`` over style sheets of simple
selectors and inline styles).  The renderer writes all visible text: blocks on their own lines,
blank lines around paragraphs and headings, list items with marks and indents (up to
``MAX_INDENT`` columns), preformatted text as it is, table cells in aligned columns.

Open elements are found by their tag and not by walking the stack, and the renderer keeps its
own stack, so time is linear in the page and nesting may have any depth.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

from pyspark.sql import DataFrame

from larder.llm.common import text_rows

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp".split())
HIDDEN = frozenset("head script style template noscript title meta link object iframe canvas audio video datalist desc defs metadata annotation annotation-xml".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr article section".split())
BLOCK = PARAGRAPH | frozenset(
    "html body div address aside main nav header footer form fieldset figcaption details summary li dt dd tr caption "
    "thead tbody tfoot td th center legend option optgroup hgroup search menu dir xmp textarea".split())
#: Columns that nested lists and quotes are moved to the right at most.
MAX_INDENT = 64
#: Opening a key ends the nearest open element of the value, unless a scope stands between.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"),
    "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), "option": ("option",), "optgroup": ("option", "optgroup"), "body": ("head",),
}
SCOPES = frozenset("table ul ol dl menu dir body html select".split())
_P_SCOPES = frozenset("table td th body html button caption".split())
#: A quote delimits a value only directly after "="; anywhere else it belongs to the name or the unquoted value.
_VALUE = r"[ \t\n\r\f]*+=[ \t\n\r\f]*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^ \t\n\r\f\"'>][^ \t\n\r\f>]*+))?+"
_NAME = r"[^ \t\n\r\f/>][^ \t\n\r\f/>=]*+"
_MARKUP = re.compile(r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^ \t\n\r\f/>]*)"
                     rf"((?:[ \t\n\r\f/]++|{_NAME}(?:{_VALUE.replace('([^', '(?:[^')})?+)*+)(?:>|\Z)", re.S)
_ATTR = re.compile(rf"({_NAME})(?:{_VALUE})?+")
_CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:\\.|[^\"\\\n])*+\"?|'(?:\\.|[^'\\\n])*+'?|[{};]|[^{};\"'/]++|/", re.S)
_MEDIA = re.compile(r"(?:(?:only\s+)?(?:all|screen))?", re.I)
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        out.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return out


def _on_screen(media: str) -> bool:
    """Whether a media list holds on every screen; none at all does."""
    return any(_MEDIA.fullmatch(m.strip()) for m in media.split(","))


def _declaration(text: str) -> tuple[str, bool, bool] | None:
    """(property, important, hides) of a declaration of display or visibility."""
    name, _, value = text.partition(":")
    name, value = name.strip().lower(), value.strip().lower()
    if name not in ("display", "visibility") or not value:
        return None
    important, value = "!" in value, value.partition("!")[0].strip()
    if value in ("inherit", "unset", "revert"):
        return None
    return name, important, value == "none" if name == "display" else value in ("hidden", "collapse")


def _style(css: str, state: dict[str, dict[str, tuple[bool, int, bool]]]) -> None:
    """Adds the rules of a style sheet to ``state``: selector -> property -> (important, order, hides).

    A later declaration of the same selector replaces an earlier one, unless only the earlier
    is important.  Blocks under a condition (print, a width, ``@supports``) say nothing.
    """
    def declared(selectors: str, text: str) -> None:
        found = _declaration(text)
        if not found:
            return
        name, important, hides = found
        state[""] = {"": (False, order := state.get("", {}).get("", (False, 0, False))[1] + 1, False)}
        for s in selectors.split(","):
            known = state.setdefault(s.strip().lower(), {})
            if important or not known.get(name, (False,))[0]:
                known[name] = important, order, hides

    # of each open block: the selectors of a rule, "" where inner rules count, None where nothing does
    blocks, now = [], ""
    for m in _CSS.finditer(css):
        t = m[0]
        if t == "{":
            head, now = now.strip(), ""
            if blocks and blocks[-1] != "":
                blocks.append(None)
            elif head.startswith("@"):
                name, _, rest = head[1:].replace("(", " (").partition(" ")
                blocks.append("" if name.lower() == "layer" or name.lower() == "media" and _on_screen(rest) else None)
            else:
                blocks.append(head or None)
        elif t in ("}", ";"):
            if blocks and blocks[-1]:
                declared(blocks[-1], now)
            if blocks and t == "}":
                blocks.pop()
            now = ""
        elif t.startswith("/*"):
            now += " "
        else:
            now += t
    if blocks and blocks[-1]:
        declared(blocks[-1], now)


class _Open:
    """The open elements, and for each tag the places of its open elements."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], {root.tag: [0]}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def last(self, tags) -> int:
        """The place of the innermost open element of these tags, -1 without one."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, names, scopes) -> bool:
        """Ends the innermost of ``names`` and all inside it, unless one of ``scopes`` stands between."""
        at = self.last(names)
        if at <= 0 or at <= self.last(scopes):
            return False
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()
        return True


def parse(html: str) -> tuple[Node, dict]:
    """The tree, and the rules of its style sheets."""
    root = Node("html")
    open_, styles, at, end = _Open(root), {}, 0, len(html)
    stack = open_.stack

    def text(value: str):
        if value:
            stack[-1].children.append(unescape(value) if "&" in value else value)

    while at < end:
        m = _MARKUP.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "p" and open_.last(("p",)) < 0:
                stack[-1].children.append(Node("p"))
            elif tag == "br":
                stack[-1].children.append(Node("br"))
            else:
                open_.close((tag,), () if tag in SCOPES else ("td", "th") if tag in ("p", "li") else ())
            continue
        if tag in ("html", "body") and open_.last((tag,)) >= 0:
            continue
        if tag == "select" and open_.close((tag,), ()):
            continue
        if tag in CLOSES:
            # rows and cells may have to end more than one open element
            for _ in range(3):
                if not open_.close(CLOSES[tag], SCOPES):
                    break
        if tag in BLOCK and tag not in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "option", "optgroup", "textarea"):
            open_.close(("p",), _P_SCOPES)
        if tag == "body" or (stack[-1].tag == "head" and tag not in HIDDEN | {"base"}):
            open_.close(("head",), ("body",))
        node = Node(tag, _attributes(m[3]))
        stack[-1].children.append(node)
        if tag in RAW:
            stop = _END[tag].search(html, at)
            body, at = html[at:stop.start() if stop else end], stop.start() if stop else end
            if tag == "style" and _on_screen(node.attrs.get("media", "")):
                _style(body, styles)
            if tag in ("textarea", "xmp") and body:
                node.children.append(unescape(body) if tag == "textarea" else body)
            if stop:
                after = html.find(">", at)
                at = after + 1 if after >= 0 else end
        elif tag not in VOID:
            open_.push(node)
    return root, styles


_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in RAW}


def _look(node: Node, sheet: dict) -> tuple[bool, bool | None]:
    """(displayed, visible): visible is None where nothing declares it.

    Of declarations the important ones win, then inline styles, then ids, classes and tags, then the
    last.  The ``hidden`` attribute gives way to any declared display.
    """
    tag, a = node.tag, node.attrs
    if tag in HIDDEN or tag == "input" and a.get("type", "").lower() == "hidden":
        return False, None
    if not sheet and "style" not in a:
        return "hidden" not in a, None
    best: dict[str, tuple] = {}
    keys = [("*", 0), (tag, 1)]
    if a:
        keys += [k for c in a.get("class", "").lower().split() for k in (("." + c, 10), (f"{tag}.{c}", 11))]
        if "id" in a:
            keys += [("#" + a["id"].lower(), 100), (f"{tag}#{a['id'].lower()}", 101)]
    for key, weight in keys if sheet else ():
        for name, (important, order, hides) in sheet.get(key, {}).items():
            best[name] = max(best.get(name, ((False, -1, 0), False)), ((important, weight, order), hides))
    for k, part in enumerate(a.get("style", "").split(";")):
        found = _declaration(part)
        if found:
            best[found[0]] = max(best.get(found[0], ((False, -1, 0), False)), ((found[1], 1000, k), found[2]))
    displayed = not best["display"][1] if "display" in best else "hidden" not in a
    return displayed, not best["visibility"][1] if "visibility" in best else None


class _Writer:
    """Lines of text; asks for line breaks are merged, the largest wins."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent, self.gap, self.mark = "", 0, ""

    def words(self, text: str, pre: bool = False) -> None:
        if pre:
            for k, line in enumerate(text.split("\n")):
                if k:
                    self.end_line(keep=True)
                if line:
                    self.now.append(line)
            return
        text = _SPACE.sub(" ", text)
        if text.strip(" "):
            if self.now and self.now[-1].endswith(" "):
                text = text.lstrip(" ")
            self.now.append(text if self.now else text.lstrip(" "))
        elif self.now and text and not self.now[-1].endswith(" "):
            self.now.append(" ")

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.now).rstrip(" ")
        self.now = []
        if line or (keep and self.lines):
            if self.gap and self.lines and self.lines[-1] != "":
                self.lines.append("")
            self.gap = 0
            self.lines.append(((self.indent[:len(self.indent) - len(self.mark)] + self.mark if self.mark else self.indent) + line).rstrip(" "))
            self.mark = ""

    def block(self, blank: bool) -> None:
        self.end_line()
        self.gap = max(self.gap, int(blank))

    def text(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def _deeper(indent: str, by: str) -> str:
    return indent + by if len(indent) + len(by) <= MAX_INDENT else indent


def _render(node: Node, out: _Writer, sheet: dict, pre: bool, shown: bool):
    """Writes the children of a node; yields the work on those that have children of their own."""
    for child in node.children:
        if isinstance(child, str):
            if shown:
                out.words(child, pre)
            continue
        tag = child.tag
        displayed, visible = _look(child, sheet)
        if not displayed:
            continue
        visible = shown if visible is None else visible
        if tag == "br":
            out.end_line(keep=True)
        elif tag == "hr":
            out.block(True)
        elif tag == "img":
            if visible and child.attrs.get("alt"):
                out.words(child.attrs["alt"])
        elif tag == "input":
            if visible and child.attrs.get("value") and child.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset"):
                out.words(" " + child.attrs["value"] + " ")
        elif tag == "table":
            out.block(True)
            yield _table(child, out, sheet, visible)
            out.block(True)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.block(not out.indent)
            yield _list(child, out, sheet, pre, visible)
            out.block(not out.indent)
        elif tag == "select":
            out.words(" ")
            yield _render(_chosen(child), out, sheet, False, visible)
            out.words(" ")
        elif tag in BLOCK:
            blank = tag in PARAGRAPH and not out.indent
            out.block(blank)
            kept = out.indent
            if tag in ("dd", "blockquote"):
                out.indent = _deeper(kept, "  ")
            yield _render(child, out, sheet, pre or tag in ("pre", "xmp", "textarea"), visible)
            out.block(blank)
            out.indent = kept
        else:
            yield _render(child, out, sheet, pre, visible)


def _chosen(select: Node) -> Node:
    """What a select box shows: all options if it is open, else the selected or the first (all it holds without any)."""
    if "multiple" in select.attrs or select.attrs.get("size", "1") not in ("", "0", "1"):
        return select
    options, todo = [], [select]
    while todo:
        n = todo.pop()
        if n.tag == "option":
            options.append(n)
        else:
            todo.extend(c for c in reversed(n.children) if isinstance(c, Node))
    if not options:
        return select
    marked = [o for o in options if "selected" in o.attrs]
    shown = Node("span")
    shown.children = [c for o in (marked[-1:] or options[:1]) for c in o.children]
    return shown


def _list(node: Node, out: _Writer, sheet: dict, pre: bool, shown: bool):
    number = int(node.attrs["start"]) if re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
    for child in node.children:
        if not isinstance(child, Node) or child.tag != "li":
            loose = Node("li")
            loose.children.append(child)
            yield _render(loose, out, sheet, pre, shown)
            continue
        displayed, visible = _look(child, sheet)
        if not displayed:
            continue
        out.block(False)
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        kept = out.indent
        out.indent = _deeper(kept, " " * len(mark))
        out.mark = mark if len(mark) <= len(out.indent) else ""
        yield _render(child, out, sheet, pre, shown if visible is None else visible)
        out.block(False)
        out.indent, out.mark = kept, ""


def _rows(node: Node, sheet: dict, shown: bool) -> list[tuple[Node, bool, int]]:
    """The rows and captions of a table, head first and foot last: (row, visible, number of its group)."""
    parts: dict[str, list] = {"thead": [], "tbody": [], "tfoot": []}
    group = 0
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                loose = Node("caption")
                loose.children.append(child)
                parts["tbody"].append((loose, shown, group))
            continue
        displayed, visible = _look(child, sheet)
        if not displayed or child.tag in ("col", "colgroup"):
            continue
        visible = shown if visible is None else visible
        if child.tag in parts:
            group += 1
            for row in child.children:
                if isinstance(row, str):
                    if not row.strip():
                        continue
                    loose = Node("caption")
                    loose.children.append(row)
                    row = loose
                displayed, own = _look(row, sheet)
                if displayed and row.tag not in ("col", "colgroup"):
                    parts[child.tag].append((row, visible if own is None else own, group))
            group += 1
        else:
            parts["tbody"].append((child, visible, group))
    return parts["thead"] + parts["tbody"] + parts["tfoot"]


def _span(cell: Node, name: str, most: int) -> int:
    """A cell's columns or rows; 0 rows are all that follow in its group."""
    value = cell.attrs.get(name, "").strip()
    count = min(int(value), most) if re.fullmatch(r"\d{1,9}", value) else 1
    return most if name == "rowspan" and count == 0 else max(1, count)


def _table(node: Node, out: _Writer, sheet: dict, shown: bool):
    """Rows as lines, cells padded to the width of their columns; a cell of many lines takes several lines.

    A cell keeps its columns free in the rows of its group that it spans.  Columns without a cell
    of their own take no room; a cell wider than the columns that it spans widens the last of them.
    """
    rows: list[tuple[Node | None, bool, list[tuple[int, int, list[str]]]]] = []
    held: dict[int, int] = {}
    last = None
    for row, visible, group in _rows(node, sheet, shown):
        if row.tag != "tr":
            rows.append((row, visible, []))
            continue
        if group != last:
            held, last = {}, group
        cells, column, spans = [], 0, {}
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip():
                continue
            own = (True, None) if isinstance(cell, str) else _look(cell, sheet)
            if not own[0]:
                continue
            inner, holder = _Writer(), cell
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                holder = Node("td")
                holder.children.append(cell)
            yield _render(holder, inner, sheet, False, visible if own[1] is None else own[1])
            while column in held:
                column += 1
            wide, tall = _span(holder, "colspan", 1000), _span(holder, "rowspan", 65534)
            cells.append((column, wide, [x for x in inner.text().split("\n") if x] or [""]))
            if tall > 1:
                spans.update({c: tall for c in range(column, column + wide)})
            column += wide
        held = {c: n - 1 for c, n in {**held, **spans}.items() if n > 1}
        rows.append((None, visible, cells))
    widths: dict[int, int] = {}
    every = [c for _, _, cells in rows for c in cells]
    for column, span, lines in every:
        if span == 1:
            widths[column] = max(widths.get(column, 0), max(map(len, lines)))
    for column, span, lines in sorted((c for c in every if c[1] > 1), key=lambda c: c[1]):
        mine = [c for c in range(column, column + span) if c in widths]
        short = max(map(len, lines)) - sum(widths[c] for c in mine) - 2 * max(0, len(mine) - 1)
        if short > 0:
            at = mine[-1] if mine else column
            widths[at] = widths.get(at, 0) + short
    starts, x = {}, 0
    for column in sorted(widths):
        starts[column] = x
        x += widths[column] + 2
    columns = sorted(widths)
    for row, visible, cells in rows:
        if row is not None:
            holder = Node("div")
            holder.children.append(row)
            yield _render(holder, out, sheet, False, visible)
            out.end_line()
            continue
        for k in range(max((len(lines) for _, _, lines in cells), default=0)):
            line, size = [], 0
            for column, _, lines in cells:
                if k < len(lines) and lines[k]:
                    place = bisect_left(columns, column)
                    pad = max(starts[columns[place]] if place < len(columns) else x, size + 2 * bool(size)) - size
                    line += [" " * pad, lines[k]]
                    size += pad + len(lines[k])
            out.now.append("".join(line))
            out.end_line()


def _run(work) -> None:
    """Runs the renderer's generators on a stack of its own."""
    stack = [work]
    while stack:
        more = next(stack[-1], None)
        if more is None:
            stack.pop()
        else:
            stack.append(more)


def render(html: str) -> str:
    """The visible text of a page."""
    root, sheet = parse(html)
    out = _Writer()
    _run(_render(root, out, sheet, False, True))
    return out.text()


def page_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines): one row per input row; a null page has an empty text.

    Any string is a page: unclosed tags end with the page, stray end tags are ignored.
    Repeated rows and null ids keep their own rows.  There is no shuffle.
    """
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [render(html or "") for (html,) in text_rows(b, "html")]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                                   pa.array([len(t.split("\n")) if t else 0 for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_lines"])

    src = pages.select("page_id", "url", "html")
    kind = src.schema["page_id"].dataType.simpleString()
    return src.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_lines long")
