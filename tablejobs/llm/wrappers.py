"""Main text of web pages by wrappers inferred per host.

Pages of one host come from few templates. A wrapper is a union-free regular
expression over their tag streams: sequences, optional items, repeated items and
groups, and text slots, but no alternatives. It starts as the first page's stream
and is aligned with one page after another: where labels agree, it goes on inside;
items that only one side has become optional; neighbours of the same label (or of
the same few labels) become a repeated item (or group); a text slot counts on how many
pages it is filled and by which texts (digests of whole texts, however long). Wrappers
of two sets of pages are aligned in the same way, so each task infers one per host from
all the pages it reads, and only these meet: a host that has a third of all pages costs
one row per task.

A wrapper's slots are then told apart: slots in navigation, headers, footers,
asides, adverts, notices, forms, scripts and comments are not content. Of the rest
that a page fills, those in the article element are, else in the main element, else
in the deepest element that holds most of the host's variable text outside links (of
the page's own, where less than half of that is in it: pages of one host may come from
several templates). There, without an element that says what is content, a text that a
slot has on most of the pages that fill it is the template's, not the page's, whatever
its element is called; unless that is most of the page's text, as on a host of copies.
A page's text is what its stream puts into the slots that are left.

Defined results: null or empty html has the empty text; a page without host shares
one wrapper with its like; broken markup is read as browsers do where ends are
missing, unknown ends are skipped; elements nested more than ``DEPTH`` deep count as
part of the one around them; rows that repeat have the same text; an empty table gives
an empty result; other columns are not read. Pages may come in any order and
partitioning: what decides about a slot are sums over pages. (Of slots with more than
``TEXTS`` different texts, the rarer ones are forgotten.)
"""

from __future__ import annotations

import html as markup
import json
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablejobs.llm.store import read, saved
from tablejobs.llm.textbatch import slices

#: Rules of all hosts together are broadcast up to this size, joined by a shuffle beyond.
BROADCAST_BYTES = 8 << 20
#: Hosts one task holds wrappers of before it passes them on.
HELD_HOSTS = 5_000
#: Nested elements that have labels of their own.
DEPTH = 150
#: Different texts that a slot remembers.
TEXTS = 256
#: A text is the template's when it is on so many of the pages that fill the slot, and on this
#: share of them; unless more than the other share of a page's text would go.
TEMPLATE_PAGES, TEMPLATE_SHARE, MOST = 3, 0.6, 0.5

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = "script|style|textarea|title|noscript|template|svg|iframe|math"
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: A start tag of the first kind ends an open element of the second.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}} | {
    t: {"p"} for t in _BLOCK - {"li", "dt", "dd", "tr", "td", "th", "body", "html", "caption", "tbody", "thead", "tfoot"}}
#: Elements beyond which a start tag doesn't end anything.
_SCOPES = frozenset("table ul ol dl article section main div body aside nav form select blockquote".split())
_SKIP_TAGS = frozenset("nav header footer aside form button select head dialog menu object".split())
#: Elements that are never left out by their names.
_KEPT_TAGS = frozenset("html body main article".split())
_NAME = (
    r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|"
    r"overlay|sidebar|aside|nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|comments?|commentlist|replies|"
    r"disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search|pagination|pager|"
    r"widget|toolbar|contentinfo|complementary)")
#: A whole class, id or role: such words alone, numbered, or with words of place and shape.
_SKIP_NAMES = re.compile(
    rf"(?:(?:site|page|main|top|bottom|global)[-_])?{_NAME}(?:[-_]{_NAME})*"
    r"(?:[-_]?\d+|[-_](?:bar|box|block|links|buttons|items|area))?")
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(/?)>|"
    r"<[!?][^>]*>", re.S | re.I)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_DIGITS = re.compile(r"\d+")
_SPACES = re.compile(r"\s+")
_LABELS: dict[tuple[str, str], str] = {}


def label_of(tag: str, attributes: str) -> str:
    """``tag.class#id``, with numbers in names made alike."""
    if not attributes:
        return tag
    known = _LABELS.get((tag, attributes)) if len(attributes) < 200 else None
    if known is None:
        marks = {k.lower(): v.strip("\"'") for k, v in _NAMES.findall(attributes)}
        names = sorted({_DIGITS.sub("0", x.lower()) for x in f"{marks.get('class', '')} {marks.get('role', '')}".split()})
        ident = _DIGITS.sub("0", marks.get("id", "").lower().strip())
        known = tag + "".join(f".{x}" for x in names).replace("/", "-") + (f"#{ident}".replace("/", "-") if ident else "")
        if len(_LABELS) < 20_000:
            _LABELS[tag, attributes] = known
    return known


def stream(page: str) -> Iterator[tuple[str, str]]:
    """Events of a page: ("open", label), ("close", label), ("text", raw), ("break", "")."""
    stack: list[tuple[str, str]] = []
    open_tags: Counter = Counter()
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", page[at:m.start()]
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if m[2]:
            if open_tags[tag]:
                while True:
                    t, label = stack.pop()
                    open_tags[t] -= 1
                    yield "close", label
                    if t == tag:
                        break
            continue
        if tag in _VOID:
            if tag in ("br", "hr"):
                yield "break", tag
            continue
        ends = _ENDS.get(tag)
        if ends:
            for depth in range(len(stack) - 1, -1, -1):
                t = stack[depth][0]
                if t in ends:
                    while len(stack) > depth:
                        open_tags[stack[-1][0]] -= 1
                        yield "close", stack.pop()[1]
                    break
                if t in _SCOPES:
                    break
        label = label_of(tag, m[4])
        yield "open", label
        if m[5]:
            yield "close", label
        else:
            stack.append((tag, label))
            open_tags[tag] += 1
    if at < len(page):
        yield "text", page[at:]
    while stack:
        yield "close", stack.pop()[1]


# ------------------------------------------------------------------- wrappers
# A node is [label, repeated, optional, content]. The content of an element or a
# group (label "(") is its list of nodes, that of a text slot ("#") is
# [{digest of a text: pages that have it there, "": pages that fill the slot}, characters,
#  the text while it is the only one (cut to 80 characters, to be shown)].
# A page counts once for a path, in the first slot of that path.

def _digest(text: str) -> str:
    return blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()


def _added(a: dict[str, int], b: dict[str, int]) -> dict[str, int]:
    out = dict(a)
    for text, n in b.items():
        out[text] = out.get(text, 0) + n
    if len(out) > 2 * TEXTS:                            # the frequent ones stay
        kept = sorted(out, key=lambda t: (t != "", -out[t], t))[:TEXTS]
        out = {t: out[t] for t in kept}
    return out


def _key(node: list) -> str:
    return "(" + " ".join(x[0] for x in node[3]) if node[0] == "(" else node[0]


def _append(items: list, node: list) -> None:
    """Add a node; a neighbour of the same label makes it a repeated one."""
    if items and _key(items[-1]) == _key(node):
        node = _join(items.pop(), node)
        node[1] = node[1] or node[0] != "#"
    items.append(node)


def _fold(items: list) -> list:
    """Runs of the same few labels become repeated groups."""
    for period in (2, 3, 4):
        i = 0
        while i + 2 * period <= len(items):
            first = [_key(x) for x in items[i:i + period]]
            n = 1
            while [_key(x) for x in items[i + n * period:i + (n + 1) * period]] == first:
                n += 1
            if n > 1 and "(" not in "".join(first):
                body = items[i:i + period]
                for k in range(1, n):
                    body = [_join(a, b) for a, b in zip(body, items[i + k * period:i + (k + 1) * period])]
                items[i:i + n * period] = [["(", True, False, body]]
            i += 1
    return items


def _as_groups(items: list, others: list) -> list:
    """Single occurrences in ``items`` of groups that ``others`` has become groups, too."""
    for group in others:
        if group[0] == "(":
            labels = [x[0] for x in group[3]]
            i, n = 0, len(labels)
            while i + n <= len(items):
                if [x[0] for x in items[i:i + n]] == labels:
                    items[i:i + n] = [["(", False, False, items[i:i + n]]]
                i += 1
    return items


def _join(a: list, b: list) -> list:
    """The node that covers two nodes of the same key."""
    if a[0] == "#":
        return ["#", False, a[2] or b[2], [_added(a[3][0], b[3][0]), a[3][1] + b[3][1],
                                             a[3][2] if a[3][2] == b[3][2] else None]]
    return [a[0], a[1] or b[1], a[2] or b[2], align(a[3], b[3])]


def align(a: list, b: list) -> list:
    """The sequence that covers two sequences: a longest common subsequence of keys is kept,
    what only one side has becomes optional."""
    if not a and not b:
        return []
    a, b = _as_groups(a, b), _as_groups(b, a)
    x, y = [_key(n) for n in a], [_key(n) for n in b]
    if x == y:
        return [_join(m, n) for m, n in zip(a, b)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out: list = []
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            _append(out, _join(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]:
            _append(out, [a[i][0], a[i][1], True, a[i][3]])
            i += 1
        else:
            _append(out, [b[j][0], b[j][1], True, b[j][3]])
            j += 1
    return out


def wrapper_of(page: str) -> list:
    """The wrapper of a single page."""
    levels: list[tuple[str, list]] = [("", [])]
    seen: set[tuple[str, str]] = set()
    deeper, paths = 0, [""]
    for kind, value in stream(page):
        if kind == "open":
            if len(levels) > DEPTH:
                deeper += 1
            else:
                levels.append((value, []))
                paths.append(f"{paths[-1]}/{value}")
        elif kind == "close":
            if deeper:
                deeper -= 1
            else:
                label, items = levels.pop()
                paths.pop()
                _append(levels[-1][1], [label, False, False, _fold(items)])
        elif kind == "text":
            text = _SPACES.sub(" ", value).strip()
            if text:
                counts = {}
                for name in ("", _digest(text)):
                    if (paths[-1], name) not in seen:
                        seen.add((paths[-1], name))
                        counts[name] = 1
                _append(levels[-1][1], ["#", False, False, [counts, len(text), text[:80]]])
    return _fold(levels[0][1])


def template_texts(counts: dict[str, int]) -> set[str]:
    """Of a slot's texts, those that most of the pages that fill it have."""
    least = max(TEMPLATE_PAGES, TEMPLATE_SHARE * counts.get("", 0))
    return {text for text, n in counts.items() if text and n >= least}


def expression(items: list) -> str:
    """A wrapper as a regular expression, for people."""
    out = []
    for label, repeated, optional, content in items:
        if label == "#":
            text = "#" if content[2] is None else repr(content[2])
        elif label == "(":
            text = f"({expression(content)})"
        else:
            text = f"<{label}>{expression(content)}</{label}>"
        many = "*" if repeated and optional else "+" if repeated else "?" if optional else ""
        out.append(f"({text}){many}" if many else text)
    return "".join(out)


# ---------------------------------------------------------------------- rules

def _skipped(label: str) -> bool:
    tag, *names = re.split(r"[.#]", label)
    return tag in _SKIP_TAGS or tag not in _KEPT_TAGS and any(map(_SKIP_NAMES.fullmatch, names))


def slots(items: list, path: str = "", skipped: bool = False) -> Iterator[tuple[str, bool, dict, int]]:
    """(path, skipped, pages by text, characters) of each text slot."""
    for label, _, _, content in items:
        if label == "#":
            yield path, skipped, content[0], content[1]
        elif label == "(":
            yield from slots(content, path, skipped)
        else:
            yield from slots(content, f"{path}/{label}", skipped or _skipped(label))


def _element(path: str, element: str) -> bool:
    return re.search(rf"/{element}(?=[./#]|$)", path) is not None


def _linked(path: str) -> bool:
    return any(x == "a" or x.startswith(("a.", "a#")) for x in path.split("/"))


def _inside(path: str, holder: str) -> bool:
    return path == holder or path.startswith(f"{holder}/")


def _holder(weights: dict[str, int]) -> str | None:
    """The deepest element that holds most of the characters at the given paths."""
    weight: dict[str, int] = {}
    for p, chars in weights.items():
        labels = p.split("/")
        for k in range(1, len(labels) + 1):
            prefix = "/".join(labels[:k])
            weight[prefix] = weight.get(prefix, 0) + chars
    total = sum(weights.values())
    # Text elements themselves are parts of the article, not the element around it.
    holders = [p for p, w in weight.items() if 5 * w >= 4 * total
               and re.split(r"[.#]", p.rpartition("/")[2])[0] not in
               ("p", "li", "span", "b", "i", "em", "strong", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "tr", "pre")]
    return max(holders, key=lambda p: (p.count("/"), p)) if holders else None


class Rules:
    """Which slots of a host's wrapper hold the main text of a page."""

    def __init__(self, wrapper: list):
        found: dict[str, tuple[dict, int]] = {}
        for p, skip, counts, chars in slots(wrapper):
            if not skip:
                known, before = found.get(p, ({}, 0))
                found[p] = _added(known, counts), before + chars
        self.slots = frozenset(found)
        self.elements = [frozenset(p for p in self.slots if _element(p, e)) for e in ("article", "main")]
        self.template = {p: template_texts(counts) for p, (counts, _) in found.items()}
        weights: dict[str, int] = {}
        for p, (counts, chars) in found.items():
            variable = len(counts) - 1 > len(self.template[p])
            if variable and not _linked(p) and not any(p in e for e in self.elements):
                weights[p] = chars
        self.holder = _holder(weights)

    def named(self, own: dict[str, int]) -> bool:
        """Whether a page that fills these paths has an element that says what is content."""
        return any(not element.isdisjoint(own) for element in self.elements)

    def of_template(self, path: str, text: str) -> bool:
        known = self.template.get(path)
        return bool(known) and _digest(_SPACES.sub(" ", text).strip()) in known

    def paths(self, own: dict[str, int]) -> frozenset[str]:
        """The content slots of a page that puts ``own`` characters into each path. Pages of
        a host may come from different templates, so only what the page fills decides."""
        for element in self.elements:
            if not element.isdisjoint(own):
                return element
        if self.holder is None:
            return self.slots
        filled = {p: n for p, n in own.items() if p in self.slots}
        weights = {p: n for p, n in filled.items() if not _linked(p)}
        inside = [p for p in filled if _inside(p, self.holder)]
        if inside and 2 * sum(weights.get(p, 0) for p in inside) >= sum(weights.values()):
            return frozenset(inside)
        # Another template than that of most of the host's plain pages.
        holder = _holder(weights)
        return frozenset(p for p in filled if holder is None or _inside(p, holder))


def extract(page: str, rules: Rules) -> str:
    """What a page puts into its content slots, a line for each block."""
    pieces: list[tuple[str | None, str]] = []         # (path, text); without a path: a break
    own: dict[str, int] = {}
    path, deeper = [""], 0
    for kind, value in stream(page):
        if kind == "text":
            if path[-1] in rules.slots:
                pieces.append((path[-1], value))
                chars = len(value.strip())
                if chars:
                    own[path[-1]] = own.get(path[-1], 0) + chars
        elif kind == "break":
            pieces.append((None, "\n" if value == "hr" else " "))
        else:
            if re.split(r"[.#]", value, maxsplit=1)[0] in _BLOCK:
                pieces.append((None, "\n"))
            if kind == "open" and len(path) > DEPTH:
                deeper += 1
            elif kind == "open":
                path.append(f"{path[-1]}/{value}")
            elif deeper:
                deeper -= 1
            else:
                path.pop()
    paths = rules.paths(own)
    if not rules.named(own):
        mine = [k for k, (at, value) in enumerate(pieces) if at in paths and rules.of_template(at, value)]
        whole = sum(len(value.strip()) for at, value in pieces if at in paths)
        if mine and sum(len(pieces[k][1].strip()) for k in mine) <= MOST * whole:
            for k in mine:
                pieces[k] = (None, "")
    blocks: list[str] = []
    held: list[str] = []
    for at, value in [*pieces, (None, "\n")]:
        if at is None and value == "\n":
            text = _SPACES.sub(" ", "".join(held)).strip()
            if text:
                blocks.append(text)
            held.clear()
        elif at is None:
            held.append(value)
        elif at in paths:
            held.append(markup.unescape(value))
    return "\n".join(blocks)


# ------------------------------------------------------------------ on tables

def host_of(url: str = "url"):
    return F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url}`"), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) from all pages (host, html)."""

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(
                [json.dumps(w) for w in held.values()], pa.string())], ["host", "wrapper"])

        for part, _, _ in slices(batches, "html"):
            for host, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if page:
                    own = wrapper_of(page)
                    held[host] = align(held[host], own) if host in held else own
            if len(held) > HELD_HOSTS:
                yield rows()
                held.clear()
        yield rows()

    def merge(table: pa.Table) -> pa.Table:
        wrapper: list = []
        for k, text in enumerate(sorted(table["wrapper"].to_pylist())):
            wrapper = align(wrapper, json.loads(text)) if k else json.loads(text)
        return pa.table({"host": table["host"].slice(0, 1), "wrapper": [json.dumps(wrapper)]})

    parts = pages.select("host", "html").mapInArrow(infer, "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(merge, "host string, wrapper string")


def main_texts(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    slim = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{html}`").alias("html"), host_of(url).alias("host"))
    wrappers = saved(infer_wrappers(slim), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0
    joined = slim.join(F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers, "host", "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules: dict[str | None, Rules] = {None: Rules([])}
        for part, _, _ in slices(batches, "html"):
            texts = []
            for page, wrapper in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                if wrapper not in rules:
                    if len(rules) > HELD_HOSTS:
                        rules = {None: Rules([])}
                    rules[wrapper] = Rules(json.loads(wrapper))
                texts.append(extract(page, rules[wrapper]) if page else "")
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    kind = dict(slim.dtypes)["id"]
    return joined.select("id", "url", "html", "wrapper").mapInArrow(
        work, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)


def op2_html_wrappers(spark, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
