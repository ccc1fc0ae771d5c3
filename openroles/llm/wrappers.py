"""Main text of web pages by wrappers inferred per host.

A page becomes a stream of tokens: opening and closing tags of block elements
(with the first word of their class or id) and text slots. Adjacent equal runs
fold into repeated groups. The folded streams of a host are aligned one after
the other with the expression learnt so far: what both have stays, what one of
them lacks becomes an optional group, and groups that come to stand side by
side fold again. The result is a union-free regular expression of the host's
pages, its wrapper. Elements of one name are aligned inside in turn.

Each slot of the wrapper keeps what its pages say of it: the texts that all
pages with the slot have in it, a few different pages that have it, their
number, and how much text they have there. A text outside of articles is the
host's own, not the page's, if all pages with its slot have it, these are more
than half of the host's pages and at least ``LEAST_PAGES`` of them differ; what an
article or main element holds is the page's in any case. Names and tags then
decide among the slots of other texts: menus, headers, footers, reader comments
and the like are out, but an article's own header is its title; if a host's
articles hold most of the text of their own that is left, other slots count only
on pages without an article's text, except headings and paragraphs right before
an article, its lead; else all of them count. All pages of the host are read
through this. A page of nothing but texts of the host keeps them, as they may be
its only text.

Equal streams are joined with what they say of their slots before they meet, and
again where they meet. The streams of a host are dealt by their hash over
``PARTS`` tasks, each of which gets them sorted and keeps only the expression
they align to; the parts' expressions are aligned in turn, so a host with a third
of all pages is not aligned in one task.

Defined cases: a null or empty page, or one without main text, gives the empty
text. Tags that are never closed end with their parent or the page; an
unfinished tag at the end is dropped, unfinished character references stay as
HTML5 decodes them. Pages with a null url or one without a host share the empty
host. Repeated rows stay repeated.
"""

from __future__ import annotations

import html
import json
import re
from difflib import SequenceMatcher
from typing import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from openroles.llm.common import only, slices, written
from openroles.llm.urls import with_parts

#: Wrapper rows up to this number are broadcast to the pages; more are joined by shuffle.
MOST_BROADCAST = 20_000
#: Fewest different pages that show what a host repeats; two may be copies of one page.
LEAST_PAGES = 3
#: Tasks among which the streams of a host are dealt before their expressions meet.
PARTS = 16
#: A task sends what it has joined when it holds this many characters of streams and slots.
MOST_HELD = 16 << 20
BLOCKS = frozenset(
    "html head title body p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "section article main blockquote pre figure figcaption hr address details summary header footer nav aside "
    "form fieldset legend label button select option textarea menu dialog center video audio".split())
ENDS_PARAGRAPH = BLOCKS - {"html", "head", "body", "title", "label", "button", "select", "option", "textarea"}
#: An element of the key closes an open one of the value that is nearer than the value's usual parent.
SIBLINGS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
            "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
VOID = frozenset("hr".split())
HIDDEN = ("script", "style", "noscript", "template", "iframe", "svg", "annotation", "annotation-xml", "canvas")
SPACING = frozenset(("br", "wbr", "img", "input"))
OUTSIDE = frozenset(
    "head title nav header footer aside form fieldset legend label button select option textarea menu dialog "
    "video audio".split())
OUTSIDE_NAMES = re.compile(
    r"(?:(?:site|global|main|top|bottom|left|right)[-_])?(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|"
    r"side-?bar\w*|menu|nav|navbar|navigation|breadcrumbs?|cookies?|consent|notices?|notification|alert|respond|replies|disqus|share|sharing|social|related|"
    r"recommended|newsletter|subscribe|popup|modal|overlay|footer|header|widget|toolbar|pagination|pager|login|"
    r"signup|search)(?:[-_]?0)?", re.I)
#: Names of reader comments and of their parts; ``no-comments`` and ``comments-open`` say something else.
COMMENT_NAMES = re.compile(
    r"(?!(?:no|has|with|without|hide|show)[-_])(?:[a-z]+[-_])*?(?:comment-?list|comments?)"
    r"(?:[-_](?:0|list|items?|body|area|section|threads?|content|text|meta|author|wrap(?:per)?|container|form|respond|"
    r"repl(?:y|ies)|box|inner|blocks?|holder|children|0))*", re.I)
HEADER_NAMES = re.compile(r"[a-z-_]*header", re.I)
INSIDE = frozenset(("article", "main"))
LEADING = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Elements whose names say something about the page, not about what part of it they are.
UNJUDGED = INSIDE | {"html", "body"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(?P<raw>" + "|".join(HIDDEN) + r")\b(?:[^>]*/>|.*?(?:</(?P=raw)\s*>|$))|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"<]*\"|'[^'<]*'|[^>\"'])*|[^>]*)>|"
    r"<[!?/][^>]*(?:>|$)|<[a-zA-Z][^>]*$", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAMING = frozenset(("class", "id", "role"))


def events(page: str) -> Iterator[tuple[str, str]]:
    """("<", element), (">", element) and ("#", text) with every element closed, in order.

    An element is its tag name, and after a dot the names it is given. Inline
    tags are left out; those that space words apart become a blank.
    """
    stack: list[str] = []
    buffer: list[str] = []

    def tag(element: str) -> str:
        return element.partition(".")[0]

    def pop_to(depth: int):
        while len(stack) > depth:
            yield ">", stack.pop()

    def flush():
        text = " ".join("".join(buffer).split())
        buffer.clear()
        if text:
            yield "#", text

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            buffer.append(html.unescape(page[at:m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if name in SPACING:
            buffer.append(" ")
        if name not in BLOCKS:
            continue
        yield from flush()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if tag(stack[i]) == name), None)
            if depth is not None:
                yield from pop_to(depth)
            continue
        if name in ENDS_PARAGRAPH and stack and tag(stack[-1]) == "p":
            yield from pop_to(len(stack) - 1)
        if name in SIBLINGS:
            closes, within = SIBLINGS[name]
            for i in range(len(stack) - 1, -1, -1):
                if tag(stack[i]) in within.split():
                    break
                if tag(stack[i]) in closes.split():
                    yield from pop_to(i)
                    break
        given = " ".join(a or b or c for n, a, b, c in ATTRIBUTE.findall(m["rest"] or "")
                         if n.lower() in NAMING and (a or b or c))
        given = re.sub(r"\d+", "0", given)
        element = f"{name}.{given}" if given else name
        yield "<", element
        if name in VOID:
            yield ">", element
        else:
            stack.append(element)
    if at < len(page):
        buffer.append(html.unescape(page[at:]))
    yield from flush()
    yield from pop_to(0)


# An expression is a list of items: ["#", times] or ["#", told, times], an element
# ["e", name, items, times] or a group ["g", items, times]. Times are "1", "+" (one
# or more), "?" (none or one) or "*" (any number). ``told`` is what pages say of a
# slot: [texts that all of them have, up to LEAST_PAGES different pages, number of
# pages, characters].

LENGTH_BITS = 16


def text_number(text: str) -> int:
    """A text as a number, whose last bits are its length."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> LENGTH_BITS + 1 << LENGTH_BITS | min(
        len(text), (1 << LENGTH_BITS) - 1)


def of_one_page(a: list, b: list) -> list:
    """What is told of a slot in two places of one page, or of one expression that fold."""
    return [sorted({*a[0], *b[0]}), sorted({*a[1], *b[1]})[:LEAST_PAGES], max(a[2], b[2]), a[3] + b[3]]


def of_two_pages(a: list, b: list) -> list:
    """What is told of a slot by pages of two kinds; in any order, it comes out the same."""
    return [sorted({*a[0]} & {*b[0]}), sorted({*a[1], *b[1]})[:LEAST_PAGES], a[2] + b[2], a[3] + b[3]]


TIMES = {(False, False): "1", (False, True): "+", (True, False): "?", (True, True): "*"}
WIDEST_GROUP = 4


def key(item: list) -> str:
    """What alignment compares: an element's name; what it holds is aligned in turn."""
    if item[0] == "g":
        return "(" + " ".join(map(key, item[1])) + ")"
    return "<" + item[1] if item[0] == "e" else "#"


def times(item: list, *others: list, optional: bool = False, repeated: bool = False) -> list:
    """``item`` with its own and the others' options joined, and those named."""
    found = "".join(x[-1] for x in (item, *others))
    return [*item[:-1], TIMES[optional or "?" in found or "*" in found, repeated or "+" in found or "*" in found]]


def whole(call):
    """Result of a generator that yields generators for the calls it makes of its own kind.

    The stack of calls is a list here, as elements may be nested thousands deep.
    """
    stack, value = [call], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def same(a: list, b: list) -> bool:
    """Whether two items or expressions are known to be equal; those nested too deep for that are aligned."""
    try:
        return a == b
    except RecursionError:
        return False


def merge(a: list, b: list, tell):
    """One item that reads what either of two items of one key reads (for ``whole``); ``tell`` joins their slots."""
    if a[0] == "#":
        return times(["#", tell(a[1], b[1]), "1"], a, b) if len(a) > 2 else times(a, b)
    if same(a, b):
        return a
    if a[0] == "e":
        return times(["e", a[1], (yield _align(a[2], b[2], tell)), "1"], a, b)
    both = []
    for x, y in zip(a[1], b[1]):
        both.append((yield merge(x, y, tell)))
    return times(["g", both, "1"], a, b)


def add(items: list, item: list):
    """Append, folding runs of equal keys at the end into repeated items or groups (for ``whole``)."""
    if items and key(items[-1]) == key(item):
        items[-1] = times((yield merge(items[-1], item, of_one_page)), repeated=True)
        return
    items.append(item)
    keys = [key(x) for x in items[-2 * WIDEST_GROUP:]]
    for width in range(2, WIDEST_GROUP + 1):
        tail = keys[-width:]
        if len(keys) > width and keys[-width - 1] == "(" + " ".join(tail) + ")":
            group = ["g", items[-width:], "1"]
            items[-width - 1:] = [times((yield merge(items[-width - 1], group, of_one_page)), repeated=True)]
            return
        if len(keys) >= 2 * width and keys[-2 * width:-width] == tail:
            both = []
            for x, y in zip(items[-2 * width:-width], items[-width:]):
                both.append((yield merge(x, y, of_one_page)))
            items[-2 * width:] = [["g", both, "+"]]
            return


def stream(page: str, telling: bool = False) -> list:
    """The folded token stream of a page as an expression, whose slots tell of the page if that is asked for."""
    open_: list[tuple[str, list]] = [("", [])]
    found = list(events(page))
    own = 0
    if telling:
        for kind, what in found:
            own = below(own, what) if kind == "#" else own
    for kind, what in found:
        if kind == "<":
            open_.append((what, []))
        elif kind == ">":
            name, items = open_.pop()
            whole(add(open_[-1][1], ["e", name, items, "1"]))
        else:
            whole(add(open_[-1][1], ["#", [[text_number(what)], [own], 1, len(what)], "1"] if telling else ["#", "1"]))
    return open_[0][1]


def align(wrapper: list, page: list) -> list:
    """The smallest change of ``wrapper`` that also reads ``page``: what one of them lacks becomes optional."""
    return whole(_align(wrapper, page, of_two_pages))


def _align(wrapper: list, page: list, tell):
    out: list = []
    a, b = list(map(key, wrapper)), list(map(key, page))
    for kind, i, j, k, m in SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        if kind == "equal":
            for x, y in zip(wrapper[i:j], page[k:m]):
                yield add(out, (yield merge(x, y, tell)))
        else:
            for x in (*wrapper[i:j], *page[k:m]):
                yield add(out, times(x, optional=True))
    return out


def flat(expression: list) -> str:
    """An expression as JSON of one list: items in order, what they hold between their opening and their times.

    What is told of slots is left out.
    """
    out, todo = [], [iter(expression)]
    ends: list[str] = []
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
            out.extend((")", ends.pop()) if ends else ())
        elif item[0] == "#":
            out.extend(("#", item[-1]))
        else:
            out.extend(item[:-2])
            todo.append(iter(item[-2]))
            ends.append(item[-1])
    return json.dumps(out)


def told(expression: list) -> list[list]:
    """What is told of the slots of an expression, in order."""
    out, todo = [], [iter(expression)]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
        elif item[0] != "#":
            todo.append(iter(item[-2]))
        elif len(item) > 2:
            out.append(item[1])
    return out


def nested(text: str, telling: list[list] | None = None) -> list:
    """The expression that ``flat`` wrote, with what ``told`` found."""
    tokens, open_, more = iter(json.loads(text)), [([], [])], iter(telling or ())
    for token in tokens:
        if token == "#":
            open_[-1][1].append(["#", *([] if telling is None else [next(more)]), next(tokens)])
        elif token == ")":
            head, items = open_.pop()
            open_[-1][1].append([*head, items, next(tokens)])
        else:
            open_.append((["e", next(tokens)] if token == "e" else ["g"], []))
    return open_[0][1]


def below(at: int, element: str) -> int:
    """Number of the path that leads from path ``at`` into ``element``; 0 is the page. Paths may be thousands long."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(element.encode(), at) >> 1


def place(at: str, element: str) -> str:
    """Whether text in ``element`` of a place is "outside" the main text, "inside" an article or at neither ("").

    A name counts only as a whole: ``sidebar`` is one, ``no-sidebar`` and ``entry-header`` are others.
    An element "before" an article may be its lead.
    """
    tag, _, given = element.partition(".")
    names = given.split()
    if at == "inside" and tag == "header":
        names = [n for n in names if not HEADER_NAMES.fullmatch(n)]
    elif tag in OUTSIDE:
        return "outside"
    judged = tag not in UNJUDGED and any(map(OUTSIDE_NAMES.fullmatch, names))
    commented = tag not in ("html", "body", "main") and any(map(COMMENT_NAMES.fullmatch, names))
    if at == "outside" or judged or commented:
        return "outside"
    return "inside" if tag in INSIDE else at


def first_article(items: list, where: str) -> int:
    """Number of items before the first with an article's element at this level; 0 if none has."""
    def has(item):
        # Groups hold elements of the same level; they are few and not nested deep.
        return any(map(has, item[1])) if item[0] == "g" else (
            item[0] == "e" and item[1].partition(".")[0] in INSIDE and place(where, item[1]) == "inside")

    return next((i for i, item in enumerate(items) if has(item)), 0)


def slots(wrapper: list) -> Iterator[tuple[int, str, list]]:
    """Path, place and what is told of each text slot of an expression."""
    todo: list[tuple[list, int, str, int]] = [(wrapper, 0, "", first_article(wrapper, ""))]
    while todo:
        items, at, where, leading = todo.pop()
        for i, item in enumerate(items):
            if item[0] == "#":
                yield at, where, item[1]
            elif item[0] == "g":
                todo.append((item[1], at, where, len(item[1]) if i < leading else 0))
            else:
                to = place(where, item[1])
                if to == "" and i < leading and item[1].partition(".")[0] in LEADING:
                    to = "before"
                todo.append((item[2], below(at, item[1]), to, first_article(item[2], to) if to == "" else 0))


def main_slots(wrapper: list, pages: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Slots of main text, of what leads to it, those for pages on which none of these has text, and texts of the host.

    ``pages`` is the number of the host's pages. A text of the host is numbered
    as if it were an element below its slot.
    """
    paths = {"inside": set(), "before": set(), "": set()}
    size, fixed = dict.fromkeys(paths, 0), set()
    for at, where, (texts, seen, n, chars) in slots(wrapper):
        if where == "outside":
            continue
        paths[where].add(at)
        if where != "inside" and len(seen) >= LEAST_PAGES and 2 * n > pages:
            fixed.update(below(at, str(t)) for t in texts)
            chars -= n * sum(t & (1 << LENGTH_BITS) - 1 for t in texts)
        size[where] += max(0, chars)
    core, lead = paths["inside"], paths["before"]
    rest = (paths[""] | lead) - core
    if size["inside"] < size[""]:
        core, lead, rest = core | rest, set(), set()
    return sorted(core), sorted(lead), sorted(rest), sorted(fixed)


def read(page: str, core: set[int], rest: set[int], fixed: set[int] = frozenset(), lead: set[int] = frozenset()) -> str:
    """Blocks of a page's main text joined by blank lines. Of slots in ``lead`` those before the first article count."""
    stack = [0]
    found = {(own, main): [] for own in (True, False) for main in (True, False)}
    before, leads = True, []
    for kind, what in events(page):
        if kind == "<":
            stack.append(below(stack[-1], what))
            before = before and what.partition(".")[0] not in INSIDE
        elif kind == ">":
            stack.pop()
        elif stack[-1] in core or stack[-1] in rest:
            own = not (fixed and below(stack[-1], str(text_number(what))) in fixed)
            found[own, stack[-1] in core].append(what)
            if own and before and stack[-1] in lead:
                leads.append(what)
    blocks = next(filter(None, found.values()), [])
    return "\n\n".join([*leads, *blocks] if blocks is found[True, True] else blocks)


SLOTS = ("core", "lead", "rest", "fixed")


def infer(df: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """One row per host: its wrapper (JSON) and what ``main_slots`` says of it."""
    rows = with_parts(only(df, url, page).toDF("u", "page"), F.col("u"), "host", "path").select("host", "page")

    def batch_of(rows):
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(),
                                                                                    pa.int64()))],
                                          names=["host", "stream", "told", "pages"])

    def streams(batches):
        held: dict[tuple, list] = {}
        size = 0
        for batch in slices(batches):
            for h, p in zip(*(c.to_pylist() for c in batch.columns)):
                expression = stream(p or "", True)
                at, new = (h, flat(expression)), told(expression)
                if at in held:
                    old, n = held[at]
                    held[at] = [list(map(of_two_pages, old, new)), n + 1]
                else:
                    held[at] = [new, 1]
                    size += len(at[1]) + sum(80 + 20 * len(t[0]) for t in new)
            if size > MOST_HELD:
                yield batch_of((*at, json.dumps(t), n) for at, (t, n) in held.items())
                held, size = {}, 0
        yield batch_of((*at, json.dumps(t), n) for at, (t, n) in held.items())

    def aligned(batches):
        # Rows of one stream are joined before it is aligned, so it does not matter in which tasks its pages were.
        host, wrapper, pages = None, None, 0
        last, telling = None, []

        def joined():
            more = nested(last, telling)
            return more if wrapper is None else align(wrapper, more)

        for batch in slices(batches):
            for h, s, t, n in zip(*(c.to_pylist() for c in batch.columns)):
                t = json.loads(t)
                if h == host and s == last:
                    telling, pages = list(map(of_two_pages, telling, t)), pages + n
                    continue
                if h == host:
                    wrapper, last, telling, pages = joined(), s, t, pages + n
                    continue
                if last is not None:
                    yield host, joined(), pages
                host, wrapper, last, telling, pages = h, None, s, t, n
        if last is not None:
            yield host, joined(), pages

    def parts(batches):
        for h, expression, n in aligned(batches):
            yield batch_of([(h, flat(expression), json.dumps(told(expression)), n)])

    def wrap(batches):
        for h, expression, n in aligned(batches):
            columns = [pa.array([c], pa.list_(pa.int64())) for c in main_slots(expression, n)]
            yield pa.RecordBatch.from_arrays([pa.array([h], pa.string()), pa.array([flat(expression)]), *columns],
                                             names=["host", "wrapper", *SLOTS])

    shape = "host string, stream string, told string, pages bigint"
    found = rows.mapInArrow(streams, shape).withColumn("part", F.pmod(F.xxhash64("stream"), F.lit(PARTS)))
    order = ["host", F.length("stream"), "stream"]
    by_part = found.repartition("host", "part").sortWithinPartitions("part", *order).drop("part")
    by_host = by_part.mapInArrow(parts, shape).repartition("host").sortWithinPartitions(*order)
    return by_host.mapInArrow(wrap, "host string, wrapper string, " + ", ".join(f"{c} array<bigint>" for c in SLOTS))


def extract(df: DataFrame, wrappers: DataFrame, keys: Sequence[str] = ("page_id", "url"), url: str = "url",
            page: str = "html") -> DataFrame:
    """``keys`` and the main ``text`` of every page, read through its host's wrapper.

    ``wrappers`` should be a stored table, as it is counted first.
    """
    n = len(keys)
    rows = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)],
                     F.col(f"`{page}`").alias("page"), F.col(f"`{url}`").alias("u"))
    rows = with_parts(rows, F.col("u"), "host", "path").drop("u", "path")
    few = wrappers.select("host", *SLOTS)
    if few.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:
        few = F.broadcast(few)
    joined = rows.join(few, "host", "left").select(*[f"k{i}" for i in range(n)], "page", *SLOTS)
    out = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys]).add("text", "string")

    def run(batches):
        for batch in slices(batches):
            texts = [read(p or "", set(c or ()), set(r or ()), set(f or ()), set(lead or ())) for p, c, lead, r, f in
                     zip(*(batch.column(i).to_pylist() for i in range(n, n + 1 + len(SLOTS))))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string())], names=out.names)

    return joined.mapInArrow(run, out)


def main_text(df: DataFrame, keys: Sequence[str] = ("page_id", "url"), url: str = "url",
              page: str = "html") -> DataFrame:
    """Infer wrappers from all pages and read all pages through them."""
    return extract(df, written(infer(df, url, page), "wrappers"), keys, url, page)
