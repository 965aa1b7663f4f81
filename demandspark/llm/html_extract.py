"""HTML extraction by wrappers: union-free regular expressions inferred from pages of one host.

1. *Tokens.*  A page becomes a tree of its block elements, with the runs of text between them
   as slots.  A label is the tag and those words of class, id and role that tell what a part
   is for.  Inline markup belongs to the text.
2. *Wrappers.*  Pages of a host are aligned one after the other.  The children of an element
   are a sequence of labels; a page that does not fit generalises it: what repeats the part
   before it makes a repeated group, what is missing on one side becomes optional, and texts
   that differ make a slot.  Tasks align their own pages; their wrappers are aligned with each
   other in the same way, first by host and salt, then by host.
3. *Main part.*  On the wrapper of a host, menus, headers, footers, sidebars, notices, adverts,
   forms and comments are left out by their labels, lists of links by their share of links, and
   texts by being the same on all of many pages whose other texts differ.  The main part is the
   article, else the main element, else what is named as content, else the deepest part with
   most of the prose.
4. *Extraction.*  Each page is parsed by the wrapper of its host, of which only the way to the
   main part is left, and gives the texts of its slots.  A page on which the wrapper finds
   nothing gets one of its own.

Defined results: a null or empty page has the text ''; a page without any tag is all text.  A
null url is a host of its own, ''.  Rows that repeat a page are judged one by one; other columns
play no part.  Elements nested deeper than 60 count as parts of the 60th.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.functions.stage import stage
from demandspark.llm.common import renamed, shards

# Fixed names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("br hr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | frozenset(
    "html head body article main section nav header footer aside div p ul ol li dl dt dd table caption thead tbody tfoot tr td th form fieldset blockquote pre figure figcaption address "
    "details summary dialog menu hgroup search center title script style noscript template iframe button select option textarea svg canvas object video audio label".split()
)
# What a block closes that was left open, within the element that holds it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
KEEP_P = frozenset("html head body script style noscript template iframe button select option svg canvas object video audio label title textarea".split())
# Parts that are no article, by tag and by the words of class, id and role.
ASIDE_TAGS = frozenset(
    "head title script style noscript template iframe nav header footer aside form fieldset button select option textarea label menu dialog search svg canvas object video audio".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox sponsor sponsored promo promoted promotion banner sidebar complementary menu nav navbar navigation breadcrumb breadcrumbs "
    "header masthead footer contentinfo copyright comment comments reply replies respond responses discussion disqus cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog "
    "newsletter subscribe subscription signup login share sharing social related recommended widget toolbar pagination pager skip search form".split()
)
MAIN_WORDS = frozenset("main article articlebody post entry story content".split())
CONTAINERS = frozenset("html body div section table tbody tr td center article main".split())

DEPTH = 60
#: Pages from which on a text that never differs is part of the template, and share of links of a menu.
SAME_PAGES, LINK_SHARE = 20, 0.8
#: Hosts that a task aligns before it hands their wrappers on; wrappers of a shard.
HOSTS, SHARD = 2000, 2000
SALTS = 64
BROADCAST_BYTES = 4 << 20


class Part:
    """An element, or a slot of text ('#'), of a page or of a wrapper.

    ``loops`` are ranges of ``kids`` that may repeat.  A page's part has counts of its own.
    """

    __slots__ = ("label", "kids", "loops", "optional", "pages", "chars", "links", "same", "text")

    def __init__(self, label: str) -> None:
        self.label, self.kids, self.loops, self.optional = label, [], [], False
        self.pages, self.chars, self.links, self.same, self.text = 1, 0, 0, 0, None

    @property
    def tag(self) -> str:
        return self.label.partition(".")[0]

    def expression(self) -> str:
        """The wrapper as a regular expression."""
        inner = [k.expression() + ("?" if k.optional else "") for k in self.kids]
        for a, b in sorted(self.loops, key=lambda r: r[1] - r[0]):
            inner[a] = "(" + inner[a]
            inner[b] += ")+"
        return self.label if self.label == "#" else f"<{self.label}>{' '.join(inner)}</>"


# --- step 1: tokens --------------------------------------------------------------------------

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?>[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*+)(?P<rest2>[^>]*+)>?""", re.S)
_ROLE = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def label_of(tag: str, attributes: str) -> str:
    if not attributes or tag == "h1":
        return tag
    words = {w.lower() for m in _ROLE.finditer(attributes) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")}
    words &= ASIDE_WORDS | MAIN_WORDS
    return ".".join([tag, *sorted(words)]) if words else tag


def parse(page: str) -> Part:
    """The tree of the page's blocks and texts."""
    root = Part("#root")
    stack: list[tuple[str, Part]] = [("#root", root)]
    texts: list[tuple[str, bool]] = []
    in_link = False
    #: How many elements of a name are open, so that none is looked for in vain.
    open_: Counter[str] = Counter()

    def flush() -> None:
        if texts and any(t and not t.isspace() for t, _ in texts):
            slot = Part("#")
            slot.text = "".join([t for t, _ in texts])
            slot.chars = sum(len(t) for t, _ in texts)
            slot.links = sum(len(t) for t, link in texts if link)
            slot.same = zlib.crc32(slot.text.encode("utf-8", "replace")) + 1
            stack[-1][1].kids.append(slot)
        texts.clear()

    def close(names, stop) -> None:
        if not any(open_[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                flush()
                open_.subtract(n for n, _ in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in stop:
                return

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            texts.append((entities.unescape(page[at:lt]), in_link))
        if lt == size:
            break
        m = _TAG.match(page, lt)
        if m is None or m.end() == lt:
            texts.append(("<", in_link))
            at = lt + 1
            continue
        at = m.end()
        name = m["name"] or m["name2"]
        if name is None:
            if m["cdata"]:
                texts.append((m["cdata"], in_link))
            continue
        name = name.lower()
        if m["end"] or m["end2"]:
            if name == "a":
                in_link = False
            elif name == "p" or name in BLOCKS or any(n == name for n, _ in stack[-3:]):
                close({name}, ())
            continue
        attributes = m["rest"] or m["rest2"] or ""
        if name in VOID:
            if name in BREAKS:
                texts.append((" ", False))
            continue
        if name == "a":
            in_link = True
        label = label_of(name, attributes)
        if name not in BLOCKS and label == name:
            continue
        flush()
        if name in BLOCKS and name not in KEEP_P:
            close({"p"}, {"button", "td", "th", "table", "object"})
        if name in CLOSES:
            outer, stop = CLOSES[name]
            while stack[-1][0] != "#root":
                before = len(stack)
                close(outer, stop)
                if len(stack) == before:
                    break
        if attributes.endswith("/") and name not in BLOCKS:
            continue
        if len(stack) > DEPTH:
            part = stack[-1][1]
        else:
            part = Part(label)
            stack[-1][1].kids.append(part)
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            stop_at = end.start() if end else size
            if name in ("title", "textarea"):
                slot = Part("#")
                slot.text, slot.chars = entities.unescape(page[at:stop_at]), stop_at - at
                part.kids.append(slot)
            close_at = page.find(">", stop_at) + 1
            at = close_at or size
            continue
        stack.append((name, part))
        open_[name] += 1
    flush()
    return root


# --- step 2: wrappers ------------------------------------------------------------------------


def place_for(kids: list[Part], loops: list[tuple[int, int]], p: int, label: str) -> tuple[int, str]:
    """Where the next child goes, ``p`` being the place after the last one, and how: as expected, round a known loop, over optional parts, round a new loop, or in between."""
    if p < len(kids) and kids[p].label == label:
        return p, "next"
    back = [a for a, b in loops if kids[a].label == label and (b == p - 1 or a < p <= b)]
    if back:
        return max(back), "loop"
    if p and kids[p - 1].label == label:
        return p - 1, "new loop"
    for q in range(p + 1, len(kids)):
        if kids[q].label == label:
            return q, "skip"
    for q in range(p - 2, -1, -1):
        if kids[q].label == label:
            return q, "new loop"
    return p, "insert"


def absorb(wrapper: Part, part: Part) -> None:
    """Generalise ``wrapper`` so that it fits ``part`` (of a page or another wrapper) as well."""
    todo = deque([(wrapper, part, False)])
    while todo:
        w, x, again = todo.popleft()
        fresh = not w.pages
        w.pages += 0 if again else x.pages
        w.chars += x.chars
        w.links += x.links
        w.optional |= x.optional
        if w.same != x.same:
            w.same = 0
        w.text = None
        kids, loops, p = w.kids, w.loops, 0
        seen: dict[int, Part] = {}
        of: list[Part] = []
        for child in x.kids:
            q, how = place_for(kids, loops, p, child.label)
            if how == "insert":
                loops[:] = [(a + (a >= q), b + (b >= q)) for a, b in loops]
                new = Part(child.label)
                new.pages, new.same = 0, child.same
                new.optional = not fresh or any(a < q <= b for a, b in loops)
                kids.insert(q, new)
            elif how == "new loop":
                if (q, p - 1) not in loops:
                    loops.append((q, p - 1))
            elif how == "skip":
                for k in kids[p:q]:
                    k.optional = True
            elif how == "loop":  # this time round, what is left of the group was missing
                for k in kids[p : max((b + 1 for a, b in loops if a == q and b >= p), default=p)]:
                    k.optional = True
            kid = kids[q]
            todo.append((kid, child, id(kid) in seen))  # round a loop: more of the same page
            seen[id(kid)] = kid
            of.append(kid)
            p = q + 1
        for i, k in enumerate(kids):
            if id(k) not in seen or i >= p and any(a < p <= i <= b for a, b in loops):
                k.optional = True
        where = {id(k): i for i, k in enumerate(kids)}
        for a, b in x.loops:
            i, j = sorted((where[id(of[a])], where[id(of[b])]))
            if (i, j) not in loops:
                loops.append((i, j))


def wrapper_of(page: Part) -> Part:
    """The wrapper of one page: its repeated parts are groups."""
    out = Part(page.label)
    out.pages, out.same = 0, page.same
    absorb(out, page)
    return out


def frozen(part: Part) -> list:
    return [part.label, part.optional, part.pages, part.chars, part.links, part.same, part.loops, [frozen(k) for k in part.kids]]


def thawed(row: list) -> Part:
    out = Part(row[0])
    out.optional, out.pages, out.chars, out.links, out.same = row[1:6]
    out.loops = [tuple(x) for x in row[6]]
    out.kids = [thawed(k) for k in row[7]]
    return out


# --- step 3: the main part -------------------------------------------------------------------


def holds_article(part: Part) -> bool:
    todo = list(part.kids)
    while todo:
        k = todo.pop()
        words = set(k.label.split(".")[1:])
        if k.tag in ("article", "main") and not words & ASIDE_WORDS:
            return True
        todo += k.kids
    return False


def left_out(part: Part) -> bool:
    """Whether a label names what is no part of an article."""
    tag, *words = part.label.split(".")
    if tag in ASIDE_TAGS:
        return True
    return bool(ASIDE_WORDS.intersection(words)) and tag not in ("html", "body") and not holds_article(part)


def prose(part: Part, out: set[int]) -> tuple[int, int]:
    """Characters and those in links below a part, without what is left out."""
    if id(part) in out:
        return 0, 0
    chars, links = part.chars, part.links
    for k in part.kids:
        a, b = prose(k, out)
        chars, links = chars + a, links + b
    return chars, links


def decide(wrapper: Part) -> tuple[set[int], set[int]]:
    """ids of the main parts and of the parts to leave out."""
    out: set[int] = set()
    everything: list[tuple[Part, Part | None]] = []
    todo: list[tuple[Part, Part | None]] = [(wrapper, None)]
    while todo:
        part, parent = todo.pop()
        everything.append((part, parent))
        if left_out(part):
            out.add(id(part))
            continue
        todo += [(k, part) for k in part.kids]
    for part, _ in everything:
        if part.tag in ("ul", "ol") and len(part.kids) and id(part) not in out:
            chars, links = prose(part, out)
            items = sum(k.pages for k in part.kids)
            if part.loops and items and links >= LINK_SHARE * chars:
                out.add(id(part))
    differs = any(p.label == "#" and not p.same for p, _ in everything)
    for part, parent in everything:
        if differs and part.label == "#" and part.same and part.pages >= SAME_PAGES and part.pages >= wrapper.pages and parent is not None and parent.tag not in HEADINGS:
            out.add(id(part))
    live = [(p, parent) for p, parent in everything if id(p) not in out and p.label != "#"]
    tests = (
        lambda p: p.tag == "article",
        lambda p: p.tag == "main" or "main" in p.label.split(".")[1:],
        lambda p: bool(MAIN_WORDS.intersection(p.label.split(".")[1:])),
    )
    for fits in tests:
        groups: dict[int, list[Part]] = {}
        inside: set[int] = set()
        for p, parent in live:  # parents come before their children
            if parent is not None and id(parent) in inside:
                inside.add(id(p))
            elif fits(p):
                inside.add(id(p))
                groups.setdefault(id(parent), []).append(p)
        best = max(groups.values(), key=lambda g: sum(prose(p, out)[0] for p in g), default=[])
        if sum(prose(p, out)[0] for p in best):
            return {id(p) for p in best}, out
    here = wrapper
    while True:
        total = prose(here, out)
        inner = [(prose(k, out), k) for k in here.kids if k.tag in CONTAINERS and id(k) not in out]
        inner = [k for (chars, links), k in inner if chars - links >= 0.6 * (total[0] - total[1]) > 0]
        if not inner:
            return {id(here)}, out
        here = inner[0]


def plan_of(wrapper: Part) -> list:
    """What extraction needs of a wrapper: the way to the main parts, and there what stays.  [label, what, loops, kids], what: 0 on the way, 1 main, 2 left out."""
    main, out = decide(wrapper)

    def way(part: Part, inside: bool) -> tuple[list, bool]:
        if id(part) in out:
            return [part.label, 2, [], []], False
        inside = inside or id(part) in main
        kids = [way(k, inside) for k in part.kids]
        useful = inside or any(u for _, u in kids)
        if not useful:
            return [part.label, 2, [], []], False
        return [part.label, 1 if inside else 0, part.loops, [k for k, _ in kids]], True

    return way(wrapper, False)[0]


# --- step 4: extraction ----------------------------------------------------------------------


class Plan:
    __slots__ = ("label", "what", "loops", "kids")

    def __init__(self, row: list) -> None:
        self.label, self.what = row[0], row[1]
        self.loops, self.kids = [tuple(x) for x in row[2]], [Plan(k) for k in row[3]]


def matched(page: Part, plan: Plan) -> list[str]:
    """The texts of the slots of the main part, in page order."""
    out: list[str] = []

    def walk(part: Part, plan: Plan | None, inside: bool) -> None:
        if plan is not None:
            if plan.what == 2:
                return
            inside = inside or plan.what == 1
        elif left_out(part):
            return
        if part.label == "#":
            if inside:
                text = " ".join(part.text.split())
                if text:
                    out.append(text)
            return
        kids, loops, p = (plan.kids, plan.loops, 0) if plan is not None else ([], [], 0)
        for child in part.kids:
            q, how = place_for(kids, loops, p, child.label)
            if how == "insert":
                walk(child, None, inside)
            else:
                walk(child, kids[q], inside)
                p = q + 1

    walk(page, plan, False)
    return out


def main_text(page: str, plan: Plan | None) -> str:
    tree = parse(page)
    found = matched(tree, plan) if plan is not None else []
    return " ".join(found or matched(tree, Plan(plan_of(wrapper_of(tree)))))


# --- tasks -----------------------------------------------------------------------------------


def align_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, Part] = {}
    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if not page:
                continue
            tree = parse(page)
            if host in wrappers:
                absorb(wrappers[host], tree)
            else:
                wrappers[host] = wrapper_of(tree)
        if len(wrappers) >= HOSTS:
            yield handed(wrappers)
            wrappers = {}
    if wrappers:
        yield handed(wrappers)


def handed(wrappers: dict[str, Part]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(wrappers), pa.string()), pa.array([json.dumps(frozen(w), separators=(",", ":")) for w in wrappers.values()], pa.string())], names=["host", "wrapper"])


def align_wrappers(last: bool):
    """Group: wrappers of one host aligned with each other; at the end each becomes a plan."""

    def run(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers: dict[str, Part] = {}
        for batch in group:
            for host, text in zip(batch.column("host").to_pylist(), batch.column("wrapper").to_pylist(), strict=True):
                other = thawed(json.loads(text))
                if host in wrappers:
                    absorb(wrappers[host], other)
                else:
                    wrappers[host] = other
        if not last:
            yield handed(wrappers)
            return
        plans = [json.dumps(plan_of(w), separators=(",", ":")) for w in wrappers.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(wrappers), pa.string()), pa.array(plans, pa.string())], names=["host", "plan"])

    return run


def extract_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, Plan] = {}
    for batch in batches:
        texts = []
        for page, plan in zip(batch.column("html").to_pylist(), batch.column("plan").to_pylist(), strict=True):
            if plan is not None and plan not in known:
                if len(known) >= HOSTS:
                    known.clear()
                known[plan] = Plan(json.loads(plan))
            texts.append(main_text(page, known.get(plan)) if page else "")
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


# --- the operator ----------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; else ''."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.lower(F.regexp_extract(rest, "^[^/?#]*", 0))).otherwise(F.lit(""))


def host_plans(pages: DataFrame) -> DataFrame:
    """host and plan: what the wrapper of each host of ``pages`` (host, html) says about the main part."""
    partial = stage(pages.select("host", "html").mapInArrow(align_pages, "host string, wrapper string"), "wrappers")
    n = shards(partial.count(), SHARD)
    salted = partial.withColumn("shard", F.pmod(F.xxhash64("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))), F.lit(n * 4)))
    few = salted.groupBy("shard").applyInArrow(align_wrappers(False), "host string, wrapper string")
    return few.withColumn("shard", F.pmod(F.xxhash64("host"), F.lit(n))).groupBy("shard").applyInArrow(align_wrappers(True), "host string, plan string")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row of ``pages`` (page_id, url, html)."""
    rows = renamed(pages, page_id="page_id", url="url", html="html").withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    plans = stage(host_plans(rows), "plans")
    size = plans.agg(F.sum(F.length("host") + F.length("plan"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = rows.join(F.broadcast(plans), "host", "left")
    else:  # a host may have very many pages
        salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("salt", salt).join(plans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["host", "salt"], "left")
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return joined.select("page_id", "url", "html", "plan").mapInArrow(extract_pages, f"page_id {types['page_id']}, url string, text string, n_chars long")
