"""HTML extraction with wrappers: union-free regular expressions inferred from the pages of a host.

A page is read as a stream of fields, one for each block of text, each with the path of elements around it. Pages of a host
are aligned field by field: equal neighbours fold into repeated groups, fields that only some pages have become optional,
differing texts become slots, and a text that all pages share stays a constant of the template. Pages of one shape are
merged first, then wrappers are aligned pairwise in a tree, so a host of any size is inferred from many small pieces.

The wrapper decides a page's main text. Each of the page's fields takes what the host's pages tell of its node: constants of
three or more different pages are template, groups that are mostly links are menus, and the unlinked text that slots hold on
average is their weight. The main region is found by going down from the page's root into the element that holds most
weight, for as long as one does. Names of elements and classes are hints: they scale a weight by a fixed factor, and a part of the
main region with the name of an advert, a form or a comment goes unless the wrapper finds most of the region's text in it.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from afterglow.llm.rows import texts_of
from afterglow.llm.spread import spread_join
from afterglow.session import materialise, ship_package

OPENING = re.compile(r"<(?:(!--)|(/?)([a-zA-Z][^\s/>]*)|[!?])")
TAG_STOP = re.compile("[>\"']")
#: Elements whose content is no text of the page.
RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in "script style noscript template svg iframe object canvas math".split()}
#: One attribute, name and value; values are taken whole, so that nothing inside them reads as a name.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Numbers of character references with more digits than any character has.
LONG_REFERENCE = re.compile(r"&#(?:0*([0-9]{8,})|[xX]0*([0-9a-fA-F]{7,}));?")
LEADING_ZEROS = re.compile(r"&#([xX]?)0+(?=[0-9a-fA-F])")
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Blocks that end an open element of the same kind, as their end tags may be left out.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH_ENDS = BLOCKS - {"option", "optgroup", "legend", "summary", "caption", "tbody", "thead", "tfoot", "tr", "td", "th", "button", "textarea", "select"}
SCOPES = frozenset({"ul", "ol", "dl", "table", "div", "section", "article", "nav", "aside", "header", "footer", "main", "form", "blockquote"})
#: Elements that hold a run of text; a region is never narrowed down to one of them.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup header li ul ol dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption address summary details".split())

#: Controls and the like, which hold no text of an article.
NEVER_TAGS = frozenset("head title button select option optgroup textarea legend".split())
#: Elements that seldom belong to an article.
OUTSIDE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: Words of class names, ids and roles that hint at what stands around an article.
OUTSIDE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline captcha comment comments complementary consent contentinfo cookie cookies copyright dialog "
    "disclaimer disqus feedback footer form gdpr hidden login menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion promotions recommended recommendation recommendations register related replies reply respond rss search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toc toolbar tooltip topbar trending warning widget widgets".split()
)
#: Words of headers, which are part of an article only inside it.
HEADER_WORDS = frozenset("header masthead".split())
MAIN_WORDS = frozenset("article articlebody main content story entry post".split())
WORD = re.compile(r"[a-z]+")
#: What a hint does to a weight, and the share of an element's weight that one part must hold for the region to narrow to it.
HINT_FOR, HINT_AGAINST, NARROW = 4.0, 0.125, 0.6
#: Levels of elements that paths tell apart; deeper ones count as children of the last.
DEPTH = 64
#: Different pages on which a constant must stand to be of the template.
TEMPLATE_PAGES = 3
#: Pages are copies of one text where constants hold more than so many times the text of slots.
COPIES = 4
#: Nodes of a wrapper; beyond twice as many those of the fewest pages go. What the host's pages tell of those is counted apart, see `counted`.
WRAPPER_NODES = 2048
#: Longer constants are known by their hash.
CONSTANT_CHARS = 80


class Path:
    """An element's place: its label under those of the elements around it."""

    __slots__ = ("against", "chain", "inside", "named", "never", "string", "tag", "under")

    def __init__(self, tag: str, label: str, above: Path | None, words: frozenset):
        self.tag = tag
        deep = above is not None and len(above.chain) >= DEPTH
        self.string = label if above is None else f"{above.chain[DEPTH - 1].string}/…/{tag}" if deep else f"{above.string}/{label}"
        self.chain: tuple[Path, ...] = above.chain if deep else ((*above.chain, self) if above else (self,))
        body = tag in ("html", "body")
        self.inside = bool(above and above.inside) or tag in ("article", "main") or bool(words & MAIN_WORDS) and not body
        self.never = bool(above and above.never) or tag in NEVER_TAGS
        self.named = not body and (tag in OUTSIDE_TAGS or bool(words & OUTSIDE_WORDS) or (tag == "header" or bool(words & HEADER_WORDS)) and not (above and above.inside))
        self.against = bool(above and above.against) or self.named
        self.under: dict[str, Path] = {}

    def below(self, tag: str, label: str, words: frozenset) -> Path:
        known = self.under.get(label)
        if known is None:
            known = self.under[label] = Path(tag, label, self, words)
        return known


class Field:
    """A block of text: the path of elements around it, the text, and how much of it is links."""

    __slots__ = ("linked", "path", "text")

    def __init__(self, path: Path, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def tokens(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """(start, end, tag or None for comments and the like, whether it closes, attributes), in time linear in the page.

    A quote counts only behind an equals sign. Where a quoted value never ends, quotes count no longer; where no `>`
    is left, nothing more is a tag. Raw elements come whole, to the end of the page if they are not closed.
    """
    at, size, quotes = 0, len(page), True
    while found := OPENING.search(page, at):
        start, at = found.span()
        if found[1]:
            end = page.find("-->", at)
            at = size if end < 0 else end + 3
            yield start, at, None, False, ""
            continue
        end, look = -1, at
        while quotes and found[3]:
            stop = TAG_STOP.search(page, look)
            if stop is None:
                quotes = False
            elif stop[0] == ">":
                end = stop.start()
                break
            elif page[max(at, stop.start() - 8) : stop.start()].rstrip().endswith("="):
                close = page.find(stop[0], stop.end())
                if close < 0:
                    quotes = False
                look = close + 1
            else:
                look = stop.end()
        if end < 0:
            end = page.find(">", at)
        if end < 0:
            return
        attributes, at = page[at:end], end + 1
        tag = found[3].lower() if found[3] else None
        if tag in RAW and not found[2]:
            if not attributes.endswith("/"):
                closing = RAW[tag].search(page, at)
                at = closing.end() if closing else size
            tag = None
        yield start, at, tag, bool(found[2]), attributes


def _marks(attributes: str) -> tuple[list[str], bool]:
    """Name words of an element's attributes, and whether it is hidden."""
    names: list[str] = []
    hidden = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role", "itemprop"):
            names += WORD.findall(value)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return names, hidden


def decoded(text: str) -> str:
    """The text with character references decoded; numbers beyond all characters become U+FFFD."""
    if "&" not in text:
        return text
    return html.unescape(LONG_REFERENCE.sub("�", LEADING_ZEROS.sub(r"&#\1", text)) if "&#" in text else text)


def fields(page: str) -> list[Field]:
    """Non-empty blocks of a page in order, white space made single and character references decoded."""
    out: list[Field] = []
    root = Path("", "", None, frozenset())
    root.string = ""
    stack: list[Path] = []  # open blocks
    opened: Counter[str] = Counter()
    path = root
    buffer: list[str] = []
    linked = links = at = 0
    skipped: list[str] = []  # open elements from a hidden or outside inline element on
    in_skipped: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join(decoded("".join(buffer)).split())
            if text:
                out.append(Field(path, text, linked))
            buffer.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not skipped:
            buffer.append(text)
            if links:
                linked += len(text)

    def drop(size: int) -> None:
        while len(stack) > size:
            opened[stack.pop().tag] -= 1

    for start, end, tag, closing, attributes in tokens(page):
        add(page[at:start])
        at = end
        if tag is None:
            continue
        if skipped:
            if tag in VOID or attributes.endswith("/"):
                continue
            if not closing:
                skipped.append(tag)
                in_skipped[tag] += 1
            elif in_skipped[tag]:
                while True:
                    last = skipped.pop()
                    in_skipped[last] -= 1
                    if last == tag:
                        break
                continue
            else:
                skipped.clear()  # an element around it ends
                in_skipped.clear()
            if skipped:
                continue
        if tag not in BLOCKS:
            if tag == "br":
                buffer.append(" ")
            elif tag == "a":
                links = 0 if closing else 1
            if not closing and attributes and tag not in VOID and not attributes.endswith("/"):
                names, hidden = _marks(attributes)
                if hidden or OUTSIDE_WORDS.intersection(names) and tag not in ("b", "i", "em", "strong", "u"):
                    skipped.append(tag)
                    in_skipped[tag] += 1
            continue
        flush()
        links = 0
        if tag == "hr":
            continue
        if closing:
            if opened[tag]:
                size = len(stack) - 1
                while stack[size].tag != tag:
                    size -= 1
                drop(size)
        else:
            if tag in PARAGRAPH_ENDS and stack and stack[-1].tag == "p":
                drop(len(stack) - 1)
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
                for i in range(len(stack) - 1, max(len(stack) - DEPTH, 0) - 1, -1):
                    if stack[i].tag in CLOSES[tag]:
                        drop(i)
                        break
                    if stack[i].tag in SCOPES:
                        break
            label, hidden, names = tag, False, []
            if attributes and not attributes.isspace():
                names, hidden = _marks(attributes)
                if names:
                    label = ".".join([tag, *names[:8]])
            if hidden:
                skipped.append(tag)
                in_skipped[tag] += 1
                path = stack[-1] if stack else root
                continue
            if not attributes.endswith("/"):
                above = stack[-1] if stack else root
                stack.append(above.below(tag, label, frozenset(names)) if stack else root.under.setdefault(label, Path(tag, label, None, frozenset(names))))
                opened[tag] += 1
        path = stack[-1] if stack else root
    rest = page[at:]
    add(rest[: m.start()] if (m := re.search(r"<[/!a-zA-Z][^>]*\Z", rest)) else rest)
    flush()
    return out


# --- wrappers: path, constant text or None for a slot, repeated, optional, pages, linked characters, characters, hashes of up to three different pages
PATH, TEXT, REPEATED, OPTIONAL, PAGES, LINKED, CHARS, SEEN = range(8)


def _constant(texts: list[str]) -> str:
    text = "\n".join(texts)
    return text if len(text) <= CONSTANT_CHARS else "#" + xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


def folded(page: list[Field]) -> tuple[list[list], list[int]]:
    """A page as wrapper nodes, neighbours of one path folded into a repeated node, and the node of each field.

    Repeated groups of several fields fold to the nodes of one round, all repeated. A group's text is that of all its rounds.
    """
    nodes: list[list] = []
    node_of: list[int] = []
    for field in page:
        if nodes and nodes[-1][PATH] == field.path.string:
            nodes[-1][REPEATED] = True
            nodes[-1][TEXT].append(field.text)
            nodes[-1][LINKED] += field.linked
            nodes[-1][CHARS] += len(field.text)
        else:
            nodes.append([field.path.string, [field.text], False, False, 1, field.linked, len(field.text), []])
        node_of.append(len(nodes) - 1)
    nodes, node_of = _fold_groups(nodes, node_of)
    own = int.from_bytes(xxhash.xxh3_64_digest("\n".join(f.text for f in page).encode("utf-8", "surrogatepass"))[:6])
    for node in nodes:
        node[TEXT], node[SEEN] = _constant(node[TEXT]), [own]
    return nodes, node_of


def _fold_groups(nodes: list[list], node_of: list[int]) -> tuple[list[list], list[int]]:
    """Fold tandem repeats of any number of nodes; a round is as long as the way back to the last node of its first path."""
    while len({n[PATH] for n in nodes}) < len(nodes):
        out: list[list] = []
        paths = [n[PATH] for n in nodes]
        kept: list[str] = []
        last: dict[str, int] = {}
        new = [0] * len(nodes)
        i = 0
        while i < len(nodes):
            back = last.get(paths[i])
            size = len(out) - back if back is not None else 0
            if size and kept[back:] == paths[i : i + size]:
                for k in range(size):
                    node, other = out[back + k], nodes[i + k]
                    node[TEXT] += other[TEXT]
                    node[REPEATED] = True
                    node[LINKED] += other[LINKED]
                    node[CHARS] += other[CHARS]
                    new[i + k] = back + k
                i += size
            else:
                last[paths[i]] = new[i] = len(out)
                out.append(nodes[i])
                kept.append(paths[i])
                i += 1
        if len(out) == len(nodes):
            break
        nodes, node_of = out, [new[j] for j in node_of]
    return nodes, node_of


def _merge(node: list, other: list) -> None:
    if node[TEXT] != other[TEXT]:
        node[TEXT] = None
    node[REPEATED] = node[REPEATED] or other[REPEATED]
    node[OPTIONAL] = node[OPTIONAL] or other[OPTIONAL]
    for k in (PAGES, LINKED, CHARS):
        node[k] += other[k]
    if len(node[SEEN]) < TEMPLATE_PAGES:
        node[SEEN] = sorted({*node[SEEN], *other[SEEN]})[:TEMPLATE_PAGES]


def _ascending(place: dict, keys: Iterable[tuple[int, object]]) -> list[tuple[int, int]]:
    """The longest ascending run of (place of a key left, place right) over the keys of the right side, last pair first."""
    ends: list[int] = []
    chain: list[tuple[int, int, int]] = []  # place left, place right, the entry before
    tops: list[int] = []
    for j, key in keys:
        i = place.get(key)
        if i is None:
            continue
        k = bisect_left(ends, i)
        chain.append((i, j, tops[k - 1] if k else -1))
        ends[k : k + 1], tops[k : k + 1] = [i], [len(chain) - 1]
    run, entry = [], tops[-1] if tops else -1
    while entry >= 0:
        i, j, entry = chain[entry]
        run.append((i, j))
    return run


def _numbered(paths: list[str]) -> list[tuple[str, int]]:
    """Each path with how often it stood before."""
    seen: Counter[str] = Counter()
    out = []
    for path in paths:
        out.append((path, seen[path]))
        seen[path] += 1
    return out


def _common(left: list[str], right: list[str]) -> list[tuple[int, int]]:
    """Pairs of places where two lists agree, ascending on both sides: equal ends first, then the longest ascending run of
    what each side holds once, and so on between those. Where nothing stands once, the longest matching blocks count, in
    long lists the longest ascending run of equally numbered ones."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        while a < a_end and b < b_end and left[a] == right[b]:
            pairs.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and left[a_end - 1] == right[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            pairs.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        once_left = {p: n for p, n in Counter(left[a:a_end]).items() if n == 1}
        once_right = Counter(right[b:b_end])
        place = {left[i]: i for i in range(a, a_end) if left[i] in once_left and once_right.get(left[i]) == 1}
        run = _ascending(place, ((j, right[j]) for j in range(b, b_end))) if place else []
        if not run:
            if (a_end - a) * (b_end - b) <= 4096:
                for i, j, n in SequenceMatcher(None, left[a:a_end], right[b:b_end], autojunk=False).get_matching_blocks():
                    pairs += [(a + i + k, b + j + k) for k in range(n)]
                continue
            place = {key: i for i, key in enumerate(_numbered(left[a:a_end]), a)}
            run = _ascending(place, enumerate(_numbered(right[b:b_end]), b))
            if not run:
                continue
        hi_a, hi_b = a_end, b_end
        for i, j in run:
            pairs.append((i, j))
            todo.append((i + 1, hi_a, j + 1, hi_b))
            hi_a, hi_b = i, j
        todo.append((a, hi_a, b, hi_b))
    return sorted(pairs)


def aligned(left: list[str], right: list[str]) -> Iterator[tuple[int | None, int | None]]:
    """Pairs of places of two lists of paths: both where paths agree, one None where only one side has the node."""
    i = j = 0
    for a, b in [*_common(left, right), (len(left), len(right))]:
        yield from ((k, None) for k in range(i, a))
        yield from ((None, k) for k in range(j, b))
        if a < len(left):
            yield a, b
        i, j = a + 1, b + 1


def generalised(wrapper: list[list], other: list[list]) -> list[list]:
    """The wrapper that covers both: mismatches become optional nodes, differing texts become slots."""
    out: list[list] = []
    for i, j in aligned([n[PATH] for n in wrapper], [n[PATH] for n in other]):
        if i is None or j is None:
            node = wrapper[i] if j is None else other[j]
            node[OPTIONAL] = True
        else:
            node = wrapper[i]
            _merge(node, other[j])
        if out and out[-1][PATH] == node[PATH]:  # optional nodes of one path side by side are one repeated node
            _merge(out[-1], node)
            out[-1][TEXT], out[-1][REPEATED] = None, True
        else:
            out.append(node)
    if len(out) > 2 * WRAPPER_NODES:
        least = sorted((n[PAGES] for n in out), reverse=True)[WRAPPER_NODES]
        out = [n for n in out if n[PAGES] > least] or out[:WRAPPER_NODES]
    return out


def united(parts: list[list[list]]) -> list[list]:
    """One wrapper of many: those of one shape merged node by node, the others aligned pairwise in a tree."""
    shapes: dict[tuple, list[list]] = {}
    for part in parts:
        shape = tuple(n[PATH] for n in part)
        if shape in shapes:
            for node, other in zip(shapes[shape], part, strict=True):
                _merge(node, other)
        else:
            shapes[shape] = part
    now = list(shapes.values())
    while len(now) > 1:
        now = [generalised(*now[i : i + 2]) if i + 1 < len(now) else now[i] for i in range(0, len(now), 2)]
    return now[0] if now else []


def judged(wrapper: list[list]) -> list[list]:
    """[path, average weight, template, menu] of each node: what a page needs of its host's wrapper.

    Constants of three different pages are template, unless constants outweigh the slots by far: then the pages are copies.
    Nodes that are mostly links are menus. Others weigh what unlinked text a page has there.
    """
    told = [_told(n) for n in wrapper]
    copies = sum(w for w, c, _ in told if c) > COPIES * sum(w for w, c, _ in told if not c)
    return [[n[PATH], round(w, 1), c and not copies, m] for n, (w, c, m) in zip(wrapper, told, strict=True)]


def _told(node: list) -> tuple[float, bool, bool]:
    """Average weight of a node, whether it is a constant of enough pages, and whether it is mostly links."""
    return (node[CHARS] - node[LINKED]) / node[PAGES], node[TEXT] is not None and len(node[SEEN]) >= TEMPLATE_PAGES, 2 * node[LINKED] > node[CHARS]


def places(marks: list[list], nodes: list[list]) -> list[str]:
    """A name for the place of each of a page's nodes: the wrapper's node, or for others their path, numbered in the page."""
    out = [""] * len(nodes)
    seen: Counter[str] = Counter()
    for i, j in aligned([m[0] for m in marks], [n[PATH] for n in nodes]):
        if j is None:
            continue
        if i is not None:
            out[j] = str(i)
        else:
            path = _constant([nodes[j][PATH]])
            out[j] = f"{seen[path]} {path}"
            seen[path] += 1
    return out


def main_text(page: list[Field], marks: list[list], told: dict[str, tuple[float, bool, bool]] | None = None) -> str:
    """Texts of the fields of a page's main region, joined by line feeds; `marks` are those of `judged`, for the page's host.

    Where the wrapper has lost nodes, `told` has weight, template and menu of each of the page's `places` instead.
    """
    nodes, node_of = folded(page)
    path_of: list[Path] = [page[0].path] * len(nodes)
    for field, n in zip(reversed(page), reversed(node_of), strict=True):
        path_of[n] = field.path
    weight = [float(n[CHARS] - n[LINKED]) for n in nodes]
    template, menu = [False] * len(nodes), [2 * n[LINKED] > n[CHARS] for n in nodes]
    if told is None:
        for i, j in aligned([m[0] for m in marks], [n[PATH] for n in nodes]):
            if i is not None and j is not None:
                _, weight[j], template[j], menu[j] = marks[i]
    else:
        weight, template, menu = map(list, zip(*(told[place] for place in places(marks, nodes)), strict=True))
    # the weight in each element, as the wrapper has it and with hints
    plain: dict[Path | None, float] = defaultdict(float)
    hinted: dict[Path | None, float] = defaultdict(float)
    parts: dict[Path | None, set[Path]] = defaultdict(set)
    for path, w, t, m in zip(path_of, weight, template, menu, strict=True):
        if path.never or t or m:
            continue
        scaled = w * (HINT_FOR if path.inside else 1.0) * (HINT_AGAINST if path.against else 1.0)
        above = None
        for element in (None, *path.chain):
            plain[element] += w
            hinted[element] += scaled
            if element is not None:
                parts[above].add(element)
            above = element
    region: Path | None = None
    while narrower := [p for p in parts[region] if p.tag not in TEXT_BLOCKS and hinted[p] >= NARROW * hinted[region] > 0]:
        region = narrower[0]
    kept = []
    for path, node, t, m in zip(path_of, nodes, template, menu, strict=True):
        ok = not (path.never or t or m and (node[REPEATED] or not path.inside)) and (region is None or region in path.chain)
        if ok and path.against:
            below = path.chain[path.chain.index(region) + 1 :] if region is not None else path.chain
            ok = not any(p.named and 2 * plain[p] <= plain[region] for p in below)
        kept.append(ok)
    return "\n".join([f.text for f, n in zip(page, node_of, strict=True) if kept[n]])


def host_of(url: Column) -> Column:
    """Host of a URL, lower-cased; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, salts: int = 32) -> DataFrame:
    """(host, pages, characters of their fields, wrapper as JSON) inferred from all pages, given as (host, html).

    Each Arrow batch infers a wrapper for each of its hosts; those are united by (host, salt), then by host, from a sorted
    stream. A host with a third of all pages arrives as one wrapper a batch; a wrapper has at most 2 x WRAPPER_NODES nodes.
    One that has lost nodes holds fewer characters than its pages.
    """
    ship_package(pages.sparkSession)

    def from_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[list[list]]] = defaultdict(list)
            for host, page in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                found[host].append(folded(fields(page))[0])
            yield _written((host, len(parts), sum(n[CHARS] for part in parts for n in part), united(parts)) for host, parts in found.items())

    def from_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, count, chars, parts = None, 0, 0, []
        for batch in batches:
            done = []
            for name, n, size, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if parts and name != host:
                    done.append((host, count, chars, united(parts)))
                    count, chars, parts = 0, 0, []
                host, count, chars = name, count + n, chars + size
                parts.append(json.loads(found))
                if len(parts) == 64:  # so many are held at most
                    parts = [united(parts)]
            yield _written(done)
        if parts:
            yield _written([(host, count, chars, united(parts))])

    schema = "host string, pages long, chars long, wrapper string"
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = pages.select("host", "html").mapInArrow(from_pages, schema).withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(salts)))
    salted = salted.repartition(n, "host", "salt").sortWithinPartitions("host", "salt", "wrapper").select("host", "pages", "chars", "wrapper")
    return salted.mapInArrow(from_wrappers, schema).repartition(n, "host").sortWithinPartitions("host", "wrapper").mapInArrow(from_wrappers, schema)


def _written(found: Iterable[tuple[str, int, int, list]]) -> pa.RecordBatch:
    found = list(found)
    columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())]
    return pa.RecordBatch.from_arrays([*columns, pa.array([json.dumps(f[3], ensure_ascii=False) for f in found], pa.string())], names=["host", "pages", "chars", "wrapper"])


#: A page of a host, by 128 bits of both.
KEY = "__key"


def counted(pages: DataFrame) -> DataFrame:
    """(key, n, told) of pages whose host's wrapper has lost nodes, given as (key, host, html, marks).

    Here the wrapper that is left only names places. What the host's pages tell of each place, those outside the wrapper included,
    is counted over all of them and joined to the pages, so no host needs to fit a task. `told` has place, weight, template and menu
    of all nodes of a page; `n` is the number of pages of one key.
    """
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def nodes_of(batch: pa.RecordBatch) -> Iterator[tuple[bytes, str, list[str], list[list]]]:
        seen: dict[str, list] = {}
        for key, host, page, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), batch.column(3), strict=True):
            if host not in seen:
                if len(seen) > 100:
                    seen.clear()
                seen[host] = json.loads(found.as_py())
            nodes, _ = folded(fields(page))
            yield key, host, places(seen[host], nodes), nodes

    def merged(rows: Iterable[tuple[str, str, list]]) -> pa.RecordBatch:
        rows = list(rows)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([json.dumps(r[2], ensure_ascii=False) for r in rows], pa.string())], names=["host", "place", "node"])

    def from_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            for _, host, at, nodes in nodes_of(batch):
                for place, node in zip(at, nodes, strict=True):
                    if (host, place) in found:
                        _merge(found[host, place], node)
                    else:
                        found[host, place] = node
            yield merged((host, place, node) for (host, place), node in found.items())

    def from_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None

        def told(rows: list[tuple[tuple[str, str], list]]) -> pa.RecordBatch:
            columns = list(zip(*((host, place, node[PAGES], *_told(node)) for (host, place), node in rows), strict=True)) or [[]] * 6
            kinds = (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.bool_(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["host", "place", "n", "weight", "constant", "menu"])

        for batch in batches:
            done = []
            for host, place, node in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                node = json.loads(node)
                if (host, place) == at:
                    _merge(held, node)
                    continue
                if at is not None:
                    done.append((at, held))
                at, held = (host, place), node
            yield told(done)
        if at is not None:
            yield told([(at, held)])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key, host, place) for key, host, at, _ in nodes_of(batch) for place in at]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.string(), pa.string()))], names=[KEY, "host", "place"])

    pages = pages.select(KEY, "host", "html", "marks")
    dealt = pages.mapInArrow(from_pages, "host string, place string, node string").repartition(n, "host", "place").sortWithinPartitions("host", "place")
    nodes = materialise(dealt.mapInArrow(from_nodes, "host string, place string, n long, weight double, constant boolean, menu boolean"))
    share = lambda constant: F.sum(F.when(F.col("constant") == constant, F.col("weight")).otherwise(0.0))
    copies = materialise(nodes.groupBy("host").agg((share(True) > COPIES * share(False)).alias("copies"), F.count(F.lit(1)).alias("n")))
    name = F.struct("host", "place").alias("name")
    ruled = spread_join(nodes.withColumnRenamed("n", "pages"), copies, "host", by=F.xxhash64("place"), size=F.octet_length("host") + 16)
    ruled = materialise(ruled.select(name, F.round("weight", 1).alias("weight"), F.expr("constant AND NOT copies").alias("template"), "menu", F.col("pages").alias("n")))
    wanted = pages.mapInArrow(asked, f"{KEY} binary, host string, place string").select(KEY, name)
    found = spread_join(wanted, ruled, "name", by=F.xxhash64(KEY)).select(KEY, F.struct(F.col("name.place").alias("place"), "weight", "template", "menu").alias("told"))
    return materialise(found.groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"), F.collect_set("told").alias("told")).select(KEY, F.expr("rows div size(told)").alias("n"), "told"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page's main text.

    Character references are decoded, white space inside a block becomes one space, blocks in page order are joined by a
    line feed. What a host's wrapper says of its nodes is joined to the host's pages: broadcast if that is at most
    `spread.BROADCAST_BYTES` in all, else by host, with hosts of many pages spread over salts. Hosts whose pages are so unlike
    that the wrapper has lost nodes are `counted`.

    A null html has no text. Pages with a null or broken url form one host of their own. Repeated rows each give a row;
    an empty table gives none. Other columns of `pages` are not read.
    """
    ship_package(pages.sparkSession)
    named = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [json.loads(w) for w in batch.column(3).to_pylist()]
            lost = [sum(n[CHARS] for n in w) < chars for w, chars in zip(found, batch.column(2).to_pylist(), strict=True)]
            marks = [json.dumps(judged(w), ensure_ascii=False) for w in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lost, pa.bool_()), pa.array(marks, pa.string())], names=["host", "n", "lost", "marks"])

    known = materialise(wrappers(named.select("host", "html")).mapInArrow(judge, "host string, n long, lost boolean, marks string"))
    joined = spread_join(named, known, "host", by=F.xxhash64("page_id", "url"), size=F.octet_length("marks") + F.octet_length("host") + 17)
    columns = ["page_id", "url", "html", "host", "marks"]
    kind = "array<struct<place: string, weight: double, template: boolean, menu: boolean>>"
    if known.filter("lost").isEmpty():
        asked = joined.select(*columns, F.lit(None).cast(kind).alias("told"))
    else:
        apart = joined.filter("lost").withColumn(KEY, F.unhex(F.md5(F.concat_ws(":", "host", F.coalesce("html", F.lit(""))))))
        told = spread_join(apart, counted(apart), KEY, by=F.xxhash64("page_id", "url"), how="left").select(*columns, F.col("told").cast(kind))
        asked = joined.filter("NOT lost").select(*columns, F.lit(None).cast(kind).alias("told")).unionAll(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            texts = []
            for page, host, found, told in zip(texts_of(batch.column(2)), batch.column(3).to_pylist(), batch.column(4), batch.column(5), strict=True):
                if host not in seen:
                    if len(seen) > 1000:
                        seen.clear()
                    seen[host] = json.loads(found.as_py())
                held = fields(page)
                ruled = {t["place"]: (t["weight"], t["template"], t["menu"]) for t in told.as_py()} if told.is_valid else None
                texts.append(main_text(held, seen[host], ruled) if held else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return asked.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
