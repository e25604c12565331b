"""Main text of HTML pages by composite text density.

A page is read into a flat element tree (preorder arrays). Menus, page
headers and footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by element, role and whole class or id tokens,
unless they enclose the page's main element, its article or most of its
unlinked text. For every other element the composite text density is its characters per tag,
adjusted by the share of linked characters and tags. The least density on the
path from the body to the densest element is the threshold; among the
elements that reach it, the one with the largest sum of its children's
densities is content, widened to an enclosing article or main element. So is
the one with the largest sum of every other branch that reaches the threshold:
in the other articles of a page whose content is an article, else in the whole
body; and so are, below the body, unlinked sections beside content (section
elements, or elements of the same tag and class without ids). Content of several branches without an article is their lowest common
ancestor; if that is the body, its part from the first of them (with headings
right before it) to the last one, without elements of mostly linked text.

Its text: character references decoded, white space runs made one space,
trimmed, blocks joined by one space in page order. Nothing else is dropped.

Defined results: NULL, empty or tag-free html (no body text) gives the empty
string; unclosed, stray and misnested tags are closed as browsers do for the
common cases; repeated rows give equal texts; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from customer360.llm.textnum import chunks

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag, whose end may not stand inside quotes.
_REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_SPECIAL = re.compile(r"""["'>]""")
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp svg math title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
#: Elements whose text is never main text.
LEFT_OUT = frozenset("head nav footer aside form menu dialog button select input object embed applet canvas audio video".split()) | RAW
#: Those of them that may enclose a page's main text.
WRAPS = frozenset("nav footer aside form menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tokens of class, id or role that mark what is left out.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion menu menus nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside footer masthead topbar toolbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond discussion widget widgets pagination pager copyright legal disclaimer skip search "
    "contentinfo complementary navigation dialog alertdialog".split())
#: Words that may stand beside them in a token ("site-footer").
BESIDE = frozenset(
    "site page global post posts entry article articles item items left right top bottom primary secondary box bar list block links link icons button buttons area unit slot "
    "panel form section container wrapper wrap inner outer group holder".split())
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Marks of an element: a wrapper by its name, by its token, reader comments, never main text.
BY_TAG, BY_TOKEN, READERS, NEVER = 1, 2, 3, 4
#: Start tags that close an open element of the listed kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"tbody", "thead", "tr", "td", "th"}, "thead": {"tbody", "thead", "tr", "td", "th"}, "body": {"head"}}
#: Elements that an implied end does not reach through.
SCOPE = frozenset("html body table ul ol dl article section main div td th aside nav header footer form blockquote".split())


def _attributes(attrs: str) -> dict[str, str]:
    """Attribute values by lower-case name; the first one of a name holds."""
    out: dict[str, str] = {}
    for name, *values in _ATTR.findall(attrs):
        out.setdefault(name.lower(), "".join(values))
    return out


def _token_mark(value: str, marks: frozenset[str]) -> int:
    """Does a token of ``value`` consist of marks (and words that go with them)?"""
    found = 0
    for token in value.split():
        words = {w.lower() for w in re.split(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])", token) if w and not w.isdigit()}
        if words & marks and words <= MARKS | BESIDE:
            found = max(found, READERS if words & COMMENTS else BY_TOKEN)
    return found


def _mark(tag: str, attrs: str, inside: bool) -> int:
    """Mark of an element, 0 for none. ``inside``: within an article or main element."""
    kind = 0
    if tag in LEFT_OUT or (tag == "header" and not inside):
        if tag not in WRAPS and tag != "header":
            return NEVER
        kind = BY_TOKEN if tag == "form" else BY_TAG  # a form may wrap a whole page
    if not attrs:
        return kind
    named = _attributes(attrs)
    if tag in ("html", "body", "article", "main"):
        return kind
    if "hidden" in named or named.get("aria-hidden", "").strip().lower() == "true" or _UNSEEN.search(named.get("style", "")):
        return NEVER
    for name in ("class", "id", "role"):
        if name == "id" and tag in HEADINGS:
            continue  # the heading's own words
        marks = COMMENTS if name == "id" and tag == "section" and inside else MARKS
        kind = max(kind, _token_mark(named.get(name, ""), marks))
    return kind


def _dropped(tag: list[str], parent: list[int], mark: list[int], own: list[int], body: int) -> list[bool]:
    """Is the element, or one around it, left out? A marked wrapper stays if it
    encloses a main element or an article with more unlinked text than all that is
    unmarked. If no unmarked article or main element has text, one marked by its
    token also stays if it encloses most of the body's unlinked text. Reader
    comments do not count."""
    n = len(tag)
    out, linked, readers = [False] * n, [False] * n, [False] * n
    free = own[:]  # unlinked characters
    for v in range(1, n):
        up = parent[v]
        out[v] = out[up] or mark[v] > 0
        linked[v] = linked[up] or tag[v] == "a"
        readers[v] = readers[up] or mark[v] >= READERS
        if linked[v] or readers[v]:
            free[v] = 0
    if True not in out:
        return out
    clear = sum(c for c, d in zip(free, out, strict=True) if not d)
    main, article = [False] * n, [0] * n
    for v in range(n - 1, 0, -1):
        up = parent[v]
        free[up] += free[v]
        main[up] |= main[v] or (tag[v] == "main" and mark[v] == 0)
        article[up] = max(article[up], article[v], free[v] if tag[v] == "article" else 0)
    found = any(free[v] and not out[v] for v in range(1, n) if tag[v] in ("article", "main"))
    whole = free[body] or free[0]
    for v in range(1, n):
        kind = mark[v]
        stays = kind == 0 or (kind < NEVER and main[v])
        if not found:
            stays |= (kind in (BY_TAG, BY_TOKEN) and article[v] > clear) or (kind == BY_TOKEN and 2 * free[v] > whole)
        elif kind == BY_TOKEN:
            stays |= article[v] > clear
        out[v] = out[parent[v]] or not stays
    return out


def _leaf_density(c: int, bias: float) -> float:
    """Density of ``c`` unlinked characters without tags."""
    return c * math.log(c) / math.log(math.log(1 + bias * c + math.e)) if c else 0.0


def _section(tag: str, attrs: str) -> tuple[str, str] | None:
    """What the sections of one text have in common."""
    if tag == "section":
        return tag, ""
    named = _attributes(attrs)
    return None if "id" in named else (tag, " ".join(sorted(named.get("class", "").split())))


def _content(best, limit, body, tag, attrs, parent, last, own, chars, links, density, total, block, dropped) -> list[tuple[int, int]]:
    """Preorder ranges of the content; ``best`` has the largest sum of all."""
    n = len(tag)
    outer = [0] * n  # outermost article or main element around each one, below the body
    for v in range(body + 1, last[body]):
        outer[v] = outer[parent[v]] or (v if tag[v] in ("article", "main") else 0)

    def widened(v: int) -> int:
        return outer[v] or v

    def inner(v: int) -> list[int]:
        out, c = [], v + 1
        while c < last[v]:
            if chars[c] and not dropped[c]:
                out.append(c)
            c = last[c]
        return out

    top = widened(best)
    if best == body or tag[top] == "main":
        return [(top, last[top])]
    # Within each element, the block of the largest sum that reaches the limit.
    reach = [0] * n

    def larger(x: int, y: int) -> int:
        return x if x and (not y or (total[x], chars[x], -x) > (total[y], chars[y], -y)) else y

    for v in range(last[body] - 1, body, -1):
        if chars[v] and not dropped[v] and block[v] and density[v] >= limit:
            reach[v] = larger(v, reach[v])
        reach[parent[v]] = larger(reach[v], reach[parent[v]])
    # The element of the largest sum in every branch, outside of those found before.
    picks, todo = [], [body]
    bias = links[body] / chars[body]
    while todo:
        v = todo.pop()
        if v == body:
            pick = best
        else:
            pick = larger(v if chars[v] and not dropped[v] and density[v] >= limit else 0, reach[v])
            if not pick:
                continue
        picks.append(pick)
        # What is left of the branch: the branches beside the way down to the pick.
        up, child = parent[pick], pick
        while child != v:
            if _leaf_density(own[up], bias) >= limit:  # loose text
                picks.append(up)
            todo += [c for c in inner(up) if c != child]
            up, child = parent[up], up
    wide = sorted({widened(x) for x in picks})
    if tag[top] == "article":
        wide = [x for x in wide if tag[x] in ("article", "main")]
        return [(x, last[x]) for x in wide]
    alone = list(range(n))  # highest ancestor that holds no other text
    for v in range(body + 1, last[body]):
        if parent[v] > body and chars[parent[v]] == chars[v]:
            alone[v] = alone[parent[v]]
    kinds: dict[int, dict] = {}
    for v in wide[:]:
        v = alone[v]
        up = parent[v]
        if up > body and (kind := _section(tag[v], attrs[v])):
            if up not in kinds:
                kinds[up] = {}
                for c in inner(up):
                    if 2 * links[c] <= chars[c] and (k := _section(tag[c], attrs[c])):
                        kinds[up].setdefault(k, []).append(c)
            wide += kinds[up].pop(kind, [])
    wide = sorted(set(wide))
    low = wide[0]
    while last[low] <= wide[-1]:
        low = parent[low]
    if low != body or low in wide:
        return [(low, last[low])]
    parts = inner(low)
    holds = [bisect_left(wide, c) < bisect_left(wide, last[c]) for c in parts]
    first, end = holds.index(True), len(parts) - holds[::-1].index(True)
    while first and _headings_only(parts[first - 1], tag, last, own, dropped):
        first -= 1
    return [(c, last[c]) for c, h in zip(parts[first:end], holds[first:end], strict=True) if h or 2 * links[c] <= chars[c]]


def _headings_only(v: int, tag: list[str], last: list[int], own: list[int], dropped: list[bool]) -> bool:
    """Is all text of the element inside headings?"""
    x = v
    while x < last[v]:
        if tag[x] in HEADINGS or dropped[x]:
            x = last[x]
        elif own[x]:
            return False
        else:
            x += 1
    return True


class _Ends:
    """Where tags end: at the first ``>`` outside quotes, or where quotes do not
    close, at the first ``>``.

    The pattern finds an ordinary end. Where it fails once, it has read to the end of
    the page, and might again at every later tag; so the ends outside quotes are
    then worked out for all quotes and brackets of the page, from the last to the first."""

    def __init__(self, page: str):
        self.page, self.places = page, None
        self.last = page.rfind(">")

    def find(self, at: int) -> int:
        """The end of a tag whose name ends at ``at``; -1 if there is none."""
        if at > self.last:
            return -1
        if self.places is None:
            m = _REST.match(self.page, at)
            if m:
                return m.end() - 1
            self._prepare(at)
        i = bisect_left(self.places, at)
        end = self.ends[i]
        return end if end >= 0 else self.page.find(">", at)

    def _prepare(self, at: int) -> None:
        found = [(m.start(), m.group()) for m in _SPECIAL.finditer(self.page, at)]
        self.places = [p for p, _ in found]
        self.ends = [-1] * (len(found) + 1)
        after = {}  # the place in the list after the next quote of either kind
        for i in range(len(found) - 1, -1, -1):
            p, c = found[i]
            if c == ">":
                self.ends[i] = p
            else:
                if c in after:
                    self.ends[i] = self.ends[after[c]]
                after[c] = i + 1


class _Stack:
    """Open elements, with the places of every name and of the scope elements."""

    def __init__(self):
        self.nodes, self.names, self.where, self.scopes = [0], ["#root"], {}, []

    def push(self, node: int, name: str) -> None:
        self.where.setdefault(name, []).append(len(self.nodes))
        if name in SCOPE:
            self.scopes.append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def cut(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        for name in self.names[at:]:
            self.where[name].pop()
        while self.scopes and self.scopes[-1] >= at:
            self.scopes.pop()
        del self.nodes[at:], self.names[at:]

    def place(self, name: str) -> int:
        """The innermost open element of that name, 0 for none."""
        at = self.where.get(name)
        return at[-1] if at else 0

    def barrier(self, but=frozenset()) -> int:
        """The innermost scope element whose name is not in ``but``."""
        for at in reversed(self.scopes):
            if self.names[at] not in but:
                return at
        return 0


def main_text(page: str | None) -> str:
    """The main text of one page; see the module text. Its time grows with the
    page's length, whatever is left unclosed."""
    if not page:
        return ""
    tag, parent, mark, own, block, pieces = ["#root"], [-1], [0], [0], [True], []
    never, written = [False], [""]
    article = [False]
    stack, ends = _Stack(), _Ends(page)
    body, at, gap = 0, 0, True
    size, comments = len(page), page.rfind("<!--")

    def text(s: str) -> None:
        nonlocal gap
        node = stack.nodes[-1]
        if never[node] or not s:
            return
        s = _html.unescape(s) if "&" in s else s
        own[node] += len("".join(s.split()))
        pieces.append((node, gap, s))
        gap = False

    shown = 0  # where the text that is not yet taken begins
    while at < size:
        start = page.find("<", at)
        if start < 0 or start > max(ends.last, comments):
            break  # no tag can end any more
        name, closing, attrs = "", "", ""
        m = _NAME.match(page, start + 1)
        if m:
            stop = ends.find(m.end())
            if stop < 0:
                at = start + 1
                continue
            closing, name, attrs = m.group(1), m.group(2).lower(), page[m.end() : stop]
        elif page.startswith("<!--", start):
            stop = page.find("-->", start + 4)
            stop = size if stop < 0 else stop + 2
        elif page[start + 1 : start + 2] in ("!", "?"):
            stop = page.find(">", start) if start < ends.last else -1
            if stop < 0:
                at = start + 1
                continue
        else:
            at = start + 1
            continue
        text(page[shown:start])
        shown = at = stop + 1
        if not name:
            continue
        if closing:
            gap = gap or name not in INLINE
            place = stack.place(name)
            # A stray inline end closes no block.
            if place and not (name in INLINE and stack.barrier() > place):
                stack.cut(place)
            continue
        if name not in INLINE:
            gap = True
            if (name not in VOID or name == "hr") and stack.place("p") > stack.barrier():
                stack.cut(stack.place("p"))
        if name in CLOSES:
            while True:
                place = max(map(stack.place, CLOSES[name]))
                if place <= stack.barrier(CLOSES[name]):
                    break
                stack.cut(place)
                if name not in ("tr", "tbody", "thead"):
                    break
        up = stack.nodes[-1]
        node = len(tag)
        tag.append(name)
        parent.append(up)
        inside = article[up] or name in ("article", "main")
        article.append(inside)
        written.append(attrs)
        mark.append(_mark(name, attrs, article[up]))
        never.append(never[up] or mark[node] == NEVER)
        own.append(0)
        block.append(name not in INLINE)
        if name == "body" and not body:
            body = node
        if name in RAW and not attrs.rstrip().endswith("/"):
            end = re.compile(rf"</{name}\b", re.I).search(page, at)
            end = page.find(">", end.end()) if end and end.end() <= ends.last else -1
            shown = at = size if end < 0 else end + 1
        elif name not in VOID:
            stack.push(node, name)
    text(page[shown:])

    n = len(tag)
    dropped = _dropped(tag, parent, mark, own, body)
    own = [0 if d else c for c, d in zip(own, dropped, strict=True)]
    chars, links, tags, link_tags = own[:], [0] * n, [0] * n, [0] * n
    last = list(range(1, n + 1))  # one past the subtree of each element
    for v in range(n - 1, 0, -1):
        up = parent[v]
        last[up] = max(last[up], last[v])
        if dropped[v]:
            continue
        if tag[v] == "a":
            links[v], link_tags[v] = chars[v], tags[v] + 1
        chars[up] += chars[v]
        links[up] += links[v]
        tags[up] += tags[v] + 1
        link_tags[up] += link_tags[v]
    if not chars[body]:
        body = 0
    if not chars[body]:
        return ""
    bias = links[body] / chars[body]
    density = [0.0] * n
    for v in range(n):
        c = chars[v]
        if c and not dropped[v]:
            t, lc, lt = tags[v] or 1, links[v] or 1, link_tags[v] or 1
            base = math.log(c / max(1, c - links[v]) * lc + bias * c + math.e)
            density[v] = c / t * max(0.0, math.log(c / lc * t / lt)) / math.log(base)
    total = [0.0] * n
    for v in range(n - 1, 0, -1):
        if not dropped[v] and block[v]:
            total[parent[v]] += density[v]
    within = [v for v in range(body, last[body]) if chars[v] and not dropped[v]]
    v = max(within, key=lambda x: (density[x], -x))
    limit = density[v]
    while v != body and v > 0:
        v = parent[v]
        limit = min(limit, density[v])
    best = max((x for x in within if density[x] >= limit and (block[x] or x == body)), key=lambda x: (total[x], chars[x], -x), default=body)
    if total[best] == 0:  # no element holds blocks of text: take the body
        best = body
    spans = _content(best, limit, body, tag, written, parent, last, own, chars, links, density, total, block, dropped)
    starts = [a for a, _ in spans]
    out, ended = [], False
    for node, cut, s in pieces:
        at = bisect_right(starts, node) - 1
        here = not dropped[node] and at >= 0 and node < spans[at][1]
        if here:
            out.append(" " + s if cut or ended else s)
        ended = not here and (ended or bool(s.strip()))
    return " ".join("".join(out).split())


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = pages.schema
    schema = f"page_id {kinds['page_id'].dataType.simpleString()}, url {kinds['url'].dataType.simpleString()}, text string, n_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "html"):
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, schema)
