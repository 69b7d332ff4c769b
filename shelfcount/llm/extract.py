"""Main text of web pages, by templates deduced from pages of one host.

Tokens are the opening tags of a page, told apart by the path of elements above them. Tokens of a host with the
same occurrence vector (how often each page has them) form an equivalence class. The vector of a token is kept
as a sum of hashes over pages, so that a host of any size needs partial sums only. A class is valid if enough
pages of the host support it and the elements above its tokens belong to valid classes; valid classes, each
inside the slots of the one above, are the template. Of its slots that with the article is kept. Where pages
mark none, the slot that holds most of the text is taken, and on each page the smallest element around it and
all paragraphs, headings, lists, quotes, tables and preformatted blocks is kept. Menus, headers, footers,
sidebars, notices, adverts, forms and comments are left out by element or by class name. What a class name, or a
form around it, would leave out is kept all the same where it is the article: a page's largest mark, or form, with more
text than all that else is kept (labels and options are none).

Texts of pages without an article mark are tokens too, told apart by their path. One that is on enough of the
pages with its element, whatever share of the host these are, so that each layout is judged by itself, does not
vary; an element in which no text varies is template and left out, unless the page has no other text. Pages without a template (the only one of their
host, or unlike the others) are read by their own marks.

Templates are bounded by what pages of the host have in common. They are broadcast only below a checked size,
and joined by host otherwise. A null html is empty and gives no text; a null url has the empty host. Repeated
rows support each other like other pages.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcount.llm.textbytes import blocks, written
from shelfcount.llm.url_lists import host

#: Share of a host's pages that must support a class, and the least number of them.
SUPPORT, LEAST_PAGES = 0.5, 2
#: Share of the text that a slot must hold to be the main one, where pages mark no article.
MAIN_SHARE = 0.6
#: The least number of pages that share a text of the template: an article and its copy are none.
TEXT_PAGES = 3
#: Rows of the template table that are broadcast.
BROADCAST_ROWS = 100_000

# Fixed values of HTML: elements without content, elements that break text, elements whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup "
                   "option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BREAKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt", "option"}
ITSELF = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPES = frozenset("ul ol dl table select body article section div nav main aside header footer form".split())
# Elements that hold text of an article; what is around them is its container.
TEXTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())
# What is never part of an article, by element, and by words of class, id and role.
LEFT_OUT = frozenset("nav footer aside form button select textarea iframe object noscript template svg canvas "
                     "dialog head title".split())
LEFT_OUT_WORDS = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                           "consent cookie cookies disqus footer login masthead menu modal nav navbar navigation newsletter "
                           "notice notices pager pagination popup promo promoted recommended related replies reply respond "
                           "share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
# Of them, those of comments and of other articles: no article is kept in spite of these.
OTHERS = frozenset("ad ads advert adverts advertisement advertising comment comments disqus promo promoted recommended "
                   "related replies reply respond sponsor sponsored".split())
# Elements of a form whose text is no article.
CONTROLS = frozenset("button label legend optgroup option".split())
_QUALIFIED = frozenset("has with without no is not".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|template|noscript|iframe)\b[^>]*>(.*?)(?:</\1\s*>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?/][^>]*(?:>|\Z)|([^<]+)|<",
    re.DOTALL | re.IGNORECASE)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)

ROOT = 0
PLAIN, MARKED, OUT, HEADER = 0, 1, 2, 3  # kinds of an element; a header is left out unless it is the article's
TEXT = 4  # kind of a text token


class Element:
    """An open element: its name, path, kind, whether it is in the article, or left out, and what it stands in.

    ``soft``: if its kind leaves it out, it may be the article, or around it, all the same. ``article``: it says that
    it is one, or is a form. ``order``: its place among the opening tags of the page.
    """

    __slots__ = ("name", "path", "kind", "within", "out", "above", "depth", "around", "soft", "article", "order")

    def __init__(self, name: str, path: int, kind: int, within: bool, out: bool, above: Element | None = None,
                 soft: bool = True, article: bool = False, order: int = 0):
        self.name, self.path, self.kind, self.within, self.out = name, path, kind, within, out
        self.soft, self.article, self.order = soft, article, order
        self.above, self.depth = above, above.depth + 1 if above else 0
        #: container of the outermost text block that it is in
        self.around = None if above is None else above.around or (above if name in TEXTS else None)


def _kind(name: str, said: str) -> tuple[str, int, bool, bool]:
    """What tells the element apart from others of its name, its kind, whether that is soft, whether it has a mark."""
    words = defaultdict(list)
    if said and "=" in said:
        for key, *values in _NAMED.findall(said):
            words[key.lower()] += "".join(values).lower().split()
    key = " ".join([name, *words["class"], *words["role"]])
    if name in ("html", "body"):
        return key, PLAIN, True, False
    mark = name in ("article", "main") or "main" in words["role"] or "articlebody" in words["itemprop"]
    kind, other = MARKED if mark else PLAIN, False
    for word in words["class"] + words["id"] + words["role"]:
        parts = re.split(r"[-_]+", word)
        said_out = {word, parts[0], parts[-1]} & LEFT_OUT_WORDS
        if parts[0] not in _QUALIFIED and len(parts) <= 3 and said_out:
            kind, other = OUT, other or bool(said_out & OTHERS)
        elif word == "header" and name != "article" and kind != OUT:
            kind = HEADER
    if name == "header" and kind != OUT:
        kind = HEADER
    hard = name in LEFT_OUT and name != "form"
    if name in LEFT_OUT and kind != HEADER:
        kind = OUT
    return key, kind, not (other or hard), mark


_kinds: dict[tuple[str, str], tuple[str, int, bool, bool]] = {}
_paths: dict[tuple[int, str], int] = {}


def _bounded(store: dict) -> dict:
    if len(store) > 200_000:
        store.clear()
    return store


def walk(html: str, spared: frozenset[int] = frozenset()) -> Iterator[tuple[str, Element, str]]:
    """("open" | "close" | "text", innermost element, text) in page order; what is left open closes at the end.

    The ``spared`` elements, by their order, are not left out for their own sake.
    """
    order = 0
    stack = [Element("", ROOT, PLAIN, False, False)]
    open_now: dict[str, int] = defaultdict(int)

    def pop():
        top = stack.pop()
        open_now[top.name] -= 1
        return "close", top, ""

    for m in _TOKEN.finditer(html):
        text = m[6]
        if text is not None:
            yield "text", stack[-1], text
            continue
        name = m[4]
        if name is None:
            if m[0] == "<":
                yield "text", stack[-1], "<"
            continue
        name = name.lower()
        if m[3]:
            if open_now[name] > 0:
                while stack[-1].name != name:
                    yield pop()
                yield pop()
            continue
        if name in CLOSES_P and open_now["p"] > 0:
            while stack[-1].name != "p":
                yield pop()
            yield pop()
        elif name in ITSELF and any(open_now[own] > 0 for own in ITSELF[name]):
            near = next((i for i in range(len(stack) - 1, 0, -1)
                         if stack[i].name in ITSELF[name] or stack[i].name in SCOPES), 0)
            if near and stack[near].name in ITSELF[name]:
                while len(stack) > near:
                    yield pop()
        above = stack[-1]
        known = _kinds.get((name, m[5]))
        if known is None:
            known = _bounded(_kinds)[name, m[5]] = _kind(name, m[5])
        key, kind, soft, mark = known
        order += 1
        path = _paths.get((above.path, key))
        if path is None:
            path = _bounded(_paths)[above.path, key] = xxhash.xxh64_intdigest(key, above.path) >> 1
        if kind == HEADER:
            kind = (MARKED if mark else PLAIN) if above.within else OUT
        if order in spared:
            kind = MARKED if mark else PLAIN
        element = Element(name, path, kind, above.within or kind == MARKED, above.out or kind == OUT, above,
                          soft, mark or name == "form", order)
        yield "open", element, str(above.path)
        if name not in VOID and not m[5].endswith("/"):
            stack.append(element)
            open_now[name] += 1
    while len(stack) > 1:
        yield pop()


def _left_out(what: str, element: Element) -> bool:
    """Whether an element opens that may be the article, but is left out."""
    return what == "open" and element.out and element.article


def spared(html: str) -> frozenset[int]:
    """Elements that are, or are around, an article with more text than what is kept without them, by their order."""
    found: frozenset[int] = frozenset()
    while True:
        kept, held = 0, defaultdict(int)
        names: dict[int, Element] = {}
        for what, element, text in walk(html, found):
            if what != "text" or not text.strip() or element.name in CONTROLS:
                continue
            n = len(text.strip())
            if not element.out:
                kept += n
                continue
            above = element
            chain = []
            while above is not None and (above.kind != OUT or above.soft):
                chain.append(above)
                above = above.above
            if above is None:  # in nothing that is always left out
                for one in reversed(chain):
                    if one.article and one.out:
                        held[one.order] += n
                        names[one.order] = one
        best = max(held, key=held.get, default=None)
        if best is None or held[best] <= kept:
            return found
        one, more = names[best], set()
        while one is not None:
            if one.kind == OUT:
                more.add(one.order)
            one = one.above
        found |= more


class Texts:
    """Blocks of text that are not left out, and the element that each begins in."""

    def __init__(self):
        self.found: list[tuple[str, Element]] = []
        self.part: list[str] = []
        self.first: Element | None = None

    def flush(self) -> bool:
        """Whether the open part was a block."""
        block = " ".join(entities.unescape("".join(self.part)).split()) if self.first else ""
        if block:
            self.found.append((block, self.first))
        self.part.clear()
        self.first = None
        return bool(block)

    def take(self, what: str, element: Element, text: str) -> bool:
        """Whether a block has ended before this event."""
        if what == "text":
            if not element.out:
                if self.first is None and text.strip():
                    self.first = element
                self.part.append(text)
        elif element.name in BREAKS or element.out:
            return self.flush()
        elif element.name == "br" and what == "open":
            self.part.append(" ")
        return False


def text_token(block: str, element: Element) -> int:
    return xxhash.xxh64_intdigest(block, element.path ^ 1) >> 1


# --- occurrence vectors and templates ------------------------------------------------

def tokens_of(html: str) -> dict[int, list[int]]:
    """path -> [parent path, kind (the largest), how often, characters of text in it that are not left out].

    The texts of a page without an article mark are in it as well, under the paths of what they stand in.
    """
    found, marked, left = _tokens(html)
    again = spared(html) if left and not marked else None
    return _tokens(html, again)[0] if again else found


def _tokens(html: str, spare: frozenset[int] = frozenset()) -> tuple[dict[int, list[int]], bool, bool]:
    """The tokens, whether an article mark is kept, and whether one, or a form, is left out."""
    found: dict[int, list[int]] = {ROOT: [ROOT, PLAIN, 1, 0]}
    texts = Texts()
    marked = left = False
    for what, element, text in walk(html, spare):
        left = left or _left_out(what, element)
        marked = marked or (element.within and not element.out)
        if not marked:
            texts.take(what, element, text)
        if what == "open":
            own = found.get(element.path)
            if own is None:
                own = found[element.path] = [int(text), OUT if element.out else element.kind, 0, 0]
            own[2] += 1
        elif what == "text" and not element.out:
            found[element.path][3] += len(text.strip())
    texts.flush()
    for block, element in [] if marked else texts.found:
        found.setdefault(text_token(block, element), [element.path, TEXT, 0, 0])[2] += 1
    return found, marked, left


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "html"):
        rows = []
        for at, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            mark = xxhash.xxh64_intdigest(page)
            for path, (parent, kind, n, chars) in tokens_of(page).items():
                h = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), mark)
                rows.append((at, path, parent, kind, n, chars, h & 0x7FFFFFFF, (h >> 31) & 0x7FFFFFFF, mark >> 1))
        names = ["host", "path", "parent", "kind", "n", "chars", "one", "two", "mark"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)


def deduce(tokens: list[tuple], pages: int) -> tuple[list[int], list[int]]:
    """Paths of the template, and of its main slots.

    ``tokens`` has (path, parent, kind, pages, vector, characters) of the host's tokens with enough support.
    """
    classes = defaultdict(list)
    for token in tokens:
        classes[token[4]].append(token)
    known, waiting = {ROOT}, list(classes.values())
    while True:  # from the outside in: a class is nested in those that are known
        valid = [c for c in waiting if all(t[1] in known or t[1] in {u[0] for u in c} for t in c)]
        if not valid:
            break
        waiting = [c for c in waiting if c not in valid]
        known |= {t[0] for c in valid for t in c}
    template = {t[0]: t for t in tokens if t[0] in known}
    marked = [p for p, t in template.items() if t[2] == MARKED]
    if marked:
        return sorted(known), sorted(marked)
    total: dict[int, int] = defaultdict(int)  # characters in a slot and all slots inside it
    for path, token in template.items():
        if token[2] == OUT:
            continue
        at, seen = path, set()
        while at in template and at not in seen:
            seen.add(at)
            total[at] += token[5]
            at = template[at][1] if at != ROOT else None
    most = total.get(ROOT, 0)
    slots = [p for p, n in total.items() if most and n >= MAIN_SHARE * most]
    depth = {p: sum(1 for _ in _above(p, template)) for p in slots}
    return sorted(known), [max(slots, key=lambda p: (depth[p], -p))] if slots else []


def _above(path: int, template: dict) -> Iterator[int]:
    seen = set()
    while path in template and path != ROOT and path not in seen:
        seen.add(path)
        path = template[path][1]
        yield path


def _template_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for at, pages, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            paths, main = deduce([(t["path"], t["parent"], t["kind"], t["pages"], (t["one"], t["two"]), t["chars"])
                                  for t in tokens], pages)
            rows.append((at, paths, main))
        hosts, paths, main = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.list_(pa.int64())), pa.array(main, pa.list_(pa.int64()))],
            names=["host", "paths", "main"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, paths, main, shared) of every host with at least LEAST_PAGES pages."""
    texts = pages.select(F.coalesce(host(F.col("url")), F.lit("")).alias("host"),
                         F.coalesce("html", F.lit("")).alias("html"))
    seen = texts.mapInArrow(_token_rows, "host string, path long, parent long, kind long, n long, chars long, "
                                         "one long, two long, mark long")
    counts = (seen.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.max("parent").alias("parent"), F.max("kind").alias("kind"),
        F.sum("chars").alias("chars"), F.sum("one").alias("one"), F.sum("two").alias("two"),
        F.min("mark").alias("least"), F.max("mark").alias("most")))
    counts = written(counts.filter((F.col("path") == ROOT) | (F.col("kind") != TEXT) | (F.col("pages") >= TEXT_PAGES)),
                     "tokens")
    # a text that only copies of one page have is no template
    texts = counts.filter((F.col("kind") == TEXT) & (F.col("pages") >= TEXT_PAGES) & (F.col("least") < F.col("most")))
    stands = counts.filter(F.col("kind") != TEXT).select("host", F.col("path").alias("parent"), F.col("pages").alias("of"))
    shared = (texts.join(stands, ["host", "parent"]).filter(F.col("pages") >= SUPPORT * F.col("of"))
              .groupBy("host").agg(F.collect_list("path").alias("shared")))
    counts = counts.filter(F.col("kind") != TEXT)
    whole = counts.filter(F.col("path") == ROOT).select("host", F.col("pages").alias("of"))
    common = counts.join(whole, "host").filter((F.col("pages") >= LEAST_PAGES)
                                               & (F.col("pages") >= SUPPORT * F.col("of")))
    each = F.struct("path", "parent", "kind", "pages", "one", "two", "chars")
    return common.groupBy("host").agg(F.max("of").alias("of"), F.collect_list(each).alias("tokens")).mapInArrow(
        _template_rows, "host string, paths array<long>, main array<long>").join(shared, "host", "left")


# --- extraction ----------------------------------------------------------------------

def _common(a: Element, b: Element) -> Element:
    """The innermost element around both."""
    while a is not b:
        if a.depth >= b.depth:
            a = a.above
        else:
            b = b.above
    return a


def _inside(element: Element, around: Element) -> bool:
    while element.depth > around.depth:
        element = element.above
    return element is around


def _container(element: Element) -> Element:
    """Of the text block that a text begins in; of a text in none, the element that breaks text around it."""
    if element.around is not None:
        return element.around
    while element.above and element.name not in BREAKS:
        element = element.above
    return element


def _varying(found: list[tuple[str, Element]], shared: set[int]) -> tuple[list[bool], list[bool]]:
    """Which texts are not shared, and which stand in an element with such a text."""
    own = [not shared or text_token(block, element) not in shared for block, element in found]
    if all(own) or not any(own):
        return [True] * len(found), [True] * len(found)
    around = set()
    for (_, element), varies in zip(found, own):
        at = _container(element) if varies else None
        while at is not None and id(at) not in around:
            around.add(id(at))
            at = at.above
    return own, [id(_container(element)) in around for _, element in found]


def main_text(html: str, main: set[int], shared: set[int] = frozenset(), spare: frozenset[int] = frozenset()) -> str:
    """Blocks of the slots in ``main``; of the page's own article, or of all of it, where it has none of them.

    A slot that no mark tells is widened to the smallest element around it and all text blocks of the page. Where
    the page has no article of its own, elements with no text but the ``shared`` ones are left out. What is in
    ``spare`` is not left out (``spared``, where the page needs it and nothing is given).
    """
    texts = Texts()
    states: list[tuple[bool, bool]] = []  # of each text, whether it is in a slot, and in a mark
    deep = {"slot": 0, "mark": 0}
    state, left = (False, False), False
    for what, element, text in walk(html, spare):
        left = left or _left_out(what, element)
        if texts.take(what, element, text):
            states.append(state)
        if what == "text" or element.out or element.name in VOID:
            continue
        step = 1 if what == "open" else -1
        deep["slot"] += step * (element.path in main)
        deep["mark"] += step * (element.kind == MARKED)
        state = (deep["slot"] > 0, deep["mark"] > 0)
    if texts.flush():
        states.append(state)
    slots = [block for (block, _), (slot, _) in zip(texts.found, states) if slot]
    marked = [block for (block, _), (_, mark) in zip(texts.found, states) if mark]
    if marked:
        return "\n\n".join(slots or marked)
    again = spared(html) if left and not spare else None
    if again:
        return main_text(html, main, shared, again)
    own, kept = _varying(texts.found, shared)
    container = None
    if any(slot and varies for (slot, _), varies in zip(states, own)):
        for (_, element), (slot, _), varies in zip(texts.found, states, own):
            if varies and (slot or element.around is not None):
                around = _container(element)
                container = around if container is None else _common(container, around)
    return "\n\n".join(block for (block, element), keep in zip(texts.found, kept)
                       if keep and (container is None or _inside(element, container)))


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "html"):
        texts = [main_text(page, set(main or ()), set(shared or ())) for page, main, shared in
                 zip(*(batch.column(c).to_pylist() for c in ("html", "main", "shared")))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(np.array([len(t) for t in texts], np.int64))], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of pages."""
    table = written(templates(pages).select("host", "main", "shared"), "templates")
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    texts = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                         F.coalesce("html", F.lit("")).alias("html"),
                         F.coalesce(host(F.col("url")), F.lit("")).alias("host"))
    return (texts.join(table, "host", "left").select("page_id", "url", "html", "main", "shared")
            .mapInArrow(_text_rows, "page_id long, url string, text string, n_chars long"))
