"""Main text of web pages by deducing the template that pages of one host share.

Tokens of a page are its elements, told apart by their path and their number among like siblings, and the texts of its
blocks, told apart by the element that holds them. The occurrence vector of a token is the set of the host's pages that
have it; tokens with equal vectors form an equivalence class. A vector is never written out: each token gets the number of
its pages and two sums of page hashes, which Spark adds up with partial sums, so a host of any size is one row a token and task.

A class belongs to the template if its vector has enough pages, if it holds a text together with that text's element, and
if its pages differ in their longest block (else they are copies of one page, not filled from one template). On a page, a
class counts only if its tokens stand in the template's order; classes are nested one into the other by falling support,
and one that lies in several gaps of those around it is split by gap. The texts of nested classes are the template's own
words; what stands between is what the slots were filled with. Of the slots, those of menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are left out by the meaning of their elements (names, roles, class and id
words) and, outside an article, those that are mostly links on all pages of the host. The rest is the main text.
"""

from __future__ import annotations

import html as html_module
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountlens.llm.common import free_name, ship_package, table
from accountlens.session import materialize

#: Pages that a template class must have.
LEAST_PAGES = 3
#: Bytes of all templates up to which they are broadcast (they are counted first); beyond, pages meet them by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Pieces that a host is dealt to in that shuffle.
SALTS = 64

# fixed values: names of HTML elements
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol "
                   "optgroup option p pre search section summary table tbody td template tfoot th thead tr ul").split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An element that a start tag ends, and the elements beyond which it is not looked for.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select", "datalist"})}
#: Elements that never hold main text.
ASIDE = frozenset(("aside audio button canvas datalist dialog footer form frameset head iframe input map menu nav noembed "
                   "noframes noscript object option script search select style svg template textarea title video").split())
ASIDE_ROLES = frozenset(("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
                         "status toolbar").split())
#: Words of class and id names that mark such parts, whole words and starts of words.
ASIDE_WORDS = frozenset(("ad ads advert adverts aside banner breadcrumb breadcrumbs commentary consent disclaimer footer gdpr "
                         "login masthead menu modal nav navigation notice notices notification notifications overlay pager pagination popup "
                         "promo promos promotion related replies reply respond share sharing sidebar signin signup social sponsor "
                         "sponsored subscribe subscription teaser toolbar topbar widget widgets").split())
ASIDE_STARTS = ("advert", "breadcrumb", "comment", "cookie", "disqus", "navbar", "newsletter", "recommend", "sidebar")
HEADER_WORDS = frozenset({"header", "head"})
ARTICLE_WORDS = frozenset("article entry post story content headline title".split())
#: Words before a mark that turn it round, as in has-sidebar.
NEGATIONS = frozenset("has with without no hide hidden free".split())
#: Class and id names of the main part on pages without an article or main element.
CONTENT_NAMES = frozenset(("article article-body article-content article-text content content-body entry entry-content main "
                           "main-content page-content post post-body post-content post-text story story-body").split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_COMMENT_END = re.compile(r"--!?>")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|style|hidden|aria-hidden)(?=[\s=/>]|\Z)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

ARTICLE, MAIN, CONTENT = 4, 2, 1


class Block(NamedTuple):
    """A run of text between block boundaries."""

    text: str
    token: int    # of the text under its element
    element: int  # token of the element
    slot: int     # the element's path without numbers
    region: int   # ARTICLE, MAIN and CONTENT bits of the elements around it
    heading: bool
    links: int    # characters in links
    place: int


class _Open:
    """An open element. Only elements that hold a text need their tokens, so these are made on demand."""

    __slots__ = ("name", "above", "label", "number", "aside", "region", "like", "held", "own", "path")

    def __init__(self, name: str, above: _Open | None, label: str, number: int, aside: bool, region: int):
        self.name, self.above, self.label, self.number, self.aside, self.region = name, above, label, number, aside, region
        self.like: dict[str, int] = {}  # elements in it by label
        self.held = 0                   # texts in it
        self.own = self.path = None

    def child(self, name: str, label: str, aside: bool, region: int) -> _Open:
        self.like[label] = number = self.like.get(label, 0) + 1
        return _Open(name, self, label, number, aside, region)

    def _line(self, known: str) -> list[_Open]:
        """This element and those above it up to one whose ``known`` is made, outermost first."""
        line = [self]
        while line[-1].above is not None and getattr(line[-1].above, known) is None:
            line.append(line[-1].above)
        return line[::-1]

    def token(self) -> int:
        if self.own is None:
            for e in self._line("own"):
                e.own = _hash(f"{e.above.own if e.above else 0} {e.label} {e.number}")
        return self.own

    def slot(self) -> int:
        if self.path is None:
            for e in self._line("path"):
                e.path = _hash(f"{e.above.path if e.above else 0} {e.label}")
        return self.path


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(name)]


@lru_cache(maxsize=4096)
def _meaning(name: str, attributes: str) -> tuple[str, bool, bool, int]:
    """Of an element: its name with its class words, whether it never holds main text, whether it is a page's or
    article's header, and what region it opens."""
    found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
    names = [*html_module.unescape(found.get("class", "")).split(), *html_module.unescape(found.get("id", "")).split()]
    role = found.get("role", "").lower()
    aside = (name in ASIDE or role in ASIDE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
             or bool(_INVISIBLE.search(found.get("style", ""))))
    header = name == "header" or role == "banner"
    region = ARTICLE if name == "article" or role == "article" or found.get("itemprop", "") == "articleBody" else 0
    region |= MAIN if name == "main" or role == "main" else 0
    if name not in ("html", "body", "main"):
        for each in names:
            words = _words(each)
            if NEGATIONS.intersection(words):
                continue
            aside = aside or any(w in ASIDE_WORDS or w.startswith(ASIDE_STARTS) for w in words)
            header = header or bool(HEADER_WORDS.intersection(words) and not ARTICLE_WORDS.intersection(words))
            region |= CONTENT if _DIGITS.sub("", each.lower()).strip("-_") in CONTENT_NAMES else 0
    label = f"{name}.{'.'.join(sorted({_DIGITS.sub('', c) for c in names}))}" if names else name
    return label, aside, header, region


def blocks(page: str) -> list[Block]:
    """The blocks of a page outside the parts that never hold main text, in order, white space made single. One
    pass, with the rules of HTML for omitted end tags, void and raw elements, unclosed comments and stray ``<``."""
    out: list[Block] = []
    root = _Open("", None, "page", 1, False, 0)
    stack, opened = [root], Counter()
    held: list[str] = []
    linked = 0
    owner = root
    tag = _TAG

    def flush() -> None:
        nonlocal linked
        if not held:
            return
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            owner.held += 1
            out.append(Block(text, _hash(f"{owner.token()} {owner.held} {text}"), owner.token(), owner.slot(), owner.region,
                             owner.name in HEADINGS, linked, len(out)))
        linked = 0

    def close(depth: int) -> None:
        nonlocal owner
        while len(stack) > depth:
            gone = stack.pop()
            opened[gone.name] -= 1
            if gone.name in BLOCK:
                flush()
                owner = next((o for o in reversed(stack) if o.name in BLOCK), root)

    def find(names: set[str], barriers: set[str]) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                return depth
            if stack[depth].name in barriers:
                break
        return 0

    def text_run(text: str) -> None:
        nonlocal linked
        if not stack[-1].aside:
            text = html_module.unescape(text) if "&" in text else text
            held.append(text)
            if opened["a"]:
                linked += len(text.strip())

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            text_run(page[at:])
            break
        if mark > at:
            text_run(page[at:mark])
        following = page[mark + 1:mark + 4]
        if following == "!--":
            end = None if page.startswith((">", "->"), mark + 4) else _COMMENT_END.search(page, mark + 4)
            at = page.index(">", mark) + 1 if page.startswith((">", "->"), mark + 4) else end.end() if end else size
            continue
        if following[:1] in ("!", "?"):
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
            continue
        match = tag.match(page, mark)
        if match is None and following.removeprefix("/")[:1].isalpha():
            tag = _PLAIN_TAG  # an unclosed quote: from here on quotes do not matter, so none is looked for twice
            match = tag.match(page, mark)
            if match is None:  # no tag ends any more
                text_run(page[mark:])
                break
        if match is None:
            text_run("<")
            at = mark + 1
            continue
        at = match.end()
        name, attributes = match[2].lower(), match[3]
        if match[1]:
            if name == "br":
                text_run(" ")
            elif opened[name] > 0:
                depth = len(stack) - 1
                while stack[depth].name != name and (name in BLOCK or stack[depth].name not in BLOCK):
                    depth -= 1
                if stack[depth].name == name:
                    close(depth)
            continue
        if name in BLOCK:
            if opened["p"]:
                depth = find({"p"}, {"button", "td", "th", "caption", "object", "table"})
                if depth:
                    close(depth)
            if name in HEADINGS and stack[-1].name in HEADINGS:
                close(len(stack) - 1)
        elif name == "a" and opened["a"]:
            depth = find({"a"}, BLOCK)
            if depth:
                close(depth)
        if name in ENDS:
            depth = find(*ENDS[name])
            if depth:
                close(depth)
        if name == "br":
            text_run(" ")
        if name in BLOCK:
            flush()
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = end.start() if end else size
            if end:
                close_at = page.find(">", at)
                at = close_at + 1 if close_at >= 0 else size
            continue
        if attributes.endswith("/") and name not in BLOCK and name in ("path", "use", "circle", "rect", "line", "g", "svg"):
            continue
        above = stack[-1]
        if above.aside:
            element = _Open(name, above, name, 0, True, 0)
        else:
            label, aside, header, region = _meaning(name, attributes)
            element = above.child(name, label, aside or header and not above.region & (ARTICLE | MAIN), above.region | region)
        stack.append(element)
        opened[name] += 1
        if name in BLOCK:
            owner = element
    close(1)
    flush()
    return out


def page_tokens(page: str) -> list[tuple[int, int, int, int, int, int]]:
    """(token, element or 0 or 1, place, signature, characters, link characters) of a page's elements with a text (0), their texts, and
    their slots (1). The signature is that of the longest block, for a slot that of its text."""
    found = blocks(page)
    if not found:
        return []
    longest = _hash(max((b.text for b in found), key=lambda t: (len(t), t)))
    out, seen = [], set()
    for b in found:
        if b.element not in seen:
            seen.add(b.element)
            out.append((b.element, 0, 2 * b.place, longest, 0, 0))
        out.append((b.token, b.element, 2 * b.place + 1, longest, 0, 0))
        out.append((b.slot, 1, 0, _hash(b.text), len(b.text), b.links))
    return out


class Template(NamedTuple):
    """Of a host: (class, order, own element or 0) of each template token, classes by falling support; slots that are mostly links;
    slots that have one text on all pages."""

    tokens: dict[int, tuple[int, int, int]]
    links: frozenset[int]
    constant: frozenset[int]


NO_TEMPLATE = Template({}, frozenset(), frozenset())


@lru_cache(maxsize=256)
def read_template(text: str) -> Template:
    """A template from its text: classes split by ``;``, each ``token:element`` by ``,`` in order; then, split by ``|``, the slots."""
    classes, links, constant = text.split("|")
    tokens = {}
    for number, members in enumerate(filter(None, classes.split(";"))):
        for order, member in enumerate(members.split(",")):
            token, element = member.split(":")
            tokens[int(token)] = (number, order, int(element))
    return Template(tokens, *(frozenset(map(int, filter(None, x.split(",")))) for x in (links, constant)))


def template_texts(found: list[Block], template: Template) -> set[int]:
    """Tokens of the blocks that are words of the template: those of its classes that are in order and nest."""
    met: dict[int, list[tuple[int, int, int, int]]] = {}
    seen = set()
    for b in found:
        for token, place in ((b.element, 2 * b.place), (b.token, 2 * b.place + 1)):
            if token in template.tokens and token not in seen:
                seen.add(token)
                number, order, element = template.tokens[token]
                met.setdefault(number, []).append((place, order, token, element))
    taken: list[int] = []
    words: set[int] = set()
    for number in sorted(met):
        members = met[number]
        if any(a[1] >= b[1] for a, b in zip(members, members[1:])):
            continue  # not in the template's order here
        gaps: dict[int, list[tuple[int, int, int, int]]] = {}
        for member in members:
            gaps.setdefault(bisect_left(taken, member[0]), []).append(member)
        for part in gaps.values():
            elements = {token for _, _, token, element in part if not element}
            own = {token for _, _, token, element in part if element in elements}
            if own:
                words |= own
                for member in part:
                    insort(taken, member[0])
    return words


def main_text(page: str | None, template: Template = NO_TEMPLATE) -> str:
    """The blocks of the page's slots that are main text, joined by line breaks."""
    found = blocks(page) if page else []
    words = template_texts(found, template) if template.tokens else ()
    # in an article, like elements may hold like texts by chance; there a text is the template's only if its slot never varies
    left = [b for b in found if not (b.token in words and (not b.region & (ARTICLE | MAIN) or b.slot in template.constant))]
    for region in (ARTICLE, MAIN):
        if any(b.region & region for b in left):
            return "\n".join(b.text for b in left if b.region & region or b.heading and b.region & MAIN)
    left = [b for b in left if not (b.slot in template.links and 2 * b.links > len(b.text))]
    inside = [b for b in left if b.region & CONTENT]
    if 2 * sum(len(b.text) for b in inside) >= sum(len(b.text) for b in left):
        left = [b for b in left if b.region & CONTENT or b.heading]
    return "\n".join(b.text for b in left)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


TOKEN_SCHEMA = "host string, page long, token long, element long, place long, signature long, chars long, links long"


def host_templates(pages: DataFrame, host_col: str, html_col: str, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Columns host and template (text, see ``read_template``) of every host that has one."""
    ship_package(pages.sparkSession)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in TOKEN_SCHEMA.split(", ")]
        types = [pa.string(), *[pa.int64()] * 7]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                for host, page in zip(*(batch.column(c).slice(start, 256).to_pylist() for c in range(2))):
                    own = _hash(page)
                    rows += [(host, own, *t) for t in page_tokens(page)]
                columns = list(zip(*rows)) if rows else [()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    used = pages.select(F.col(host_col).alias("host"), F.col(html_col).alias("page")).where("host is not null and page is not null")
    # two sums of 31 bits each stand for the set of pages; a page that is repeated counts as often in every token
    counted = materialize(
        used.mapInArrow(tokens, TOKEN_SCHEMA).groupBy("host", "token", "element").agg(
            F.count(F.lit(1)).alias("pages"), F.sum(F.col("page").bitwiseAND(0x7FFFFFFF)).alias("low"),
            F.sum(F.shiftrightunsigned("page", 33)).alias("high"), F.sum("place").alias("places"),
            F.min("signature").alias("least"), F.max("signature").alias("most"),
            F.sum("chars").alias("chars"), F.sum("links").alias("links"))
        .where(f"pages >= {least_pages} or element = 1 and 2 * links > chars"))
    member = F.struct((F.col("places") / F.col("pages")).alias("place"), "token", "element", (F.col("least") != F.col("most")).alias("varied"))
    # a class has no more tokens than any one of its pages
    classes = (counted.where("element <> 1").groupBy("host", "pages", "low", "high")
               .agg(F.array_sort(F.collect_list(member)).alias("members"))
               .withColumn("elements", F.expr("transform(filter(members, m -> m.element = 0), m -> m.token)"))
               .where("exists(members, m -> m.varied and m.element <> 0 and array_contains(elements, m.element))"))
    written = classes.select("host", "pages", F.array_join(
        F.transform("members", lambda m: F.concat_ws(":", m["token"], m["element"])), ",").alias("class"))
    by_host = written.groupBy("host").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("pages", "class")), asc=False), lambda c: c["class"]), ";").alias("classes"))
    slots = counted.where("element = 1").groupBy("host").agg(
        F.array_join(F.array_sort(F.collect_list(F.when(F.expr("2 * links > chars"), F.col("token")))), ",").alias("linked"),
        F.array_join(F.array_sort(F.collect_list(F.when(
            (F.col("least") == F.col("most")) & (F.col("pages") >= least_pages), F.col("token")))), ",").alias("constant"))
    empty = F.lit("")
    return by_host.join(slots, "host", "full_outer").select("host", F.concat_ws(
        "|", F.coalesce("classes", empty), F.coalesce("linked", empty), F.coalesce("constant", empty)).alias("template")).where(
        "template <> '||'")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", text_col: str = "text",
            count_col: str = "n_chars", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Append the main text of every page and its number of code points; input columns with these names are replaced.

    A null or empty page has the empty text. A page whose address is null or has no host is read without a template, as
    are all pages of a host with fewer than ``LEAST_PAGES``. Repeated pages get equal texts; they alone make no template. A page
    of any length is read whole. An empty table gives an empty result.
    """
    ship_package(pages.sparkSession)
    host, key, template, salt = (free_name(pages, n) for n in ("__host", "__key", "__template", "__salt"))
    hosted = pages.withColumn(host, host_of(F.col(url_col)))
    found = materialize(host_templates(hosted, host, html_col).toDF(key, template))
    size = found.agg(F.sum(F.length(template) + F.length(key) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        joined = hosted.join(F.broadcast(found), F.col(host) == F.col(key), "left")
    else:
        many = found.withColumn(salt + "t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = hosted.withColumn(salt, F.pmod(F.xxhash64(html_col), F.lit(SALTS)).cast("int"))
        joined = dealt.join(many, (F.col(host) == F.col(key)) & (F.col(salt) == F.col(salt + "t")), "left")

    @F.pandas_udf("string")
    def text_of(page: pd.Series, written: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, read_template(t) if t else NO_TEMPLATE) for p, t in zip(page, written)], dtype=object)

    kept = [c for c in pages.columns if c not in (text_col, count_col)]
    text = joined.select(*[F.col(c) for c in kept], text_of(F.col(html_col), F.col(template)).alias(text_col))
    return text.withColumn(count_col, F.length(text_col).cast("long"))


def extracted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op12: the main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
