"""Main text of web pages by equivalence-class template deduction.

Pages of one host come from a template.  Tokens are block tags, told apart by their path,
and the words of their text.  Tokens with the same occurrence vector (how often each page
of the host holds them) form an equivalence class; a vector is kept as an order-free hash
over (page, count), so classes are found by two aggregations that combine before the
shuffle, however many pages a host has.  A class is valid when enough pages hold it and it
has a tag; it nests in the template by its paths.  A word belongs to a class only where
each occurrence of its own tag holds it once, which is checked page by page first.

The slots between the template's tokens hold what varies.  Slots of menus, headers,
footers, sidebars, notices, adverts, forms and comments are told by their tags, roles and
names; a name tells only if all of its words are names of parts or of places.  Of the other
slots the article is all that are marked as article or main part, by whichever of the two
holds more text, or, where none is marked, all of them.  The template's words go from marked
articles as well.  Inside an article the names of adverts, sign-ups and reader comments
tell; any other name leaves a part out only if most of its text is the template's.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from functools import cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probewatch.llm.common import offered, settle

#: A class is valid on at least so many pages, and this share of the host's pages.
PAGES, SHARE = 4, 0.5

# Element names of HTML and usual names of page parts.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "select summary table tbody td tfoot th thead title tr ul".split())
LEAVE_OUT = frozenset("head title nav footer aside form menu dialog select fieldset".split())
PART_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside footer header masthead topbar toolbar "
    "comment comments commentlist respond disqus reply replies notice notices cookie cookies consent gdpr alert "
    "newsletter subscribe signup login popup modal overlay share sharing social related recommended pagination pager widget "
    "copyright disclaimer form search".split())
# names of parts that are no story wherever they stand
FOREIGN_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo "
    "comment comments commentlist respond disqus reply replies cookie cookies consent gdpr "
    "newsletter subscribe signup login popup share sharing".split())
PLACE_NAMES = frozenset(
    "site page main top bottom left right area container wrapper wrap box block section list bar inner outer unit slot "
    "panel thread links icons buttons primary secondary global the js id".split())
PART_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
MAIN_ROLES = frozenset(["main", "article"])
# elements whose content is no text of the page; the first group holds text alone, the second may hold itself
PLAIN_ELEMENTS = frozenset("script style noscript iframe textarea".split())
NESTED_ELEMENTS = frozenset("template svg math object button canvas audio video".split())
# End of the fixed values.

# Each alternative ends at the first place it can, or else at the end of the searched text, so nothing is read twice.
_MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|</(?![a-zA-Z])[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)(>|\Z)", re.S)
_UNQUOTED = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|</(?![a-zA-Z])[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(>)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[A-Za-z]+|\d+")
_CLOSES = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "td", "th": "th", "option": "option"}


def host(url):
    """Host of a URL column, in lower case; null without one."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return F.when(found != "", found)


class _Open:
    __slots__ = ("tag", "path", "out", "level", "part", "raw")

    def __init__(self, tag, path, out, level, part):
        self.tag, self.path, self.out, self.level, self.part, self.raw = tag, path, out, level, part, []


class Block(NamedTuple):
    path: int
    out: bool
    level: int
    text: str
    part: int


class _Skips:
    """Ends of the elements that hold no text of the page."""

    def __init__(self, page):
        self.page, self.endless, self.uneven = page, set(), set()

    def end(self, tag, at):
        """Where the element that opened before ``at`` ends; ``at`` itself if it has no end."""
        if tag in self.endless:
            return at
        depth, first = 1, None
        for m in _ends(tag).finditer(self.page, at):
            if m[1]:
                first = first or m.end()
                depth -= 1
            elif tag in NESTED_ELEMENTS and not m[2].endswith("/"):
                depth += 1
            if depth == 0 or first and (tag in self.uneven or tag in PLAIN_ELEMENTS):
                return m.end()
        if first:
            self.uneven.add(tag)  # its starts and ends do not pair up: each first end counts from here
            return first
        self.endless.add(tag)
        return len(self.page) if tag in ("script", "style") else at


@cache
def _ends(tag):
    return re.compile(rf"<(/?){tag}(?=[\s/>])([^>]*)>", re.I)


def _closed(attributes: str) -> bool:
    """Whether a tag ends with a slash of its own, not one of an attribute's value."""
    if not attributes.endswith("/"):
        return False
    last = attributes.split()[-1][:-1]
    return "=" not in last or last[-1] in "\"'"


def _named(value: str, names: frozenset) -> bool:
    """Whether one of the words of a class or id is a name of ``names``, by itself or beside names of parts and places."""
    for word in value.split():
        parts = [w.lower() for w in _PARTS.findall(word)]
        if not names.isdisjoint(parts) and all(w in PART_NAMES or w in PLACE_NAMES or w.isdigit() for w in parts):
            return True
    return False


def _path(above: int, step: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{above:x}/{step}")


def blocks(page: str | None):
    """Each block with text, the count of each tag path, and the parent of each part.

    Level 2 is inside an article, 1 inside the main part, 0 elsewhere.  A part is an element
    of an article whose name is that of a page part; a block's ``part`` is the innermost
    around it, -1 without one, and parents come before the parts in them.
    """
    found, paths, parents, opened = [], Counter(), [], Counter()
    stack = [_Open("", 0, False, 0, -1)]
    page = page or ""

    def flush(top):
        if top.raw:
            text = " ".join(entities.unescape("".join(top.raw)).split())
            top.raw = []
            if text:
                found.append(Block(top.path, top.out, top.level, text, top.part))

    skips, markup = _Skips(page), _MARKUP
    at, last = 0, page.rfind(">") + 1
    while m := markup.search(page, at, last):
        if m[2] and not m[4]:
            markup = _UNQUOTED  # a quote takes the rest of the page: quotes are not heeded from here
            continue
        if m.start() > at:
            stack[-1].raw.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            if at == last and m[0].startswith("<!--") and not m[0].endswith(">"):
                at = len(page)
            continue
        tag = m[2].lower()
        if tag not in BLOCKS:
            if tag == "br":
                stack[-1].raw.append(" ")
            elif not m[1] and (tag in PLAIN_ELEMENTS or tag in NESTED_ELEMENTS) and not _closed(m[3]):
                at = skips.end(tag, at)
            continue
        top = stack[-1]
        flush(top)
        if m[1]:
            while opened[tag]:
                gone = stack.pop()
                opened[gone.tag] -= 1
                if gone.tag == tag:
                    break
            continue
        while len(stack) > 1 and (stack[-1].tag == "p" or _CLOSES.get(tag) == stack[-1].tag or tag == stack[-1].tag in _CLOSES):
            opened[stack.pop().tag] -= 1
        top = stack[-1]
        name, out, level = "", top.out or tag in LEAVE_OUT, top.level
        named = foreign = False
        if m[3]:
            for key, *values in _ATTRIBUTE.findall(m[3]):
                key, value = key.lower(), next((v for v in values if v), "")
                if key in ("class", "id"):
                    name = name or value.strip().lower()
                    if tag not in ("html", "body"):
                        named = named or _named(value, PART_NAMES)
                        foreign = foreign or _named(value, FOREIGN_NAMES)
                elif key == "role":
                    out = out or value.lower() in PART_ROLES
                    level = max(level, 1) if value.lower() in MAIN_ROLES else level
                elif key == "itemprop":
                    level = 2 if value.lower() == "articlebody" else level
                elif key == "hidden":
                    out = True
        part = top.part
        if named and top.level == 2 and not foreign:
            parents.append(part)
            part = len(parents) - 1
        elif named or tag == "header" and level == 0:
            out = True
        level = 2 if tag == "article" else max(level, 1) if tag == "main" else level
        path = _path(top.path, f"{tag}.{name}" if name else tag)
        paths[path] += 1
        if tag != "hr":
            stack.append(_Open(tag, path, out, level, part))
            opened[tag] += 1
    if at < len(page):
        rest = page[at:]
        stack[-1].raw.append(rest[:rest.find("<!--")] if "<!--" in rest else rest)
    for top in reversed(stack):
        flush(top)
    return found, paths, parents


def _key(path: int, word: str = "") -> int:
    return xxhash.xxh3_64_intdigest(f"{path}\x00{word}") - (1 << 63)


TOKEN, TAG = 0, 1


def _tokens(batches):
    """Tokens of each page with their counts."""
    for batch in batches:
        hosts, pages, kinds, keys, counts = [], [], [], [], []

        def put(h, page, kind, key, n):
            for column, value in zip((hosts, pages, kinds, keys, counts), (h, page, kind, key, n)):
                column.append(value)

        for h, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found, paths, _ = blocks(page)
            mark = xxhash.xxh3_64_intdigest(page) - (1 << 63)
            for path, n in paths.items():
                put(h, mark, TAG, _key(path), n)
            words: dict[int, list[Counter]] = {}
            for b in found:
                words.setdefault(b.path, []).append(Counter(b.text.split()))
            for path, each in words.items():
                if len(each) == paths[path]:
                    for word in set.intersection(*(set(c) for c in each)):
                        if all(c[word] == 1 for c in each):
                            put(h, mark, TOKEN, _key(path, word), len(each))
        for k in range(0, len(hosts), 50_000):
            cut = slice(k, k + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts[cut], pa.string()), pa.array(pages[cut], pa.int64()), pa.array(kinds[cut], pa.int32()),
                 pa.array(keys[cut], pa.int64()), pa.array(counts[cut], pa.int64())],
                ["host", "page", "kind", "key", "n"])


def templates(pages: DataFrame) -> DataFrame:
    """host, tokens (keys of the template's words).

    A template's tokens are on half of the host's pages or more, so there are at most twice
    as many as a page has on average.
    """
    rows = pages.select(host(F.col("url")).alias("host"), "html").where("host is not null and html is not null")
    # copies of one page tell nothing of the template: only they are exchanged, to leave one of each
    keyed = rows.withColumn("copy", F.xxhash64("html"))
    copied = settle(keyed.groupBy("host", "copy").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("host", "copy"))
    again = offered(copied, copied.count(), 48)
    once = keyed.join(again, ["host", "copy"], "left_anti").select("host", "html")
    first = keyed.join(again, ["host", "copy"], "left_semi").dropDuplicates(["host", "copy"]).select("host", "html")
    seen = once.unionByName(first).mapInArrow(_tokens, "host string, page long, kind int, key long, n long")
    tallied = settle(seen.groupBy("host", "kind", "key").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("n")))
    most = tallied.groupBy("host").agg(F.max("pages").alias("most"))
    frequent = tallied.join(most, "host").where((F.col("pages") >= PAGES) & (F.col("pages") >= SHARE * F.col("most")))
    valid = frequent.groupBy("host", "vector", "pages", "n").agg(
        F.count_if(F.col("kind") == TAG).alias("tags"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == TOKEN, F.col("key")))).alias("words"))
    return valid.where("tags > 0").groupBy("host").agg(F.array_sort(F.flatten(F.collect_list("words"))).alias("tokens"))


def main_text(page: str | None, template: set[int]) -> str:
    """The article of a page, blocks joined by line breaks."""
    found, _, parents = blocks(page)
    # words of the template are no slot's, marked or not
    fixed = [all(_key(b.path, w) in template for w in b.text.split()) for b in found]
    # a part of an article that its name tells is left out only if most of its text is the template's
    weight = [0] * len(parents)
    for b, f in zip(found, fixed):
        if b.part >= 0:
            weight[b.part] += len(b.text) if f else -len(b.text)
    for part in range(len(parents) - 1, -1, -1):
        if parents[part] >= 0:
            weight[parents[part]] += weight[part]
    told = []
    for part, parent in enumerate(parents):
        told.append(weight[part] > 0 or parent >= 0 and told[parent])
    kept = [b for b in found if not b.out]
    inner, outer = (sum(len(b.text) for b in kept if b.level == level) for level in (2, 1))
    level = 2 if inner and inner >= outer else 1 if outer else 0
    return "\n".join(b.text for b, f in zip(found, fixed)
                     if not b.out and b.level >= level and not f and not (b.part >= 0 and told[b.part]))


def _extract(batches):
    for batch in batches:
        ids, urls, html, tokens = (batch.column(k) for k in range(4))
        texts = [main_text(h, frozenset(t or ())) for h, t in zip(html.to_pylist(), tokens.to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    A null or empty html gives an empty text.  Pages without a host have no template and keep
    all their slots.  Pages may be of any length and nest to any depth: each is read once.  An
    element that ends with a slash of its own is empty; one without an end leaves out nothing,
    but for scripts and styles, which then last to the end.  Repeated rows give repeated rows, extra columns are ignored, and
    an empty table gives an empty result.
    """
    known = settle(templates(pages))
    size = known.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.size("tokens"), F.lit(0)))).first()
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"))
    joined = rows.join(offered(known, size[0] * 20 + (size[1] or 0), 8), "host", "left")
    return joined.select("page_id", "url", "html", "tokens").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")
