"""Main text of web pages, with what a site's templates repeat removed."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lookback.llm.common import staged

TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))                                    # comment
      | <[!?][^>]*(?:>|\Z)                                              # declaration
      | <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
      | <(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>     # stray quotes""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")

#: Elements of HTML by how they are laid out or closed.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead figcaption".split())
CLOSES_P = BLOCKS - frozenset("body html head option optgroup legend li dd dt td th tr tbody thead tfoot".split())
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "tr": frozenset(["td", "th", "tr"]),
    "tbody": frozenset(["td", "th", "tr", "tbody", "thead"]),
    "tfoot": frozenset(["td", "th", "tr", "tbody", "thead"]),
    "option": frozenset(["option"]),
    "optgroup": frozenset(["option", "optgroup"]),
}
#: An implied end never reaches beyond one of these.
SCOPE = frozenset("article aside body div footer header html li main nav ol section table td th ul".split())

#: Elements, roles and words of class or id that mark what surrounds a text.
FURNITURE_TAGS = frozenset(
    "aside button dialog datalist fieldset footer head legend menu nav object optgroup option "
    "select svg".split()
)
FURNITURE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search "
    "toolbar".split()
)
FURNITURE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popups?|"
    r"modal|overlay|newsletter|subscri\w+|signup|login|sidebar|side|widgets?|menus?|nav|navbar|"
    r"navigation|breadcrumbs?|footer|foot|masthead|shar(?:e|ing)|social|related|recommend\w*|"
    r"comments?|commentlist|repl(?:y|ies)|respond|disqus|search|copyright|pagination|pager|skip|"
    r"banner|toolbar|alert)(?![a-z])"
)
#: Within an article a name is furniture's if it ends with such a word, or if one of these
#: follows: "related-posts" is, "related-work" or "side-effects" name the author's subject.
ENDING = re.compile(
    r"[-_ ]*(?:bar|block|body|box|btn|buttons?|cards?|container|content|feed|forms?|group|inner|items?|"
    r"label|links?|list|outer|panel|posts?|row|section|slot|stories|text|title|tools?|unit|widgets?|"
    r"wrap|wrapper|zone|\d+)?s?"
    r"(?:[-_ ]+(?:bar|box|container|inner|item|left|link|links|list|right|row|top|bottom|wrap|wrapper|\d+))*$"
)
HEADER_WORDS = re.compile(r"(?:^|[^a-z])(?:header|topbar|head)(?![a-z])")
#: Comments may be longer than the text they follow.
COMMENT_WORDS = re.compile(r"(?:^|[^a-z])(?:comments?|commentlist|repl(?:y|ies)|respond|disqus)(?![a-z])")
#: What a name says from such a word on is about the page's state or subject.
STATE = re.compile(r"(?:^|[^a-z0-9])(?:has|have|is|no|not|with|without|hide|hidden|show|tag|category|cat|topic)[-_].*")


def _attributes(text: str) -> dict[str, str]:
    return {
        name.lower(): entities.unescape(value[1:-1] if value[:1] in "\"'" and value else value)
        for name, value in reversed(ATTRIBUTE.findall(text))
    }


def _names_furniture(name: str, in_article: bool) -> bool:
    if in_article:
        return any(ENDING.match(name, found.end()) for found in FURNITURE_WORDS.finditer(name))
    return bool(FURNITURE_WORDS.search(name) or HEADER_WORDS.search(name))


def _furniture(tag: str, attrs: str, in_article: bool) -> str:
    """Why an element is furniture: "sure", or "named", "form" or "comment", which may be wrong."""
    if tag in FURNITURE_TAGS or (tag == "header" and not in_article):
        return "sure"
    if attrs and tag not in ("html", "body", "main"):
        held = _attributes(attrs)
        role = held.get("role", "").lower()
        if "hidden" in held or role in FURNITURE_ROLES:
            return "sure"
        if tag != "article" and role != "main":
            names = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", f"{held.get('class', '')} {held.get('id', '')}")
            names = [STATE.sub("", name) for name in names.lower().split()]
            if any(COMMENT_WORDS.search(name) for name in names):
                return "comment"
            if any(_names_furniture(name, in_article) for name in names):
                return "named"
    return "form" if tag == "form" else ""


class Page:
    """Blocks of text of one page and its block-level elements, read in one pass.

    ``blocks`` holds (text, in main part, furniture); ``elements`` holds (hash of the
    subtree, first block, end of its blocks, words if an article or main element holds it,
    else ``ANYWHERE``) of those that a template may have put there:
    not the main part or what contains it, and within it no paragraphs, headings, items
    or cells, which are the author's even where they repeat.

    Forms and elements that only their names make furniture are judged when the page has
    been read: one that holds the article (if no article is outside of all of them), or
    most of the main part's text, is none. What an inline element holds that is surely
    furniture, such as a button, leaves the text around it whole. Every tag takes a
    constant number of steps, whatever is open.
    """

    def __init__(self, html: str) -> None:
        self.blocks: list[tuple[str, bool, bool]] = []
        self.elements: list[tuple[int, int, int, int]] = []
        self.buffer: list[str] = []
        # Places on the stack of open elements: by tag, of blocks, of those that end a scope.
        self.open: defaultdict[str, list[int]] = defaultdict(list)
        self.open_blocks: list[int] = [0]
        self.open_scopes: list[int] = [0]
        # Texts put aside while an inline piece of furniture is read, by its place.
        self.aside: list[tuple[int, list[str]]] = []
        # tag, first block, in article, in main, furniture, hash so far, number, doubt, in doubt
        self.stack: list[list] = [["", 0, False, False, False, xxhash.xxh64(), 0, "", False]]
        self.started = 0
        # first block, end of the blocks, number, last number within; then tag or doubt, in doubt
        self.parts: list[tuple[int, int, int, int, str, bool]] = []
        self.doubts: list[tuple[int, int, int, int, str, bool]] = []
        self.found: list[tuple[int, int, int, int, int]] = []
        self.marks: list[tuple[bool, bool, bool]] = []
        self._read(html)
        self._flush()
        while len(self.stack) > 1:
            self._pop()
        self._judge()
        article = any(a and not f for a, _, f in self.marks)
        main = any(m and not f for _, m, f in self.marks)
        whole = not article and not main
        self.blocks = [
            (text, whole or (a if article else m), f)
            for (text, _, _), (a, m, f) in zip(self.blocks, self.marks, strict=True)
        ]
        core = xxhash.xxh64()
        for text, inside, furniture in self.blocks:
            if inside and not furniture:
                core.update(text.encode("utf-8", "replace") + b"\n")
        self.core = core.intdigest() - (1 << 63)

    def _judge(self) -> None:
        """Settle what is furniture, and which elements hold the main part."""
        size = [0 if f else len(text) for (text, _, _), (_, _, f) in zip(self.blocks, self.marks, strict=True)]
        upto = [0, *accumulate(size)]
        parts = [p for p in self.parts if upto[p[1]] > upto[p[0]]]
        free = [p for p in parts if not p[5]]
        doubts = self.doubts
        if parts and not free:
            free = [max(parts, key=lambda p: (p[4] == "article", upto[p[1]] - upto[p[0]]))]
            doubts = [d for d in doubts if not d[2] < free[0][2] <= d[3]]
        chosen = [p for p in free if p[4] == "article"] or free
        if chosen:
            inside = self._covered(chosen)
            upto = [0, *accumulate(n if held else 0 for n, held in zip(size, inside, strict=True))]
        gone = []
        for d in doubts:
            held = upto[d[1]] - upto[d[0]]
            most = 2 * held > upto[-1] and (d[1] - d[0] > 1 or held == upto[-1])
            if d[4] == "comment" or not most:
                gone.append(d)
        covered = self._covered(gone)
        self.marks = [(a, m, f or c) for (a, m, f), c in zip(self.marks, covered, strict=True)]
        words = [0, *accumulate(len(text.split()) for text, _, _ in self.blocks)]
        numbers = sorted({p[2] for p in [*(q for q in self.parts if not q[5]), *free]})
        for value, first, stop, number, last in self.found:
            if bisect_right(numbers, last) == bisect_right(numbers, number):
                a, m, _ = self.marks[first]
                self.elements.append((value, first, stop, words[stop] - words[first] if a or m else ANYWHERE))

    def _covered(self, ranges: list[tuple]) -> list[bool]:
        change = [0] * (len(self.blocks) + 1)
        for held in ranges:
            change[held[0]] += 1
            change[held[1]] -= 1
        return [depth > 0 for depth in accumulate(change[:-1])]

    def _read(self, html: str) -> None:
        at, size = 0, len(html)
        while at < size:
            found = TOKEN.search(html, at)
            if not found:
                self.buffer.append(entities.unescape(html[at:]))
                return
            if found.start() > at:
                self.buffer.append(entities.unescape(html[at : found.start()]))
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if found["end"] or found["end2"]:
                self._end(tag)
                continue
            attrs = found["attrs"] or found["attrs2"] or ""
            self._start(tag, attrs)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?|\Z", re.I).search(html, at)
                at = end.end()
                self._end(tag)
            elif attrs.rstrip().endswith("/") and tag in ("svg", "path", "circle", "use"):
                self._end(tag)

    def _flush(self) -> None:
        if not self.buffer:
            return
        text = " ".join("".join(self.buffer).split())
        self.buffer.clear()
        if text:
            _, _, article, main, furniture, digest, *_ = self.stack[-1]
            digest.update(b"t" + text.encode("utf-8", "replace"))
            self.blocks.append((text, False, False))
            self.marks.append((article, main, furniture))

    def _start(self, tag: str, attrs: str) -> None:
        if tag in CLOSES_P:
            self._imply(frozenset(["p"]))
        if tag in CLOSED_BY:
            self._imply(CLOSED_BY[tag])
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        _, _, article, main, furniture, _, _, _, unsure = self.stack[-1]
        doubt = "" if furniture else _furniture(tag, attrs, article)
        furniture = furniture or doubt == "sure"
        if doubt == "sure" and tag not in BLOCKS:
            self.aside.append((len(self.stack), self.buffer))
            self.buffer = []
        part = ""
        if (tag in ("article", "main") or 'role="main"' in attrs) and not furniture:
            part = "article" if tag == "article" else "main"
            article, main = article or tag == "article", True
        block = tag in BLOCKS
        digest = xxhash.xxh64(tag.encode()) if block else self.stack[-1][5]
        self.started += 1
        unsure = unsure or doubt in ("named", "form", "comment")
        self.open[tag].append(len(self.stack))
        if block:
            self.open_blocks.append(len(self.stack))
        if tag in SCOPE:
            self.open_scopes.append(len(self.stack))
        self.stack.append(
            [tag, len(self.blocks), article, main, furniture, digest, self.started, part or doubt, unsure]
        )

    def _imply(self, tags: frozenset[str]) -> None:
        """Close the innermost of ``tags`` within the current scope, if one is open."""
        at = max((self.open[tag][-1] for tag in tags if self.open[tag]), default=0)
        # Inline furniture is a scope of its own, as a button is.
        if at and at >= max(self.open_scopes[-1], self.aside[-1][0] if self.aside else 0):
            self._flush()
            while len(self.stack) > at:
                self._pop()

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if not self.open[tag]:
            return
        at = self.open[tag][-1]
        if tag not in BLOCKS and self.open_blocks[-1] > at:
            return  # a stray end of an inline element closes no block
        while len(self.stack) > at:
            self._pop()

    def _pop(self) -> None:
        if self.aside and self.aside[-1][0] == len(self.stack) - 1:
            self._flush()
            self.buffer = self.aside.pop()[1]
        tag, first, article, main, _, digest, number, kind, unsure = self.stack.pop()
        self.open[tag].pop()
        if tag in BLOCKS:
            self.open_blocks.pop()
        if tag in SCOPE:
            self.open_scopes.pop()
        stop, last = len(self.blocks), self.started
        if kind in ("article", "main"):
            self.parts.append((first, stop, number, last, kind, unsure))
        elif kind in ("named", "form", "comment") and stop > first:
            self.doubts.append((first, stop, number, last, kind, unsure))
        if tag not in BLOCKS:
            return
        value = digest.intdigest()
        self.stack[-1][5].update(b"e" + value.to_bytes(8, "big"))
        fixed = tag in ("html", "body", "article", "main") or kind == "main" or (main and tag in PROSE)
        if stop > first and not fixed:
            self.found.append((value - (1 << 63), first, stop, number, last))


#: In the place of the words of an element outside of main parts.
ANYWHERE = (1 << 31) - 1
PARSED = (
    "core long, blocks array<struct<text:string,main:boolean,furniture:boolean>>, "
    "elements array<struct<hash:bigint,start:int,stop:int,live:boolean,words:int>>"
)


def parsed(html: Column) -> Column:
    """Struct of the blocks and elements (``PARSED``) of a page; none for null or empty.

    Blocks outside the main text have a null text; ``live`` elements hold main text.
    """
    kind = ",".join(f"{p.split(' ')[0]}:{p.split(' ')[1]}" for p in PARSED.split(", "))
    block = pa.struct([("text", pa.string()), ("main", pa.bool_()), ("furniture", pa.bool_())])
    element = pa.struct(
        [("hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("live", pa.bool_()), ("words", pa.int32())]
    )
    whole = pa.struct([("core", pa.int64()), ("blocks", pa.list_(block)), ("elements", pa.list_(element))])

    def one(text: str | None) -> dict:
        page = Page(text or "")
        held = [main and not furniture for _, main, furniture in page.blocks]
        upto = [0, *accumulate(held)]
        return {
            "core": page.core,
            "blocks": [
                {"text": text if keep else None, "main": main, "furniture": furniture}
                for keep, (text, main, furniture) in zip(held, page.blocks, strict=True)
            ],
            "elements": [
                {"hash": value, "start": start, "stop": stop, "live": upto[stop] > upto[start], "words": words}
                for value, start, stop, words in page.elements
            ],
        }

    @F.arrow_udf(f"struct<{kind}>")
    def parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([one(t.as_py()) for t in batch], whole)

    return parse(html)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty if it has none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def main_text(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = 5,
    min_share: float = 0.05,
    many_pages: int = 50,
    min_words: int = 8,
) -> DataFrame:
    """Main text of every page: (``id_col``, ``url_col``, ``text``, ``n_chars``).

    Pages are read into block-level elements and blocks of text (character references
    decoded, white space made single spaces). Every element's subtree is hashed; one that
    occurs with ``min_pages`` or more different main texts of its host, and with at least
    ``min_share`` of them, is a template's and its blocks go. On large hosts ``many_pages``
    are enough, within an article or main element only for one of ``min_words`` words or more:
    shorter ones, down to a list of one word, are ordinary content of many articles. Copies of one article count
    once, so that copied articles are no template. Then what navigation, header, footer,
    side, form, notice, advert or comment elements hold goes, by element, role, class and
    id, and if the page has an article (else a main) element, what is outside it. The
    remaining blocks are joined by two line ends.

    A null or empty page has an empty text. A null or strange url counts as the host
    without a name. Repeated rows stay, one result each. No rows give no rows. A page takes
    time and memory in proportion to its length, however its tags are nested or broken.

    The counting is keyed by host and subtree and combined before the shuffle, so a host
    with a third of all pages is spread over all tasks. Of the templates only what they
    put into main texts meets the pages again, by its measured size: where articles are
    marked that is little, and the texts are not shuffled.
    """
    rows = staged(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(url_col).alias("url"),
            host_of(F.col(url_col)).alias("host"),
            parsed(F.col(html_col)).alias("p"),
        ).select("row", "id", "url", "host", "p.core", "p.blocks", "p.elements"),
        "html-pages",
        "zstd",
    )
    parts = rows.select("row", "host", "core", F.explode("elements").alias("e")).select(
        "row", "host", "core", "e.hash", "e.start", "e.stop", "e.live", "e.words"
    )
    hosts = rows.select("host", "core").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    often = (
        parts.select("host", "hash", "core", "words")
        .distinct()
        .groupBy("host", "hash")
        .agg(F.count("*").alias("n"), F.max("words").alias("words"))
        .where(F.col("n") >= min_pages)
    )
    templates = (
        often.join(hosts, "host")
        .where((F.col("n") >= min_share * F.col("pages")) | ((F.col("n") >= many_pages) & (F.col("words") >= min_words)))
        .select("host", "hash")
    )
    gone = (
        parts.where("live")
        .join(templates, ["host", "hash"])
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    )
    # Written, so that its size is known before the texts would be shuffled for it.
    gone = staged(gone, "html-gone")
    within = lambda i: F.exists("ranges", lambda r: (i >= r["start"]) & (i < r["stop"]))
    left = F.when(F.col("ranges").isNull(), F.col("blocks")).otherwise(
        F.filter("blocks", lambda _, i: ~within(i))
    )
    text = F.concat_ws(
        "\n\n", F.transform(F.filter("left", lambda b: b["main"] & ~b["furniture"]), lambda b: b["text"])
    )
    return (
        rows.select("row", "id", "url", "blocks")
        .join(gone, "row", "left")
        .withColumn("left", left)
        .withColumn("text", text)
        .select(
            F.col("id").alias(id_col),
            F.col("url").alias(url_col),
            "text",
            F.length("text").cast("long").alias("n_chars"),
        )
    )
