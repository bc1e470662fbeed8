"""Main text of web pages by a style tree per site.

Pages of one host are merged into one tree of their elements (by tag and class, from the root). A node
is as important as what it shows differs between pages: a text that c of the host's m pages show at a
node has entropy log_m(c), and the importance of a branch is the mean of one minus that over the texts below
it, lifted by the entropy of its presentation (how many sequences of child elements it comes in).
Branches of low importance are site furniture and are removed from each page. Pages that show the same long
blocks of main text are one page here, whatever their titles, menus, dates and adverts, so an article shown many
times is no template.

Menus, footers and the like often carry other words on each page, which entropy alone finds important;
elements whose tag, role or class says what they are weigh nothing. An article, where a page marks one,
is kept as it stands but for furniture inside it that says what it is; importance decides nothing there.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import checkpointed, without
from ledgerfold.session import small_side

#: Branches below this importance go, where at least so many different pages of the host show them.
IMPORTANT, PAGES = 0.4, 4
#: Blocks of so many letters tell whether two pages show the same main text; pages without any are told by all blocks.
LONG = 60

# Elements by their use in HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|noscript|template|iframe|title|svg|xmp|noembed|noframes"
FURNITURE = frozenset(
    "head nav footer aside form button select option datalist dialog menu object embed canvas audio video map fieldset".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner sponsor sponsored sponsors promo promotion cookie"
    " cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup"
    " share sharing social sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer colophon"
    " masthead adsbygoogle comment comments commentlist disqus discussion respond reply replies related recommended recommendations"
    " pagination pager login widget widgets toolbar skip skiplink".split()
)
#: Names that are furniture outside an article only.
OUTSIDE = frozenset("header topbar site-header".split())
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
P_STAYS = frozenset("table td th caption button object html".split())

#: Attributes as browsers read them: an unquoted value ends at white space or the tag's end, and a quote that stays open closes no tag.
VALUE = r"(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+)|(?=>))"
REST = r"(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+" + re.sub(r"\((?=\[)", "(?:", VALUE) + r"|(?!\s*+=)))*+"
TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})(?=[\s/>]){REST}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>{REST})>|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)|</?[a-zA-Z].*\Z",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+{VALUE}|(?!\s*+=))")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Page:
    """Elements in order: parent, tag, path (a hash of tags and classes from the root) and, for each text, its
    element, its block and itself."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: [""])
    path: list[int] = field(default_factory=lambda: [0])
    verdict: list[str] = field(default_factory=lambda: [""])
    texts: list[tuple[int, int, str]] = field(default_factory=list)

    def kept(self, low: frozenset[int] | set[int]) -> str:
        """Main text: blocks joined by a space."""
        return " ".join(self.blocks(low))

    def shown(self) -> int:
        """A hash of the long blocks of the main text, as tags and classes tell it."""
        said = self.blocks(frozenset())
        return xxhash.xxh3_64_intdigest("\n".join([s for s in said if len(s) >= LONG] or said).encode()) >> 1

    def blocks(self, low: frozenset[int] | set[int]) -> list[str]:
        """Blocks of the main text, white space in a block made one space."""
        n = len(self.tag)
        main = [v == "main" for v in self.verdict]
        holds = main[:]
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[self.parent[i]] = True
        says = [v in ("drop", "named", "outside") for v in self.verdict]
        around = [False] * n  # furniture lies below
        for i in range(n - 1, 0, -1):
            around[self.parent[i]] |= says[i] or around[i]
        wraps: set[int] = set()
        while True:
            out_of = [False] * n  # dropped, with all below
            inside = [False] * n
            tops = []
            for i in range(1, n):
                p = self.parent[i]
                inside[i] = inside[p] or main[i]
                v = self.verdict[i]
                furniture = v == "drop" or v == "named" and i not in wraps or v == "outside" and not inside[i]
                if not inside[i] and self.path[i] in low and self.tag[i] in ("div", "section", "ul", "ol", "table", "dl", "center"):
                    furniture = True
                out_of[i] = out_of[p] or furniture and not holds[i]
                if out_of[i] and not out_of[p] and v == "named" and around[i]:
                    tops.append(i)
            # a class such as "with-sidebar" around a whole page is no sidebar: nothing would be left, and the sidebar lies below it
            if holds[0] or not tops or any(not out_of[node] and not text.isspace() for node, _, text in self.texts):
                break
            wraps.update(tops)
        any_main = any(m and not o for m, o in zip(main, out_of, strict=True))
        blocks: list[list[str]] = []
        last = -1
        for node, block, text in self.texts:
            if out_of[node] or any_main and not inside[node]:
                continue
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
        said = (" ".join("".join(b).split()) for b in blocks)
        return [s for s in said if s]


def judge(tag: str, rest: str) -> tuple[str, str]:
    """What an element's tag and attributes say (``main``, ``drop``, ``named`` for a telling class, ``outside`` or
    nothing), and its classes."""
    verdict = "main" if tag in ("article", "main") else "drop" if tag in FURNITURE else "outside" if tag == "header" else ""
    names = ""
    if rest and not rest.isspace():
        for m in ATTRIBUTE.finditer(rest):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names += " " + value if name == "class" else ""
                if tag in ("html", "body"):
                    continue
                # an article's further classes say how it is shown ("comments-open"), not what it is
                parts = {p.lower() for p in PART.findall(" ".join(value.split()[:1]) if tag in ("article", "main") else value)}
                if parts & NAMES:
                    verdict = "drop" if verdict == "drop" else "named"
                elif not verdict and parts & OUTSIDE:
                    verdict = "outside"
            elif name == "role":
                verdict = "drop" if value.lower() in ROLES else "main" if value.lower() in ("main", "article") else verdict
            elif name == "itemprop" and value == "articleBody":
                verdict = "main"
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                verdict = "drop"
            elif name == "style" and re.search(r"display\s*:\s*none", value):
                verdict = "drop"
    return verdict, names


def parse(source: str) -> Page:
    """A page's elements and texts. What is left open is closed as browsers do for paragraphs, list items
    and cells; end tags without a beginning are passed over; the end of the page ends everything."""
    page = Page()
    stack, block, at = [0], 0, 0
    tags, texts = page.tag, page.texts
    seen: dict[tuple[str, str], tuple[str, str]] = {}

    def text(end: int) -> None:
        if end > at:
            said = source[at:end]
            texts.append((stack[-1], block, entities.unescape(said) if "&" in said else said))

    for m in TOKEN.finditer(source):
        text(m.start())
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"] is None and m[0].startswith("<![CDATA["):
                texts.append((stack[-1], block, m[0][9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if m["end"]:
            for i in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[i]]
                if open_tag == tag:
                    del stack[i:]
                    break
                if inline and open_tag not in INLINE:
                    break
            block += not inline
            continue
        if tag == "br":
            texts.append((stack[-1], block, " "))
            continue
        if not inline:
            block += 1
            closes, scope = CLOSES.get(tag, ((), ()))
            for i in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[i]]
                if open_tag in scope:
                    break
                if open_tag in closes:
                    del stack[i:]
                    break
            for i in range(len(stack) - 1, 0, -1):
                open_tag = tags[stack[i]]
                if open_tag == "p":
                    del stack[i:]
                    break
                if open_tag in P_STAYS:
                    break
        if tag in VOID:
            continue
        key = (tag, m["rest"])
        found = seen.get(key)
        if found is None:
            found = seen[key] = judge(tag, m["rest"])
        up = stack[-1]
        page.parent.append(up)
        tags.append(tag)
        page.verdict.append(found[0])
        page.path.append(xxhash.xxh3_64_intdigest(f"{tag}.{found[1]}", page.path[up]) & (1 << 63) - 1)
        if m["rest"].endswith("/") and tag in ("path", "g"):
            continue
        stack.append(len(tags) - 1)
    text(len(source))
    return page


SEEN = "host string, page long, path long, parent long, style long, texts array<long>"


def sightings(pages: DataFrame) -> DataFrame:
    """One row per page and node of the style tree: its path and its parent's, a hash of the children's tags,
    and hashes of the texts shown right there. ``page`` is a hash of what the page shows (see :meth:`Page.shown`), so
    copies of one main text count once."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for host, source in zip(part["host"], part["html"], strict=True):
                page = parse(source or "")
                uid = page.shown()
                children: dict[int, list[str]] = {}
                parents = {0: 0}
                said: dict[int, list[str]] = {}
                for i in range(1, len(page.tag)):
                    up = page.path[page.parent[i]]
                    parents[page.path[i]] = up
                    children.setdefault(up, []).append(page.tag[i])
                block_texts: dict[tuple[int, int], list[str]] = {}
                for node, block, t in page.texts:
                    block_texts.setdefault((node, block), []).append(t)
                for (node, _), ts in block_texts.items():
                    if s := " ".join("".join(ts).split()):
                        said.setdefault(page.path[node], []).append(s)
                for path, up in parents.items():
                    style = xxhash.xxh3_64_intdigest(" ".join(dict.fromkeys(children.get(path, ())))) >> 1
                    texts = sorted({xxhash.xxh3_64_intdigest(t) >> 1 for t in said.get(path, ())})
                    rows.append((host, uid, path, up, style, texts))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SEEN.split(", ")])

    return pages.mapInPandas(of, SEEN)


def low_branches(pages: DataFrame, important: float = IMPORTANT, least_pages: int = PAGES) -> DataFrame:
    """``host`` and ``low``: the paths of its style tree whose importance is below ``important``.

    Counts come from partial aggregates by host, path and text, so a host with very many pages is no single
    task. Importance goes up the tree level by level: sums of a node are those of its texts and its children.
    """
    seen = checkpointed(sightings(pages))
    nodes = seen.groupBy("host", "path").agg(F.countDistinct("page").alias("m"), F.min("parent").alias("parent"))
    styles = seen.select("host", "path", "style", "page").distinct().groupBy("host", "path", "style").agg(F.count("*").alias("c"))
    texts = seen.select("host", "path", "page", F.explode("texts").alias("text")).distinct().groupBy("host", "path", "text").agg(F.count("*").alias("c"))
    at = ["host", "path"]

    def share(counts: DataFrame) -> DataFrame:
        return counts.join(nodes.select(*at, "m"), at).filter(F.col("m") >= least_pages)

    log_m = lambda x: F.least(F.lit(1.0), F.log(x) / F.log("m"))
    shown = share(styles).groupBy(*at).agg(
        F.sum(F.col("c") / F.col("m") * log_m(F.col("m") / F.col("c"))).alias("presentation")
    )
    own = share(texts).groupBy(*at).agg(
        F.sum(F.col("c") * (1 - log_m(F.col("c")))).alias("weight"), F.sum("c").alias("n")
    )
    tree = checkpointed(
        nodes.filter(F.col("m") >= least_pages).join(own, at, "left").join(shown, at, "left")
        .select(*at, "parent", F.coalesce("presentation", F.lit(0.0)).alias("presentation"),
                F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("n", F.lit(0)).alias("n"))
    )
    # texts of all descendants: each node's own sums go to all its ancestors, one level a round
    rising, levels = tree.select("host", F.col("path").alias("here"), "weight", "n").filter("n > 0"), []
    parent = tree.select("host", F.col("path").alias("here"), F.col("parent").alias("up"))
    while True:
        rising = checkpointed(rising.groupBy("host", "here").agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")))
        if rising.isEmpty():
            break
        levels.append(rising)
        rising = rising.filter("here <> 0").join(parent, ["host", "here"]).select("host", F.col("up").alias("here"), "weight", "n")
    if not levels:
        return pages.sparkSession.createDataFrame([], "host string, low array<long>")
    total = levels[0]
    for level in levels[1:]:
        total = total.unionByName(level)
    total = total.groupBy("host", F.col("here").alias("path")).agg(F.sum("weight").alias("weight"), F.sum("n").alias("n"))
    content = F.col("weight") / F.col("n")
    low = total.join(tree.select(*at, "presentation"), at).filter(
        (content < important) & (F.col("presentation") * 0.5 + content < important)
    )
    return low.groupBy("host").agg(F.collect_set("path").alias("low"))


def host_of(url):
    """Host of a URL in small letters, without user, port or ``www.``; empty for null."""
    host = F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(host, r"^www\.", "")


def main_text(pages: DataFrame, html: str = "html", url: str = "url", out: str = "text") -> DataFrame:
    """Append the main text of each page, empty where there is none or the page is null or empty.

    Pages of the same host share a style tree; those without a host share one too. Nothing is cut, however
    long the page. A column named ``out`` is replaced; repeated rows are treated alike.
    """
    kept = without(pages, out)
    known = pages.select(*kept, F.col(html).alias("__html"), host_of(F.col(url)).alias("__host"))
    low = low_branches(known.select(F.col("__host").alias("host"), F.col("__html").alias("html")))
    low = checkpointed(low).select(F.col("host").alias("__host"), F.col("low").alias("__low"))

    @F.pandas_udf("string")
    def of(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sources, lows in parts:
            yield pd.Series([
                parse(s).kept(frozenset(w) if w is not None and len(w) else frozenset()) if s else "" for s, w in zip(sources, lows, strict=True)
            ], dtype=object)

    joined = known.join(small_side(low), "__host", "left")
    return joined.select(*kept, of(F.col("__html"), F.col("__low")).alias(out))
