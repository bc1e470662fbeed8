"""HTML reduction to a safe subset and to text.

Markup is read as a stream of tokens that one pattern cuts, and folded over a list of what is open. Column
expressions cannot keep such a list, so these are Arrow-batched UDFs; values without markup never reach
them. Lists of texts go through one call, each text on its own.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import escape, unescape

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Rows that go to Python at once. A batch of whole texts is held several times over in each task, so its rows
#: decide an executor's memory; Spark's own 10,000 let it grow with the input.
BATCH_ROWS = 500
#: Bytes that go to Python at once, about: rows alone say little where texts are long. Spark's own bound is 64 MB.
BATCH_BYTES = 4 << 20

# The safe subset.
ALLOWED_TAGS = frozenset({
    "a", "abbr", "b", "blockquote", "br", "code", "dd", "dl", "dt", "em", "h3", "h4", "h5", "h6", "i", "li", "ol", "p",
    "pre", "s", "small", "span", "strong", "sub", "sup", "table", "tbody", "td", "th", "thead", "tr", "u", "ul",
})
ALLOWED_ATTRIBUTES = {
    "a": ("href", "title"),
    "abbr": ("title",),
    "td": ("colspan", "rowspan"),
    "th": ("colspan", "rowspan", "scope"),
}
HREF_SCHEMES = ("http", "https", "mailto")
SILENT_TAGS = frozenset({"script", "style", "iframe", "object", "embed", "template", "svg"})
BLOCK_TAGS = frozenset({
    "p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "section", "article",
})

#: An attribute as browsers read it: a name, and after an equals sign a quoted value, one up to white space or the tag's end, or none.
#: A quote that is never closed makes no attribute.
_NAMED = r"(?P<key>[^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"(?P<v2>[^\"]*+)\"|'(?P<v1>[^']*+)'|(?P<v0>[^\s>\"'][^\s>]*+)|(?=>))|(?!\s*+=))"
_ATTRIBUTE = re.compile(_NAMED)
_REST = r"(?:[\s/]++|" + re.sub(r"\?P<\w+>", "?:", _NAMED) + r")*+"
#: A comment, a script or style with what it holds, a tag, another declaration, or a tag that the text ends in. All else is text.
_TOKEN = re.compile(
    rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<whole>script|style)(?=[\s/>]){_REST}>.*?(?:</(?P=whole)(?=[\s/>]){_REST}>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>{_REST})>|<(?:[!?]|/(?![a-z]))[^>]*(?:>|\Z)|</?[a-z].*\Z",
    re.IGNORECASE | re.DOTALL,
)
#: The space of a language, in any width. A line is trimmed of these and of what a run of spaces is; separators of files or records stay.
_SPACES = " \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_BLANK = re.compile(r"[\x00-\x20\x7f]+")
_EDGE = re.compile(r"^[\x00-\x20\x7f]+|[\x00-\x20\x7f]+$")
_SCHEME = re.compile(r"([a-z][a-z0-9+.\-]*):", re.IGNORECASE)

#: ``(kind, value, rest)``: ``text`` with its characters decoded, or ``open``, ``empty`` and ``end`` with a tag.
Token = tuple[str, str, str]


def _href(value: str) -> str | None:
    cleaned = _EDGE.sub("", re.sub(r"[\x00\t\r\n]", "", value))
    probe = _BLANK.sub("", cleaned)
    scheme = _SCHEME.match(probe)
    if not cleaned or probe.startswith("//"):
        return None
    return cleaned if scheme is None or scheme.group(1).lower() in HREF_SCHEMES else None


def tokens(source: str) -> Iterator[Token]:
    """What is heard of a document: silent elements and all in them are left out, whatever is nested."""
    at, hushed = 0, 0
    for m in _TOKEN.finditer(source):
        if at < m.start() and not hushed:
            yield "text", unescape(source[at : m.start()]), ""
        at = m.end()
        name = (m["name"] or "").lower()
        if name in SILENT_TAGS:
            if not m["rest"].endswith("/"):
                hushed = max(0, hushed - 1) if m["end"] else hushed + 1
        elif name and not hushed:  # an unclosed tag has no name: nothing is shown of it
            kind = "end" if m["end"] else "empty" if m["rest"].endswith("/") or name == "br" else "open"
            yield kind, name, m["rest"].removesuffix("/")
    if at < len(source) and not hushed:
        yield "text", unescape(source[at:]), ""


def _shown(name: str, rest: str) -> str:
    """The attributes of a tag that are safe to keep."""
    allowed = ALLOWED_ATTRIBUTES.get(name)
    if not allowed or not rest.strip():
        return ""
    given = [(m["key"].lower(), unescape(m["v2"] or m["v1"] or m["v0"] or "")) for m in _ATTRIBUTE.finditer(rest)]
    values = [(n, _href(v) if n == "href" else v) for n, v in given if n in allowed]
    said = "".join(f' {n}="{escape(v, quote=True)}"' for n, v in values if v is not None)
    followed = name == "a" and any(n == "href" and v is not None for n, v in values)
    return said + (' rel="nofollow noopener"' if followed else "")


def safe_markup(source: str | None) -> str:
    """The safe subset of a document: allowed tags, balanced, and its text escaped."""
    out: list[str] = []
    pending: list[str] = []  # end tags still owed, the last one first
    for kind, value, rest in tokens(source or ""):
        if kind == "text":
            out.append(escape(value, quote=False))
        elif value not in ALLOWED_TAGS:
            continue
        elif kind == "empty":
            out.append(f"<{value}{_shown(value, rest)} />")
        elif kind == "open":
            out.append(f"<{value}{_shown(value, rest)}>")
            pending.insert(0, f"</{value}>")
        elif f"</{value}>" in pending:
            due = pending.index(f"</{value}>") + 1
            out += pending[:due]
            del pending[:due]
    return "".join(out + pending)


def readable(source: str | None) -> str:
    """The text of a document: block tags break lines, runs of spaces become one, two breaks at most."""
    parts = [value if kind == "text" else "\n" if value in BLOCK_TAGS else "" for kind, value, _ in tokens(source or "")]
    lines = [re.sub(r"[ \t\r\f\v]+", " ", line).strip(_SPACES) for line in "".join(parts).split("\n")]
    kept: list[str] = []
    for line in lines:
        if line or (kept and kept[-1]):
            kept.append(line)
    return "\n".join(kept).strip("\n")


# Functions of series, not of iterators: Spark runs all of these that a projection has in one Python worker of a task,
# where each iterator has a worker of its own.
def _column(of: Callable[[str | None], str]):
    @F.pandas_udf(StringType())
    def udf(texts: pd.Series) -> pd.Series:
        return texts.map(of, na_action="ignore")

    return udf


def _lists(of: Callable[[str | None], str]):
    @F.pandas_udf(ArrayType(StringType()))
    def udf(lists: pd.Series) -> pd.Series:
        return lists.map(lambda texts: [of(t) for t in texts], na_action="ignore")

    return udf


_safe_udf, _text_udf = _column(safe_markup), _column(readable)
_safe_list_udf, _text_list_udf = _lists(safe_markup), _lists(readable)


def _short_batches() -> None:
    """At most ``BATCH_ROWS`` rows and about ``BATCH_BYTES`` a batch from now on in this session; fewer, if it says so."""
    spark, arrow = SparkSession.getActiveSession(), "spark.sql.execution.arrow"
    if spark is None:
        return
    if not 0 < int(spark.conf.get(f"{arrow}.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set(f"{arrow}.maxRecordsPerBatch", str(BATCH_ROWS))
    held = spark.conf.get(f"{arrow}.maxBytesPerBatch").removesuffix("b")
    if held.isdigit() and int(held) > BATCH_BYTES:  # a size with another unit is the session's own
        spark.conf.set(f"{arrow}.maxBytesPerBatch", str(BATCH_BYTES))


def sanitise_html(html: Column) -> Column:
    """The safe subset of an HTML column; never NULL. Values without markup stay in the JVM."""
    _short_batches()
    plain = F.when(~html.rlike("[<&]"), F.replace(html, F.lit(">"), F.lit("&gt;")))
    return F.coalesce(plain, _safe_udf(F.when(html.rlike("[<&]"), html)), F.lit(""))


def html_to_text(html: Column) -> Column:
    """Readable text of an HTML column: block tags break lines, spaces collapse. Values that are that
    already stay in the JVM."""
    _short_batches()
    marked = html.rlike(r"(?U)[<&]|[^\S ]|  |^ | $")
    return F.coalesce(F.when(~marked, html), _text_udf(F.when(marked, html)), F.lit(""))


def sanitise_each(texts: Column) -> Column:
    """The safe subset of each text of an array, each read on its own; a NULL text gives an empty one."""
    _short_batches()
    return _safe_list_udf(texts)


def texts_of_each(texts: Column) -> Column:
    """Readable text of each text of an array, each read on its own; a NULL text gives an empty one."""
    _short_batches()
    return _text_list_udf(texts)


def unwrap_jats(markup: Column) -> Column:
    return F.regexp_replace(markup, r"(</?)jats:([a-zA-Z][-a-zA-Z0-9]*)", "$1$2")
