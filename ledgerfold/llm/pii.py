"""Personal data in texts, with column expressions only.

Regular expressions propose spans, checks confirm them (Luhn, mod 97, number ranges, digit counts), and
words nearby adjust the score. Spans are in code points. The four base kinds are kept whatever their
score; ``iban`` and ``ssn`` are added where their score reaches a threshold and no base span overlaps.

Matches and the text between them come from the same expression (``regexp_extract_all`` and ``split``),
so their lengths give the places without a search. The patterns hold no loop that backtracks or recurses:
a very long run of digits or letters costs time in proportion.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import without

#: Matches whose places are added up together; see ``located``.
GROUP = 256
#: Code points before a match, back to the match before it, that are searched for context words.
NEARBY = 40
#: Added kinds need this score.
THRESHOLD = 0.6


@dataclass(frozen=True)
class Kind:
    """``needs``: a text without this is not searched. ``score`` rises by ``boost`` near a context word."""

    name: str
    pattern: str
    needs: str
    score: float
    context: str
    boost: float = 0.3
    base: bool = True


# A match begins at the start of a run of its first class, or where the last match ended. For these
# patterns no later start in a run can match if the first doesn't, so this finds the same spans as the
# bare patterns do.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         r"mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", ".", 0.6, r"\bip\b|address|host|server"),
    Kind("card", r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])", "", 0.8,
         r"card|visa|credit|debit"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.6, r"phone|call|tel\b|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])", "", 0.9,
         r"iban|account|bank", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.4, r"ssn|social|security|tax", base=False),
)
ORDER = {k.name: i for i, k in enumerate(KINDS)}
SPAN = "array<struct<start: int, kind: int, end: int, score: double>>"


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Do the digits pass the Luhn check?"""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d < 5, 2 * d).otherwise(2 * d - 9)

    values = F.transform(F.split(F.reverse(number), "(?<=.)(?=.)"), value)
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Does an IBAN without spaces leave 1 when divided by 97?"""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step) == 1


def confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")
    if kind == "card":
        return luhn(digits(hit))
    if kind == "phone":
        return F.length(digits(hit)).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(hit, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~hit.rlike("^(?:000|666|9)|-00-|0000$")
    return F.lit(True)


def located(pieces: Column, hits: Column) -> Column:
    """``array<struct<start, end, hit, before>>`` from the matches and the texts between them.

    Places are running totals of lengths. They are built in groups, since building an array one by one
    copies it each time.
    """
    n = F.size(hits)
    parts = F.zip_with(
        F.slice(pieces, 1, n), hits,
        lambda p, h: F.struct(
            F.length(p).alias("gap"), F.length(h).alias("len"), h.alias("hit"), F.right(p, F.lit(NEARBY)).alias("before")
        ),
    )
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / GROUP).cast("int")), lambda g: F.slice(parts, g * GROUP + 1, F.lit(GROUP))
    )
    lengths = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda a, x: a + x["gap"] + x["len"]))
    starts = F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")),
        lambda a: a["all"],
    )
    empty = F.array().cast("array<struct<start: int, end: int, hit: string, before: string>>")

    def walk(group: Column, start: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            at, end = a["at"] + x["gap"], a["at"] + x["gap"] + x["len"]
            span = F.struct(at.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["before"].alias("before"))
            return F.struct(end.alias("at"), F.concat(a["all"], F.array(span)).alias("all"))

        return F.aggregate(group, F.struct(start.alias("at"), empty.alias("all")), step, lambda a: a["all"])

    return F.flatten(F.zip_with(groups, starts, walk))


def find_pii(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Append ``array<struct<start, kind, end, score>>``: confirmed spans by start, then kind (a place in
    ``KINDS``). Null and empty texts have none. A column of that name is replaced; repeated rows are alike.
    """
    kept = without(docs, spans)
    body = F.col(text)
    out = docs.select(*kept, body.rlike("[0-9]").alias("__digit"))

    def asked(k: Kind) -> Column:
        needs = F.contains(body, F.lit(k.needs)) if k.needs else F.lit(True)
        return needs if k.name == "email" else F.col("__digit") & needs

    out = out.select("*", *[
        F.when(asked(k), F.regexp_extract_all(body, F.lit(k.pattern), F.lit(0))).alias(f"__{k.name}_hits") for k in KINDS
    ])
    out = out.select("*", *[
        F.when(F.size(f"__{k.name}_hits") > 0, F.split(body, k.pattern, -1)).alias(f"__{k.name}_between") for k in KINDS
    ])
    empty = F.array().cast(SPAN)

    def scored(k: Kind) -> Column:
        found = F.filter(
            located(F.col(f"__{k.name}_between"), F.col(f"__{k.name}_hits")), lambda x: confirmed(k.name, x["hit"])
        )
        near = lambda x: F.lower(x["before"]).rlike(k.context)
        rated = F.transform(found, lambda x: F.struct(
            x["start"].alias("start"), F.lit(ORDER[k.name]).alias("kind"), x["end"].alias("end"),
            F.when(near(x), F.least(F.lit(1.0), F.lit(k.score + k.boost))).otherwise(F.lit(k.score)).alias("score"),
        ))
        if not k.base:
            rated = F.filter(rated, lambda x: x["score"] >= THRESHOLD)
        return F.coalesce(F.when(F.col(f"__{k.name}_between").isNotNull(), rated), empty)

    out = out.select(
        *kept,
        F.flatten(F.array(*[scored(k) for k in KINDS if k.base])).alias("__base"),
        F.flatten(F.array(*[scored(k) for k in KINDS if not k.base])).alias("__more"),
    )
    apart = F.when(F.size("__more") > 0, F.filter(
        "__more", lambda m: ~F.exists("__base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )).otherwise(empty)
    return out.select(*kept, F.array_sort(F.concat("__base", apart)).alias(spans))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
    )), ",")


def mask(docs: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Texts with each span replaced by its kind in angle brackets; of spans that overlap the first stays.
    Texts without spans, null ones too, stay as they are."""
    names = F.array(*[F.lit(f"<{k.name}>") for k in KINDS])
    body = F.col(text)

    def step(a: Column, s: Column) -> Column:
        clear = s["start"] >= a["at"]
        before = F.substr(body, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        return F.struct(
            F.greatest(a["at"], s["end"]).alias("at"),
            F.when(clear, F.concat(a["out"], F.array(before, F.element_at(names, s["kind"] + 1)))).otherwise(a["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    masked = F.aggregate(
        F.col(spans), start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(body, a["at"] + 1))
    )
    return docs.withColumn(text, F.when(F.size(spans) > 0, masked).otherwise(body))
