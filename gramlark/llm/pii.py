"""Personal data: exact base patterns, and bootstrapped contexts that find more.

Base matches are the seeds.  The word before a seed is a lexical pattern; a
pattern is as reliable as the share of all its followers in the corpus that are
known identifiers, and a value as the most reliable pattern that introduces it.
Both are scored in turn on the pattern-instance graph; tokens with digits or an
``@`` that follow a reliable pattern are reported with the seeds' kind.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramlark.llm.common import column_map, unused
from gramlark.session import stage

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  The look-behind and the possessive loops
# only keep long runs of one class from being tried again and again.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
MARKED = re.compile(r"[0-9@]")
BLANKS = " \t\n\r"


def _emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            end = tail.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for c in digits[-2::-2]:
        d = 2 * int(c)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns as (kind, start, end), by kind as in ``KINDS``, then start."""
    out = [("email", s, e) for s, e in _emails(text)]
    if not DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        parts = [g.lstrip("0") for g in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = "".join(DIGITS.findall(m[0]))
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
            out.append(("phone", *m.span()))
    return out


def _word_before(text: str, at: int) -> str:
    end = at
    while end > 0 and text[end - 1] in BLANKS:
        end -= 1
    start = max(text.rfind(c, 0, end) for c in BLANKS) + 1
    return text[start:end]


def occurrences(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, str | None, int, int]]:
    """(pattern, value, kind, start, end) of every seed and every other marked token.

    The pattern of a token is the word before it.  In ``name=value`` it is
    ``name=`` and the value is what follows.
    """
    out = [(_word_before(text, s), text[s:e], kind, s, e) for kind, s, e in spans]
    taken = sorted((s, e) for _, s, e in spans)
    k = at = 0
    while m := MARKED.search(text, at):
        i = m.start()
        while k < len(taken) and taken[k][1] <= i:
            k += 1
        if k < len(taken) and taken[k][0] <= i:
            at = taken[k][1]
            continue
        low = taken[k - 1][1] if k else 0
        high = taken[k][0] if k < len(taken) else len(text)
        start = max(low, max(text.rfind(c, low, i) for c in BLANKS) + 1)
        end = min([p for c in BLANKS if (p := text.find(c, i, high)) >= 0], default=high)
        cut = text.find("=", start, end)
        if start < cut < end - 1:
            pattern, start = text[start : cut + 1], cut + 1
        else:
            pattern = _word_before(text, start)
        while end > start + 1 and text[end - 1] in ".,;:!?)\"'":
            end -= 1
        while start < end - 1 and text[start] in "(\"'":
            start += 1
        out.append((pattern, text[start:end], None, start, end))
        at = max(end, i + 1)
    return out


def scan(docs: DataFrame, column: str = "text"):
    """Struct column with ``spans`` and ``seen`` (both arrays of structs) of every whole text."""

    def make():
        def each(texts: pd.Series) -> pd.DataFrame:
            spans = [base_spans(t or "") for t in texts]
            return pd.DataFrame({"spans": spans, "seen": [occurrences(t or "", s) for t, s in zip(texts, spans)]})

        return each

    span = "struct<kind:string,`start`:int,`end`:int>"
    seen = "struct<pattern:string,value:string,kind:string,`start`:int,`end`:int>"
    return column_map(docs, column, f"spans array<{span}>, seen array<{seen}>", make)


def reliable_patterns(
    seen: DataFrame,
    docs: DataFrame,
    support: int = 3,
    threshold: float = 0.5,
    rounds: int = 3,
    column: str = "text",
) -> DataFrame:
    """``(pattern, kind, reliability)`` above ``threshold``, from occurrences ``seen``.

    Only patterns before at least ``support`` different seeds of a kind take
    part.  Copies of a text add to a pattern's followers and to its seeds alike.
    The followers of a pattern are counted over all words of ``docs``.
    """
    pattern = F.lower("pattern").alias("pattern")
    edges = seen.select(pattern, "value", "kind").groupBy("pattern", "value", "kind").agg(F.count("*").alias("n"))
    edges = stage(edges.where("pattern <> ''"), "pattern-edges")
    seeds = edges.where("kind IS NOT NULL")
    kept = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).where(F.col("seeds") >= support)
    kept = stage(kept, "patterns")
    words = docs.select(F.explode(F.split(F.lower(column), r"[ \t\n\r]+")).alias("pattern"))
    cut = F.concat(F.substring_index("pattern", "=", 1), F.lit("="))
    words = words.select(F.when(F.col("pattern").rlike("^[^=]+=[^=]"), cut).otherwise(F.col("pattern")).alias("pattern"))
    total = words.join(kept.select("pattern").distinct(), "pattern", "left_semi")
    total = stage(total.groupBy("pattern").agg(F.count("*").alias("total")), "followers")
    followed = edges.drop("kind").join(kept.select("pattern", "kind"), "pattern").join(total, "pattern")
    score = seeds.select("value", "kind", F.lit(1.0).alias("score")).distinct()
    for _ in range(rounds):
        mass = followed.join(score, ["value", "kind"], "left").groupBy("pattern", "kind", "total")
        mass = mass.agg(F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))).alias("mass"))
        rated = mass.select("pattern", "kind", F.least(F.lit(1.0), F.col("mass") / F.col("total")).alias("reliability"))
        found = followed.join(rated, ["pattern", "kind"]).groupBy("value", "kind").agg(F.max("reliability").alias("score"))
        known = seeds.select("value", "kind", F.lit(1.0).alias("score")).distinct()
        score = known.unionByName(found).groupBy("value", "kind").agg(F.max("score").alias("score"))
    return rated.where(F.col("reliability") >= threshold)


def find(docs: DataFrame, row: Column | None = None, **how) -> DataFrame:
    """``(row_id, doc_id, base, spans)`` for every row of ``docs``: base and all spans.

    Spans are ordered by kind, then start, in code points, end exclusive; a null
    text is an empty one and has none.  Repeated rows are reported each.
    ``row_id`` is ``row``, a stored number of each row, or else the row's place in
    this scan, which another scan need not repeat.  Texts are read once in Python;
    what is kept of them is written and all joins are by ``row_id`` or pattern.
    """
    row = F.monotonically_increasing_id() if row is None else row
    marked = docs.select(row.alias("row_id"), "doc_id", scan(docs).alias("out"))
    marked = marked.select("row_id", "doc_id", "out.spans", "out.seen")
    marked = stage(marked, "identifiers")
    seen = marked.select("row_id", F.explode("seen").alias("o")).select("row_id", "o.*")
    good = reliable_patterns(seen.drop("row_id"), docs, **how)
    best = good.groupBy("pattern").agg(F.max_by("kind", F.struct("reliability", "kind")).alias("kind"))
    new = seen.where("kind IS NULL").drop("kind").withColumn("pattern", F.lower("pattern")).join(best, "pattern")
    new = new.groupBy("row_id").agg(F.collect_list(F.struct("kind", F.col("start"), F.col("end"))).alias("more"))
    both = marked.join(new, "row_id", "left")
    every = F.concat("spans", F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,end:int>>")))
    keyed = F.transform(
        every,
        lambda x: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            x["kind"].alias("kind"),
        ),
    )
    ordered = F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return both.select("row_id", "doc_id", F.col("spans").alias("base"), ordered.alias("spans"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span replaced by its kind in brackets; of overlapping ones the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with base and discovered identifiers in ``text`` replaced; all other columns as they are.

    Rows are numbered once, in a written copy that both the search and the final
    join read.
    """
    row, added = unused(docs.columns, "row"), unused(docs.columns, "added")
    rows = stage(docs.select("*", F.monotonically_increasing_id().alias(row)), "numbered")
    found = find(rows, F.col(row), **how)
    more = F.filter("spans", lambda s: ~F.array_contains("base", s))
    extra = stage(found.select(F.col("row_id").alias(row), more.alias(added)).where(F.size(added) > 0), "more")

    def with_spans(frame: DataFrame, column) -> DataFrame:
        @F.pandas_udf("string")
        def clean(texts: pd.Series, more: pd.Series) -> pd.Series:
            return pd.Series(
                [
                    t if t is None else redact(t, base_spans(t) + [(s["kind"], s["start"], s["end"]) for s in m])
                    for t, m in zip(texts, more)
                ],
                dtype=object,
            )

        return frame.withColumn("text", clean("text", column))

    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    joined = rows.join(extra, row, "left")
    return with_spans(joined, F.coalesce(added, none)).select(docs.columns)
