"""Parsing and cleaning of source texts as column expressions; NULL gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted stamp formats in order of trial, and words for true and false.
STAMP_FORMATS = ("yyyy-M-d H:m:s", "yyyy-M-d", "M/d/yyyy H:m:s", "M/d/yyyy", "M/d/yy H:m:s", "M/d/yy", "yyyy-M-d'T'H:m:s")
TRUE_WORDS = ("1", "-1", "true", "t", "y", "yes")
FALSE_WORDS = ("0", "false", "f", "n", "no")
CODE_LABELS = {"B": " (start of range)", "E": " (end of range)"}
LEAKED = r"<\|[^|>\n]*\|>|【|】|\bto=functions\."  # fixed value: marks of chat templates and raw tool calls
DOCUMENT_ID, NATIONAL_ID = r"\b([LA]\d{5})\b", r"\bNCD\s*(\d+(?:\.\d+)*)"  # fixed values: forms of public ids in a text
STATUS_LABELS = {"A": "active", "R": "retired", "P": "proposed"}


def clean(c: Column) -> Column:
    """Without NUL characters and blanks of any kind at the ends; empty is NULL."""
    t = F.regexp_replace(F.regexp_replace(c, "\u0000", ""), r"(?U)^\s+|\s+$", "")
    return F.when(t != "", t)


def stamp(c: Column) -> Column:
    """Timestamp by the first format that fits; two-digit years from 69 on are 19xx."""
    t = clean(c)
    tries = []
    for f in STAMP_FORMATS:
        got = F.try_to_timestamp(t, F.lit(f))
        short = "yy" in f and "yyyy" not in f
        tries.append(F.when(F.year(got) >= 2069, F.add_months(F.to_date(got), -1200).cast("timestamp")).otherwise(got) if short else got)
    return F.coalesce(*tries)


def day(c: Column) -> Column:
    return F.to_date(stamp(c))


def whole(c: Column) -> Column:
    """Integer part of a number; anything else, infinite and out of range included, is NULL."""
    return clean(c).try_cast("double").try_cast("int")


def flag(c: Column) -> Column:
    t = F.lower(clean(c))
    return F.when(t.isin(*TRUE_WORDS), True).when(t.isin(*FALSE_WORDS), False)


def first_char(c: Column) -> Column:
    return F.substring(clean(c), 1, 1)


def url(c: Column) -> Column:
    t = clean(c)
    return F.when(~F.lower(t).isin("http://", "https://"), t)


def tidy_lines(c: Column) -> Column:
    """One blank for runs of them, no zero-width blanks, at most one empty line, list items together."""
    t = F.regexp_replace(F.regexp_replace(c, "\r\n?", "\n"), "[​]", "")
    t = F.regexp_replace(F.translate(t, " ", " "), r"[ \t\f\x0B]+", " ")
    t = F.regexp_replace(F.regexp_replace(t, r"(?m)^ | $", ""), r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r"(?m)(^- [^\n]*)\n\n(?=- )", "$1\n")
    return clean(t)


def public_id(c: Column) -> Column:
    """Upper case; `NCD` or a bare number with dots becomes `NCD x.y`."""
    t = F.upper(clean(c))
    n = F.regexp_extract(t, r"^(?:NCD)?\s*(\d+(?:\.\d+)*)$", 1)
    return F.when(n != "", F.concat(F.lit("NCD "), n)).otherwise(t)


def mentioned_ids(c: Column) -> Column:
    """Distinct public ids named in a text, sorted."""
    docs = F.transform(F.regexp_extract_all(c, F.lit("(?i)" + DOCUMENT_ID), F.lit(1)), F.upper)
    ncd = F.transform(F.regexp_extract_all(c, F.lit("(?i)" + NATIONAL_ID), F.lit(1)), lambda x: F.concat(F.lit("NCD "), x))
    return F.array_sort(F.array_distinct(F.concat(docs, ncd)))


def leaked_markup(c: Column) -> Column:
    """Distinct marks that a text should not show, sorted; none for NULL."""
    return F.coalesce(F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(LEAKED), F.lit(0)))), F.array().cast("array<string>"))


def code_candidates(code: str, system: str | None = None) -> list[str]:
    """A code as written, and with the dot of a diagnosis code."""
    c = code.strip().upper()
    dotted = [f"{c[:3]}.{c[3:]}"] if "." not in c and len(c) > 3 and system in (None, "ICD10CM") else []
    return [c, *dotted]


def code_line(code: Column, description: Column, range_pos: Column) -> Column:
    mark = F.when(range_pos == "B", CODE_LABELS["B"]).when(range_pos == "E", CODE_LABELS["E"]).otherwise("")
    return F.concat(F.concat_ws(" - ", code, description), mark)


def tokens_estimate(heading: Column, content: Column) -> Column:
    n = F.coalesce(F.length(heading), F.lit(0)) + F.coalesce(F.length(content), F.lit(0))
    return F.greatest(F.lit(1), F.floor(n / 4).cast("int"))


def content_hash(heading: Column, content: Column) -> Column:
    return F.sha2(F.concat_ws("\n", heading, content), 256)


def lexemes(c: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(c), r"[^a-z0-9]+"), lambda x: x != "")


def label(c: Column, names: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(m[c], c)
