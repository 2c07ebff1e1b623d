"""Report text: mark stripping, line typing and table cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and expressions that Java, RE2 and DuckDB read alike.
# Whitespace and digits follow the Unicode classes used for report lines.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
DIGIT = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
BOLD = r"\*\*(.*?)\*\*"
ITALIC = r"\*(.*?)\*"
CODE = r"`(.*?)`"
NOT_LATIN1 = r"[^\x{00}-\x{ff}]"
RULE = "^-{3,}$"
SEPARATOR = rf"^\|[{SPACE}\-|:]+\|$"
NUMBERED = rf"^[{DIGIT}][.)]"

# In Java `.` stops at any line end; (?d) leaves only the line feed.
_JAVA = "(?d)"


def strip_edges(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


def strip_markup(text: Column) -> Column:
    """Text without bold, italic and code marks or non-Latin-1 characters.

    Expressions run only on text that has a mark or a character beyond ASCII.
    `text` should be a column, as it is read several times.
    """
    plain = text
    for mark in (BOLD, ITALIC, CODE):
        plain = F.regexp_replace(plain, F.lit(_JAVA + mark), F.lit("$1"))
    marked = F.contains(text, F.lit("*")) | F.contains(text, F.lit("`"))
    unmarked = F.when(marked, plain).otherwise(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, unmarked).otherwise(F.regexp_replace(unmarked, F.lit(NOT_LATIN1), F.lit("")))


def is_separator(line: Column) -> Column:
    """True for the line between a table's header and its rows."""
    return line.startswith("|") & line.rlike(SEPARATOR)


def line_kind(line: Column) -> Column:
    """Kind of one stripped line that is no separator; the order of the tests matters."""
    bullet = line.startswith("- ") | (line.startswith("* ") & ~line.startswith("**"))
    bold = line.startswith("**") & line.endswith("**") & (F.length(line) > 4)
    return (
        F.when(line == "", "blank")
        .when(line.startswith("---") & line.rlike(RULE), "rule")
        .when(line.startswith("### "), "heading3")
        .when(line.startswith("## "), "heading2")
        .when(line.startswith("# "), "heading1")
        .when(line.startswith("|"), "table_row")
        .when(bold, "bold")
        .when(bullet, "bullet")
        .when(F.substring(line, 1, 2).rlike(NUMBERED), "numbered")
        .otherwise("text")
    )


def line_body(line: Column, kind: Column) -> Column:
    """The text of a line after its prefix, marks still in place."""
    return (
        F.when(kind == "heading3", F.substr(line, F.lit(5)))
        .when(kind == "heading2", F.substr(line, F.lit(4)))
        .when(kind.isin("heading1", "bullet"), F.substr(line, F.lit(3)))
        .when(kind == "bold", F.substr(line, F.lit(3), F.length(line) - 4))
        .when(kind.isin("blank", "rule"), F.lit(""))
        .otherwise(line)
    )


def shown_cells(line: Column) -> Column:
    """Trimmed, non-empty parts of a table row."""
    return F.filter(F.transform(F.split(line, r"\|"), strip_edges), lambda c: c != "")
