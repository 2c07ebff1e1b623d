"""Report text against a plain line-by-line reading."""

from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowgauge.functions import markup
from flowgauge.plans.report_text import report_lines, stripped_texts, table_cells


def _strip(text):
    for mark in (r"\*\*(.*?)\*\*", r"\*(.*?)\*", r"`(.*?)`"):
        text = re.sub(mark, r"\1", text)
    return "".join(c for c in text if ord(c) < 256)


def _kind(s):
    tests = [
        ("blank", not s), ("rule", re.fullmatch("-{3,}", s)), ("heading3", s[:4] == "### "), ("heading2", s[:3] == "## "),
        ("heading1", s[:2] == "# "), ("separator", re.match(r"^\|[\s\-|:]+\|$", s)), ("table_row", s[:1] == "|"),
        ("bold", s[:2] == "**" and s[-2:] == "**" and len(s) > 4), ("bullet", s[:2] in ("- ", "* ")),
        ("numbered", len(s) > 1 and s[0].isdigit() and s[1] in ".)"),
    ]
    return next((name for name, hit in tests if hit), "text")


def _body(s, kind):
    cut = {"heading3": 4, "heading2": 3, "heading1": 2, "bullet": 2}.get(kind, 0)
    return _strip("" if kind in ("blank", "rule") else s[2:-2] if kind == "bold" else s[cut:])


SAMPLE = (
    "\n---\n-- -\n# a\n## b `c`\n### d **e**\n####x\n|a|b|\n|---|:-:|\n| **x** | | yyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyyy |\n"
    "|||\n| - |\n**bold**\n****\n**a** and **b**\n- one\n* two\n** three\n-four\n1. a\n2) b\n3 c\n²) d\n٣. e\n"
    "　wide  \n\x1c|q|\x1f\n*a **b* c**\nüñ ✅ é\n` a * b ` c *\nline two\r"
)


def _check(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    lines = [(i, s.strip()) for i, s in enumerate(text.split("\n"))]
    typed = [(i, _kind(s), s) for i, s in lines]
    expected = [(i, k, _body(s, k)) for i, k, s in typed if k != "separator"]
    got = sorted((r.line_no, r.kind, r.body) for r in report_lines(df, "doc_id").collect())
    assert got == sorted(expected)
    cells, head_due = [], True
    for i, k, s in typed:
        found = [c.strip() for c in s.split("|") if c.strip()] if k == "table_row" else []
        cells += [(i, j, _strip(c), _strip(c)[:30], head_due) for j, c in enumerate(found)]
        head_due = (head_due and not found) if k in ("table_row", "separator") else True
    got = sorted((r.line_no, r.cell_no, r.cell, r.shown, r.is_header) for r in table_cells(df, "doc_id", 30).collect())
    assert got == cells
    assert stripped_texts(df, "doc_id").first().text == _strip(text)


def test_sample_lines(spark):
    _check(spark, SAMPLE)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="ab1.)*`#-|: \t\n\r\x85 é✅²", max_size=80))
def test_any_lines(spark, text):
    _check(spark, text)


def test_whitespace_and_digits_are_complete():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert {c for c in every if c.isspace()} == set(markup.WHITESPACE)


def test_digits_follow_unicode(spark):
    # Java knows digits up to its own Unicode version; newer ones are left out.
    import unicodedata

    digits = [chr(c) for c in range(0x10000) if chr(c).isdigit() and unicodedata.category(chr(c)) in ("Nd", "No")]
    others = [c for c in "½①a٪" if not c.isdigit()]
    df = spark.createDataFrame([(i, f"{c}. x") for i, c in enumerate([*digits, *others])], "doc_id long, text string")
    numbered = {r.doc_id for r in report_lines(df, "doc_id").filter("kind = 'numbered'").collect()}
    assert numbered == set(range(len(digits)))
