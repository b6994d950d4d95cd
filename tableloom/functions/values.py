"""Printed cell values: what a token means and which number it stands for.  Values stay text; numbers are added beside them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What a printed token can be instead of a number, by operator.
GRID_TEXT = ["", "-", "–", "—", "n.m.", "nm", "NA", "N/A"]
POINT_TEXT = [*GRID_TEXT, "?"]
SCORE_NOTHING = ["", "-", "–", "—", "n.m.", "nm", "na", "n/a", "#", "none"]
GRID_DASHES = ["-", "–", "—", "‐", "‑", "‒", "−"]
STRING_DASHES = ["-", "–", "—"]
POINT_DASHES = ["-", "–", "—", "−"]
CELL_STATES = ["reported", "nil", "empty", "grey", "zero"]
ROW_TYPES = ["section_header", "data", "total", "sub_header", "note"]

SPACE = r"[\s ]"
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
PLACEHOLDER = "^(TBD|XXX+|TEST|ILLEGIBLE|MISSING|UNKNOWN|PLACEHOLDER)$"


def stripped(value: Column) -> Column:
    """Without white space at both ends, no-break spaces included."""
    return F.regexp_replace(value, rf"^{SPACE}+|{SPACE}+$", "")


def as_number(text: Column) -> Column:
    """The number that plain ASCII digits spell, else null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _parenthesised(text: Column) -> tuple[Column, Column]:
    """Whether text is in parentheses, and what is in them."""
    neg = text.startswith("(") & text.endswith(")") & (F.length(text) > 1)
    return neg, F.when(neg, F.substr(text, F.lit(2), F.length(text) - 2)).otherwise(text)


def _signed(neg: Column, number: Column) -> Column:
    return F.when(neg, -number).otherwise(number)


def grid_number(value: Column) -> Column:
    """A grid cell's number: thousands separators dropped, parentheses negative, percentages left as text."""
    s = stripped(value)
    neg, core = _parenthesised(F.replace(s, F.lit(","), F.lit("")))
    return F.when(~s.isin(GRID_TEXT) & ~s.endswith("%"), _signed(neg, as_number(core)))


def point_number(value: Column) -> Column:
    """As for a grid cell; multiples and basis points are text too, plus signs are dropped."""
    s = stripped(value)
    neg, core = _parenthesised(F.replace(s, F.lit(","), F.lit("")))
    text = s.isin(POINT_TEXT) | s.endswith("%") | s.endswith("bps") | s.endswith("x")
    return F.when(~text, _signed(neg, as_number(F.replace(core, F.lit("+"), F.lit("")))))


def lenient_number(value: Column) -> Column:
    """A point's magnitude: separators, plus signs and a trailing per cent sign dropped, parentheses negative."""
    neg, core = _parenthesised(stripped(value))
    return _signed(neg, as_number(F.regexp_replace(F.regexp_replace(core, "[,+]", ""), "%+$", "")))


def review_number(value: Column) -> Column:
    """A number for arithmetic checks; null, blank and dash aren't any."""
    s = F.replace(stripped(value), F.lit(","), F.lit(""))
    neg, core = _parenthesised(s)
    return F.when(~value.isin("", "-"), as_number(F.regexp_replace(F.when(neg, F.concat(F.lit("-"), core)).otherwise(s), "%+$", "")))


def score_value(value: Column) -> Column:
    """struct(num, txt) to compare by: a number, else lower-case text; both null where nothing is printed."""
    s = stripped(value)
    neg, core = _parenthesised(F.trim(F.replace(F.regexp_replace(s, "%+$", ""), F.lit(","), F.lit(""))))
    num = F.when(~F.lower(s).isin(SCORE_NOTHING), _signed(neg, as_number(core)))
    return F.struct(num.alias("num"), F.when(~F.lower(s).isin(SCORE_NOTHING) & num.isNull(), F.lower(s)).alias("txt"))


def integral(number: Column) -> Column:
    """The number as a long if it has no fraction, else null."""
    return F.when((number == F.floor(number)) & (F.abs(number) < 2**53), number.cast("long"))


def significant(number: Column, digits: int = 4) -> Column:
    """A number rounded to so many significant digits, halves to even, as the shortest decimal text does it."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(number))))
    return F.when(number == 0, F.lit(0.0)).otherwise(F.rint(number * scale) / scale)


def comparable(value: Column) -> Column:
    """A value to compare two extractions by: four significant digits if it is a number, else lower-case text."""
    s = stripped(F.coalesce(value, F.lit("")))
    num = as_number(F.regexp_replace(s, "[,%]", ""))
    return F.coalesce(significant(num).cast("string"), F.lower(s))


def status(value: Column, row_type: Column, suppressed: Column) -> Column:
    """Why a point has a number or has none; the row's role comes first, then a flag, then the token."""
    s = stripped(F.coalesce(value, F.lit("")))
    return (
        F.when(row_type == "section_header", "section_header")
        .when(suppressed, "suppressed")
        .when(s.isin(POINT_DASHES), "nil")
        .when(s == "#", "rounds_to_zero")
        .when(s == "", "not_disclosed")
        .otherwise("reported")
    )


def status_number(value: Column, status: Column) -> Column:
    """A point's number under its status: dashes and amounts that round to nothing are zeros, absent ones null.

    Reported values are always parsed, on the first pass as on later ones.
    """
    return F.when(status.isin("nil", "rounds_to_zero"), F.lit(0.0)).when(status == "reported", lenient_number(value))


def cell_from_text(text: Column) -> Column:
    """struct(value, cell_state) of a plain string."""
    s = stripped(text)
    state = F.when(s.isin(STRING_DASHES), "nil").when(s == "0", "zero").when(s == "", "empty").otherwise("reported")
    return F.struct(F.when(state == "nil", "-").otherwise(s).alias("value"), state.alias("cell_state"))


def current_state(state: Column) -> Column:
    """A cell state under its present name; null is reported."""
    return F.when(state == "suppressed", "grey").when(state == "rounds_to_zero", "reported").otherwise(F.coalesce(state, F.lit("reported")))


def normal_cell(cell: Column) -> Column:
    """A cell whose printed dash is nil and whose printed 0 is zero, whatever state it came with."""
    s = stripped(cell["value"])
    value = F.when(s.isin(GRID_DASHES), "-").otherwise(cell["value"])
    state = F.when(s.isin(GRID_DASHES), "nil").when(s == "0", "zero").otherwise(current_state(cell["cell_state"]))
    return F.struct(value.alias("value"), state.alias("cell_state"))


def valid_state(state: Column) -> Column:
    return state.isin(CELL_STATES)


def is_printed_number(text: Column) -> Column:
    """Whether a word is a dash or a number as tables print it: with separators, decimals, a per cent sign or in parentheses."""
    return F.trim(text).rlike(r"^-$|^[0-9,]+([.][0-9]+)?%?$|^\([0-9,]+\)$")


def is_numeric_cell(value: Column) -> Column:
    """Blank, or a number once separators, dashes and parentheses are gone."""
    s = F.regexp_replace(F.coalesce(value, F.lit("")), r"[,\-()\s]", "")
    return (s == "") | as_number(s).isNotNull()


def is_empty(value: Column) -> Column:
    return F.coalesce(F.trim(value), F.lit("")).isin("", "-")


def equal_values(a: Column, b: Column, tol: float = 0.51) -> Column:
    """Whether two score values agree: numbers within tol or a thousandth of the first, texts exactly."""
    near = (F.abs(a["num"] - b["num"]) <= tol) | ((a["num"] != 0) & (F.abs(a["num"] - b["num"]) <= 0.001 * F.abs(a["num"])))
    return F.coalesce(near, a["txt"] == b["txt"], F.lit(False))


def bridge_amount(number: Column, sign: Column) -> Column:
    """A bridge step's amount: its sign field decides over the printed sign."""
    return F.when(sign == "+", F.abs(number)).when(sign == "-", -F.abs(number)).otherwise(F.coalesce(number, F.lit(0.0)))


def cell_flag(value: Column) -> Column:
    """What a reviewer must look at in a cell, else null."""
    s = F.upper(F.trim(value))
    return F.when(s == "ILLEGIBLE", "ILLEGIBLE").when(s.startswith("CONFLICT:"), "CONFLICT").when(s.rlike(PLACEHOLDER), "PLACEHOLDER")


def all_zero(values: Column, least: int = 3) -> Column:
    """Whether an array of numbers (nulls left out) has so many and all are zero."""
    numbers = F.filter(values, lambda x: x.isNotNull())
    return (F.size(numbers) >= least) & F.forall(numbers, lambda x: x == 0)


def self_check(text: Column, tol: float = 5.0) -> Column:
    """array of struct(equation, delta, ok) of the sums and products written in a self-check.

    Equations are separated by semicolons; each has a left side of numbers joined by + - * and a right side of one
    number, or the other way round.  Nothing is evaluated as code.  delta and ok are null where an equation can't
    be read.
    """
    body = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\[[^\]]*\]\s*", "")
    parts = F.filter(F.transform(F.split(body, ";"), lambda e: F.trim(e)), lambda e: e != "")

    def factor(t: Column) -> Column:
        return F.aggregate(F.split(t, r"\*"), F.lit(1.0), lambda a, x: a * as_number(F.trim(x)))

    def side(s: Column) -> Column:
        plain = F.regexp_replace(s, r"[,\s]", "")
        terms = F.filter(F.split(F.regexp_replace(plain, r"(?<=[0-9.])-", "+-"), r"\+"), lambda t: t != "")
        return F.when(plain.rlike(r"^[-+]?[0-9.]+([-+*][-+]?[0-9.]+)*$"), F.aggregate(terms, F.lit(0.0), lambda a, t: a + factor(t)))

    def one(e: Column) -> Column:
        sides = F.split(e, "=")
        delta = F.when(F.size(sides) == 2, F.abs(side(F.get(sides, F.lit(0))) - side(F.get(sides, F.lit(1)))))
        return F.struct(e.alias("equation"), delta.alias("delta"), (delta <= tol).alias("ok"))

    return F.transform(parts, one)
