"""Text units: decimal rounding, tokens, and the digit place of every token."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A decimal number, a run of digits and dots, and one token.
DECIMAL = r"[0-9]*\.[0-9]+"
PIECE = r"[0-9]*\.[0-9]+|[0-9]+|\.|[^0-9.]+"
NUMBER_RUN = r"[0-9]+(?:[.][0-9]*)?|[.]+|[^0-9.]+"
TOKEN = r"[0-9]|\p{L}+|[^\s\p{L}]"

# Digit places; ones = 6, tens = 7, the point = 5, tenths = 4, other tokens = 0.
POINT_PLACE = 5


def text_literal(text: str) -> str:
    """A text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """A column by its exact name, which may hold dots or blanks."""
    return F.col(f"`{name}`")


def quoted(pattern: str) -> str:
    """A pattern as a raw SQL string literal."""
    return f"r'{pattern}'"


def round_decimals(text: str) -> Column:
    """Every decimal number in a text rounded to 4 places, printed without spare zeros.

    The rule is decimal, half up on the written digits; it looks at the fifth decimal alone, so
    nothing is rounded twice.  Numbers of more than 33 digits before the point stay as they are.
    ``text`` is SQL.  Plain numbers and texts without a decimal number take no lambda.
    """

    def shorten(piece: str) -> str:
        five = f"regexp_extract({piece}, {quoted('^[0-9]*[.][0-9]{1,5}')}, 0)"
        rounded = f"CAST(round(try_cast({five} AS DECIMAL(38, 5)), 4) AS STRING)"
        trimmed = "regexp_replace({0}, {1}, '$1')".format(rounded, quoted(r"(\.[0-9]+?)0+$"))
        return f"coalesce({trimmed}, {piece})"

    whole = quoted(f"^{DECIMAL}$")
    pieces = f"regexp_extract_all({text}, {quoted(PIECE)}, 0)"
    rewritten = f"array_join(transform({pieces}, p -> CASE WHEN p RLIKE {whole} THEN {shorten('p')} ELSE p END), '')"
    return F.expr(
        f"CASE WHEN NOT contains({text}, '.') THEN {text} WHEN {text} RLIKE {whole} THEN {shorten(text)} "
        f"WHEN {text} RLIKE {quoted(DECIMAL)} THEN {rewritten} ELSE {text} END"
    )


def token_list(text: str) -> Column:
    """Words, single digits, single points and single symbols of a text (SQL), in order."""
    return F.expr(tokens_sql(text))


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all({text}, {quoted(TOKEN)}, 0)"


def digit_places(text: str, tokens: str | None = None) -> Column:
    """One digit place per token of the same text (SQL); only mixed texts take a lambda.

    ``tokens`` (SQL) is the text's token list where that is known already.
    """

    def zeros(run: str) -> str:
        return f"array_repeat(0, size({tokens_sql(run)}))"

    plain = f"array_repeat(0, size({tokens}))" if tokens else zeros(text)
    runs = f"regexp_extract_all({text}, {quoted(NUMBER_RUN)}, 0)"
    mixed = f"flatten(transform({runs}, r -> CASE WHEN r RLIKE '^[0-9]' THEN {number_places('r')} ELSE {zeros('r')} END))"
    return F.expr(
        f"CASE WHEN NOT {text} RLIKE '[0-9.]' THEN {plain} "
        f"WHEN {text} RLIKE {quoted('^[0-9]+([.][0-9]*)?$')} THEN {number_places(text)} ELSE {mixed} END"
    )


def number_places(run: str) -> str:
    """Places (SQL) of a run of digits with at most one point, counted from the ones."""
    whole = f"(CASE WHEN instr({run}, '.') > 0 THEN instr({run}, '.') - 1 ELSE length({run}) END)"
    return f"sequence({whole} + {POINT_PLACE}, {whole} + {POINT_PLACE + 1} - length({run}), -1)"


# Units of typed values: the same as those of their text, without a pattern.


def kind_of(type_: T.DataType) -> str:
    """How a value's unit is made: "integer", "decimal", "date", or "text" for all others."""
    if isinstance(type_, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(type_, T.DecimalType) and type_.precision - type_.scale <= 33:
        return "decimal" if type_.scale else "integer"
    return "date" if isinstance(type_, T.DateType) else "text"


def rounded_decimal(value: str) -> Column:
    """A decimal (SQL) as ``round_decimals`` prints its text."""
    digits = f"rtrim('0', CAST(round({value}, 4) AS STRING))"
    return F.expr(f"CASE WHEN endswith({digits}, '.') THEN concat({digits}, '0') ELSE {digits} END")


def characters(text: str) -> Column:
    """Tokens of a printed number or date (SQL): every character is one."""
    return F.expr(f"split({text}, '')")


def typed_places(text: str, kind: str) -> Column:
    """Digit places of a printed number or date (SQL), cut from a fixed falling row; a sign has none."""
    sign = f"CAST(startswith({text}, '-') OR startswith({text}, '+') AS INT)"
    length = f"length({text}) - {sign}"
    if kind == "date":
        whole = f"{length} - 6"
    elif kind == "decimal":
        whole = f"instr({text}, '.') - 1 - {sign}"
    else:
        whole = length
    digits = f"slice({_FALLING}, {_MOST} + 1 - ({whole}), {whole if kind == 'date' else length})"
    if kind == "date":
        digits = f"concat({digits}, array(0, 7, 6, 0, 7, 6))"
    return F.expr(f"CASE WHEN {sign} = 1 THEN concat(array(0), {digits}) ELSE {digits} END")


#: Most digits before the point of a typed value, and the places from there to the last digit that one can have.
_MOST = 40
_FALLING = f"array({', '.join(str(p + POINT_PLACE) for p in range(_MOST, -_MOST, -1))})"


def constant_unit(text: str) -> tuple[list[str], list[int]]:
    """Tokens and digit places of a constant, such as a table or column name."""

    def shorten(found: re.Match) -> str:
        rounded = Decimal(found.group()).quantize(Decimal("0.0001"), ROUND_HALF_UP)
        return re.sub(r"(\.[0-9]+?)0+$", r"\1", str(rounded))

    tokens, places = [], []
    for run in re.findall(NUMBER_RUN, re.sub(DECIMAL, shorten, text)):
        found = re.findall(r"[0-9]|[^\W\d_]+|\S", run)
        top = (run.index(".") if "." in run else len(run)) + POINT_PLACE
        tokens += found
        places += [top - i for i in range(len(found))] if run[0].isdigit() else [0] * len(found)
    return tokens, places
