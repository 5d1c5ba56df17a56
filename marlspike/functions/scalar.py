"""Cleaning and encoding expressions: Column in, Column out, no Python rows.

Code 0 always means "missing or unknown".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode blank: ASCII space characters, every Unicode separator (U+3000 too)
# and the four information separators.
BLANK_PATTERN = r"^[\s\p{Z}\x0b\x1c-\x1f]*$"
DATE_PATTERN = r"\d{4}-\d{2}-\d{2}"
MAX_INT = 2147483647


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    return _col(c).isNull() | _col(c).rlike(BLANK_PATTERN)


def blank_to(c: Column | str, default: str) -> Column:
    """Null or whitespace-only text becomes default; other text is not trimmed."""
    return F.when(is_blank(c), F.lit(default)).otherwise(_col(c))


def safe_cast(c: Column | str, data_type: str) -> Column:
    """Cast that gives null on junk, with ANSI mode on or off."""
    return _col(c).try_cast(data_type)


def clean_int(c: Column | str, junk: str = "\\&quot;") -> Column:
    """Integer text after removing a literal junk fragment; null or junk is 0."""
    return F.coalesce(safe_cast(F.replace(_col(c), F.lit(junk), F.lit("")), "int"), F.lit(0))


def remap(c: Column | str, mapping: Mapping) -> Column:
    """Replace the listed values, keep the rest; null stays null."""
    c = _col(c)
    chain = reduce(
        lambda acc, kv: acc.when(c == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F
    )
    return chain.otherwise(c)


def encode_dict(c: Column | str, mapping: Mapping[str, int], default: int = 0) -> Column:
    """Dictionary code of an exact value; anything else, null too, is default."""
    c = _col(c)
    chain = reduce(
        lambda acc, kv: acc.when(c == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F
    )
    return chain.otherwise(F.lit(default))


def extract_number(c: Column | str, pattern: str) -> Column:
    """First match of pattern as a double, null when there is none."""
    return safe_cast(F.regexp_extract(_col(c), pattern, 0), "double")


def truncate_int(c: Column | str) -> Column:
    """Double to int toward zero, saturating at the int range; null stays null."""
    c = _col(c)
    high, low = F.lit(MAX_INT), F.lit(-MAX_INT - 1)
    return F.when(c >= high, high).when(c <= low, low).otherwise(c.try_cast("int"))


def bucketize(
    c: Column | str,
    edges: Sequence[float],
    codes: Sequence[int],
    closed: str = "left",
    default: int | None = 0,
) -> Column:
    """Interval code of a number.

    closed="left" cuts with value < edge, closed="right" with value <= edge;
    codes has one more entry than edges. Null gives default.
    """
    if len(codes) != len(edges) + 1 or list(edges) != sorted(edges):
        raise ValueError("edges must ascend and codes must be one longer than edges")
    if closed not in ("left", "right"):
        raise ValueError("closed is 'left' or 'right'")
    c = _col(c)
    chain = F.when(c.isNull(), F.lit(default).cast("int"))
    for edge, code in zip(edges, codes):
        below = c < F.lit(edge) if closed == "left" else c <= F.lit(edge)
        chain = chain.when(below, F.lit(code))
    return chain.otherwise(F.lit(codes[-1]))


def keep_between(c: Column | str, low: int, high: int, default: int = 0) -> Column:
    """The value itself inside [low, high], default outside; null stays null."""
    c = _col(c)
    return F.when(c.isNull() | c.between(low, high), c).otherwise(F.lit(default))


def date_bucket(
    c: Column | str, edges: Sequence[int], codes: Sequence[int], key: str = "year"
) -> Column:
    """Interval code of the first yyyy-mm-dd in a text, compared as its year
    (key="year") or as the number yyyymmdd (key="yyyymmdd"). No date is 0."""
    found = F.regexp_extract(_col(c), DATE_PATTERN, 0)
    if key == "year":
        number = safe_cast(F.substring(found, 1, 4), "int")
    elif key == "yyyymmdd":
        number = safe_cast(F.replace(found, F.lit("-"), F.lit("")), "int")
    else:
        raise ValueError("key is 'year' or 'yyyymmdd'")
    return bucketize(number, edges, codes, closed="left", default=0)


def count_code(c: Column | str, which: str) -> Column:
    """Code of a "total-ok" count pair: which="ok" codes the second number,
    which="failed" the first minus the second.

    0..4 give 1..5, five or more 6, negative 7; blank or malformed gives 0.
    """
    parts = F.split(_col(c), "-")
    total = safe_cast(F.get(parts, F.lit(0)), "int")
    ok = safe_cast(F.get(parts, F.lit(1)), "int")
    if which == "ok":
        number = ok
    elif which == "failed":
        number = total - ok
    else:
        raise ValueError("which is 'ok' or 'failed'")
    return (
        F.when(number.isNull(), F.lit(0))
        .when(number < 0, F.lit(7))
        .when(number >= 5, F.lit(6))
        .otherwise(number + 1)
    )


def vocab_index(c: Column | str, words: Sequence[str]) -> Column:
    """1-based place of a value in a short fixed list, 0 when absent or null."""
    listed = F.array(*[F.lit(w) for w in words])
    return F.coalesce(F.array_position(listed, _col(c)), F.lit(0)).cast("int")


def merge_text(cols: Sequence[Column | str], sep: str = ",", keep_blanks: bool = True) -> Column:
    """One text from several columns.

    keep_blanks=True joins in order and leaves an empty field for a blank
    column. keep_blanks=False folds from the left, so the last column comes
    first, nulls are skipped and the text ends with sep.
    """
    if keep_blanks:
        return F.concat_ws(sep, *[blank_to(c, "") for c in cols])
    return F.concat_ws(sep, *[_col(c) for c in reversed(cols)], F.lit(""))


def strip_newlines(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"[\r\n]", "")


def format_label_line(label: Column | str, text: Column | str) -> Column:
    """`__label__<k> <text>`, or empty text when there is no text."""
    text = _col(text)
    line = F.concat(F.lit("__label__"), _col(label).cast("string"), F.lit(" "), text)
    return F.when(text == "", F.lit("")).otherwise(line)


def unpack_array(c: Column | str, n: int, prefix: str) -> dict[str, Column]:
    """{prefix0: first item, ...}; places past the end are null."""
    return {f"{prefix}{i}": F.get(_col(c), F.lit(i)) for i in range(n)}
