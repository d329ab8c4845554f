"""Text helpers that mean the same to Spark's and to other regex engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All of Unicode's white space, spelt out: engines differ on what \s covers.
SPACES = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
#: Word edges by letters, digits and underscore of any script.
EDGE_LEFT, EDGE_RIGHT = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACES}|{SPACES}$", "")


def any_word(alternatives: str) -> str:
    """A pattern for any of these alternatives as whole words."""
    return f"{EDGE_LEFT}({alternatives}){EDGE_RIGHT}"


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used: plans stay small where such uses nest."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def json_string(text: Column, ascii_only: bool = False) -> Column:
    """The body of a JSON string; ``ascii_only`` also escapes what is beyond ASCII, as surrogate pairs where needed."""
    body = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for raw, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        body = F.replace(body, F.lit(raw), F.lit(escape))
    odd = r"(?s).*[\x00-\x1F].*" if not ascii_only else r"(?s).*[^\x20-\x7E].*"

    def unit(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(n)), 4, "0"))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        high = n - 0x10000
        wide = F.concat(unit(F.lit(0xD800) + F.shiftright(high, 10)), unit(F.lit(0xDC00) + high.bitwiseAND(F.lit(0x3FF))))
        out = F.when(n < 32, unit(n))
        if ascii_only:
            out = out.when(n > 0xFFFF, wide).when(n > 126, unit(n))
        return out.otherwise(c)

    return let(body, lambda b: F.when(b.rlike(odd), F.array_join(F.transform(characters(b), one), "")).otherwise(b))
