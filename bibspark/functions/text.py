"""Column expressions for text and year fields; everything stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bibspark.schema import COUNTRY_NAMES, YEARS

_EDGE = r"(?U)^[\s\p{Z}]+|[\s\p{Z}]+$"
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside lambdas, where Spark shares nothing."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c) -> Column:
    """Without white space of any kind at either end (``trim`` knows the blank only)."""
    return F.regexp_replace(_c(c), _EDGE, "")


def is_blank(c) -> Column:
    return F.coalesce(strip(c) == "", F.lit(True))


def filled(c) -> Column:
    """Neither blank nor the text of a missing value."""
    return ~is_blank(c) & (_c(c) != "nan")


def squeeze(c) -> Column:
    """White space collapsed and stripped."""
    return strip(F.regexp_replace(_c(c), r"(?U)\s+", " "))


def normal_title(c) -> Column:
    """Lower case, everything but a-z, 0-9 and blanks as blanks, collapsed; blank for null."""
    low = F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(low, " +", " "))


def fix_dashes(c) -> Column:
    """Dashes and quotes of wrongly decoded punctuation as hyphens, stripped."""
    return strip(F.regexp_replace(_c(c), "â\u0080[\u0090-\u009f]", "-"))


def parts(c, sep: str = ";") -> Column:
    """Stripped non-empty parts."""
    return F.filter(F.transform(F.split(_c(c), sep), strip), lambda x: x != "")


def normal_authors(c) -> Column:
    """``;`` list with one blank around the first comma of each name; blank values unchanged."""

    def one(a: Column) -> Column:
        k = F.instr(a, ",")
        return F.when(k > 0, F.concat(strip(F.substring(a, F.lit(1), k - 1)), F.lit(", "), strip(F.substring(a, k + 1, F.length(a))))).otherwise(a)

    return F.when(is_blank(c), _c(c)).otherwise(F.array_join(F.transform(parts(c), one), "; "))


def clean_doi(c) -> Column:
    """Stripped, without resolver addresses; blank values unchanged."""
    out = F.regexp_replace(F.regexp_replace(strip(c), "https?://doi\\.org/", ""), "https?://dx\\.doi\\.org/", "")
    return F.when(is_blank(c), _c(c)).otherwise(out)


def normal_semicolons(c) -> Column:
    """One blank after each semicolon, none before; semicolons at the end removed."""
    return F.regexp_replace(strip(F.regexp_replace(_c(c), r"\s*;\s*", "; ")), ";+$", "")


def country_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in COUNTRY_NAMES.items() for x in kv])


def countries(c) -> Column:
    """Array of the distinct countries of the addresses, sorted: what stands after the last comma."""
    last = F.transform(F.filter(F.split(_c(c), ";"), lambda p: F.contains(p, F.lit(","))), lambda p: strip(F.element_at(F.split(p, ","), -1)))
    named = F.transform(F.filter(last, lambda x: x != ""), lambda x: F.coalesce(F.try_element_at(country_map(), F.lower(x)), x))
    return F.coalesce(F.array_sort(F.array_distinct(named)), F.array().cast("array<string>"))


def number(c) -> Column:
    """The value as a finite double, else null; text must be a plain decimal number."""
    s = _c(c).cast("string")
    d = F.when(s.rlike(_NUMBER), F.expr("try_cast(1 as double)") * s.try_cast("double"))
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(1e300)), d)


def clean_year(c) -> Column:
    """Year in the range of plausible years, checked before it is truncated, else null."""
    d = number(c)
    return F.when(d.between(*YEARS), d.cast("int"))


def compat_year(c) -> Column:
    """Year as integer, 0 where there is none."""
    return F.coalesce(number(c).cast("int"), F.lit(0))


def is_doi(c) -> Column:
    return _c(c).rlike(r"(?U)^10\.\d{4,}/")


def author_order(c) -> Column:
    """Names without a comma turned to ``Last, Rest``; blank values unchanged."""

    def one(a: Column) -> Column:
        w = F.split(squeeze(a), " ")
        return F.when(F.contains(a, F.lit(",")) | (F.size(w) < 2), a).otherwise(F.concat_ws(", ", F.element_at(w, -1), F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " ")))

    return F.when(is_blank(c), _c(c)).otherwise(F.array_join(F.transform(parts(c), one), "; "))


def keyword_list(c) -> Column:
    """``|`` and ``,`` as ``;``, empty places closed in one pass, one blank after each; blank as empty."""
    s = F.translate(_c(c), "|,", ";;")
    s = F.regexp_replace(F.regexp_replace(s, r";\s*;", ";"), r"\s*;\s*", "; ")
    return F.when(is_blank(c), F.lit("")).otherwise(F.regexp_replace(strip(s), ";+$", ""))


def accession(ut, di, ti) -> Column:
    """UT, else one made from the DOI, else one from a stable hash of the beginning of the title."""
    di = F.coalesce(_c(di), F.lit(""))
    made = F.concat(F.lit("WOS:"), F.substring(F.translate(di, "/", "_"), 1, 50))
    code = F.pmod(F.conv(F.substring(F.md5(F.substring(F.coalesce(_c(ti), F.lit("")), 1, 20)), 1, 8), 16, 10).cast("bigint"), F.lit(100000))
    return F.when(~is_blank(ut), _c(ut)).when(di != "", made).otherwise(F.concat(F.lit("WOS:GEN"), F.lpad(code.cast("string"), 6, "0")))


def chunks(c, width: int = 80) -> Column:
    """The text cut into pieces of ``width`` characters."""
    n = F.greatest(F.expr("0"), (F.length(_c(c)) - 1) / width).cast("int")
    return F.transform(F.sequence(F.lit(0), n), lambda i: F.substring(_c(c), i * width + 1, F.lit(width)))


def percent(part, whole) -> Column:
    """100 * part / whole to one decimal, half up, by whole numbers so that no binary fraction tips it."""
    a, b = _c(part).cast("bigint"), _c(whole).cast("bigint")
    return F.when(b > 0, F.floor((2000 * a + b) / (2 * b)) / 10.0).otherwise(0.0)
