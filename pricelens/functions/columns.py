"""Scalar column expressions. All built-in functions: no Python per row."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelens import constants as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_standard(category="category", mapping: dict | None = None) -> Column:
    """Synonym -> unified category; unmapped kept; NULL stays NULL.

    One map literal and one lookup instead of a CASE per synonym.
    """
    mapping = C.CATEGORY_MAP if mapping is None else mapping
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    cat = _col(category)
    return F.coalesce(F.try_element_at(m, cat), cat)


def normalized_brand(brand="brand") -> Column:
    """NULL -> 'unknown'; lower(trim); strip one trailing suffix; trim."""
    b = _col(brand)
    base = F.when(b.isNotNull(), F.lower(F.trim(b))).otherwise(F.lit(C.UNKNOWN_BRAND))
    return F.trim(F.regexp_replace(base, C.BRAND_SUFFIX_PATTERN, ""))


def effective_price(price="price", sale_price="sale_price", on_sale="on_sale") -> Column:
    """Sale price when the listing is on sale and has one, else the list price."""
    s = _col(sale_price)
    return F.when(_col(on_sale) & s.isNotNull(), s).otherwise(_col(price))


def price_bucket(eff: Column) -> Column:
    return (F.when(eff < F.lit(C.BUDGET_MAX), F.lit("budget"))
            .when(eff <= F.lit(C.MID_MAX), F.lit("mid"))
            .otherwise(F.lit("premium")))


def discount_pct(price="price", sale_price="sale_price") -> Column:
    """round((price - sale)/price*100, 2) when sale is set and price > 0, else 0.0.

    Ignores the on-sale flag and may be negative (sale above price).
    """
    p, s = _col(price), _col(sale_price)
    return (F.when(s.isNotNull() & (p > 0), F.round((p - s) / p * 100, 2))
            .otherwise(F.lit(0.0)))


def ts_text(ts) -> Column:
    """Fixed text form of a timestamp, independent of the session zone."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def surrogate_key(*cols) -> Column:
    """md5 of the fields as text, NULL replaced by a marker, joined by '-'."""
    parts = []
    for c in cols:
        col = _col(c)
        parts.append(F.coalesce(col.cast("string"), F.lit(C.SURROGATE_NULL)))
    return F.md5(F.concat_ws(C.SURROGATE_SEP, *parts))


def surrogate_key_ts(ts) -> Column:
    """Surrogate key of a single timestamp field (fixed text form)."""
    return F.md5(F.coalesce(ts_text(ts), F.lit(C.SURROGATE_NULL)))


def sunday_week(ts) -> Column:
    """Week of year with weeks starting on Sunday, 0-53 (days before the first
    Sunday are week 0)."""
    t = _col(ts)
    return F.floor((F.dayofyear(t) + 7 - F.dayofweek(t)) / 7).cast("bigint")


def brand_from_title(title="title", upper_title=None) -> Column:
    """First known brand contained in the title (case-insensitive substring,
    list order), else the first whitespace token, else 'Unknown'.

    Pass `upper_title` (an already computed upper-case column) to avoid
    re-evaluating upper() in every branch."""
    t = _col(title)
    up = F.upper(t) if upper_title is None else _col(upper_title)
    hits = [F.when(up.contains(b.upper()), F.lit(b)) for b in C.KNOWN_BRANDS]
    first_token = F.nullif(F.regexp_extract(t, r"(?U)^\s*(\S+)", 1), F.lit(""))
    return F.coalesce(*hits, first_token, F.lit(C.UNKNOWN_TITLE_BRAND))


def unknown_if_blank(c) -> Column:
    col = _col(c)
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(C.UNKNOWN_VERDICT_TEXT))


def two_decimals(x) -> Column:
    """A double as text with two decimals, rounded from its exact binary value, ties
    to the even digit (0.125 -> 0.12, 2.675 -> 2.67, which is a little less).

    n = floor(100 |x|) cents or one more: 200 |x| against 2n + 1 decides. |x| is split
    into two halves of few bits whose products with 200 are exact.
    """
    v = F.abs(_col(x))
    high = v * 134217729.0 - (v * 134217729.0 - v)
    n = F.floor(v * 100.0)
    over = (high * 200.0 - (n * 2 + 1).cast("double")) + (v - high) * 200.0
    cents = n + F.when((over > 0) | ((over == 0) & (F.pmod(n, F.lit(2)) == 1)), 1).otherwise(0)
    exact = F.concat(F.when(_col(x) < 0, F.lit("-")).otherwise(F.lit("")), F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                     F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"))
    # Beyond 2^43 a double has no hundredths of its own left to round.
    return F.when(v < F.lit(float(1 << 43)), exact).otherwise(F.format_string("%.2f", _col(x)))


def price_line(price) -> Column:
    """'  Price: $x.xx\\n' when the price is set and non-zero, else ''."""
    p = _col(price)
    return F.when(p.isNotNull() & (p != 0), F.concat(F.lit("  Price: $"), two_decimals(p.cast("double")), F.lit("\n"))).otherwise(F.lit(""))
