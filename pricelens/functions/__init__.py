"""Column expressions (JVM-side, codegen'd) used by the operators."""

from pricelens.functions.columns import (  # noqa: F401
    brand_from_title,
    category_standard,
    discount_pct,
    effective_price,
    normalized_brand,
    price_bucket,
    sunday_week,
    surrogate_key,
    ts_text,
)
