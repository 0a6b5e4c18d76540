"""Column expressions (JVM-side, codegen-friendly)."""

from titlepulse.functions.cleaning import (  # noqa: F401
    budget_amount, money_amount, not_junk, star_value, strip_list_chars,
    suffixed_count, suffixed_number,
)
from titlepulse.functions.labels import (  # noqa: F401
    label_name, sentiment_indicators, sentiment_label, sentiment_number,
)
