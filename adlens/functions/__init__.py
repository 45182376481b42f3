from adlens.functions.numeric import (to_num, strict_num, clean_numeric, clean_numeric_text,
                                     coerce_numeric, column_coercion_report, money, sum_money,
                                     sum_money_or_zero)
from adlens.functions.text import campaign_key, lower_or_unknown, contains_any, relabel
from adlens.functions.dates import (month_of, parse_day, day_to_month, month_label,
                                    month_from_name, add_months_str)
from adlens.functions.metrics import safe_div, roas, cpa, pct, iroas_with_floor

__all__ = [
    "to_num", "strict_num", "clean_numeric", "clean_numeric_text", "coerce_numeric",
    "column_coercion_report", "money", "sum_money", "sum_money_or_zero",
    "campaign_key", "lower_or_unknown", "contains_any", "relabel",
    "month_of", "parse_day", "day_to_month", "month_label", "month_from_name",
    "add_months_str", "safe_div", "roas", "cpa", "pct", "iroas_with_floor",
]
