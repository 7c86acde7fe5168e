from quayside.functions.conditional import (
    blank_to,
    error_to_null,
    is_blank,
    is_null,
    not_blank_aware,
    null_if_empty,
    switch_map,
    switch_true,
    typed_null,
    yes_no,
)
from quayside.functions.dates import (
    booked_date,
    day,
    days_between,
    eomonth,
    month,
    month_name,
    now_utc,
    quarter_label,
    quarter_no,
    short_date,
    to_ts,
    year,
)
from quayside.functions.numbers import (
    format_boolean,
    format_currency,
    growth,
    growth_label,
    money,
    round0,
    safe_divide,
    to_decimal,
    to_int,
    to_long,
)
from quayside.functions.text import (
    clean_phone,
    concat,
    concat_ws,
    contains,
    external_key,
    full_name,
    item_name,
    item_sku,
    normalize_phone,
    prefix_key,
    text_concat,
    upper,
)

__all__ = [name for name in dir() if not name.startswith("_")]
