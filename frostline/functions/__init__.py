from frostline.functions.scalars import (  # noqa: F401
    clamp,
    event_timestamp,
    first_element,
    float32_millis,
    http_date,
    on_off_label,
    safe_divide,
    significant_digits,
    strip_quotes,
    to_json_text,
    truncated,
    whole_millis,
)
