from ebbflow.functions.expr import (  # noqa: F401
    CLOSE_GAP,
    OPEN_END,
    any_changed,
    concat_null_as_empty,
    date_from_digits,
    elapsed_seconds,
    epoch_micros,
    minus_interval,
    open_end,
    parse_decimal_comma,
    plus_interval,
    strip_blanks,
    time_bucket,
    ts_literal,
)
