from tidemark.functions.dates import RunParams, WindowBounds, dates_between, day_ms, run_params, shift_day, window_bounds
from tidemark.functions.predicates import (
    age_zero,
    before,
    from_post,
    has_post,
    in_window,
    is_locked,
    named,
    on_dates,
    place_type,
    retained,
    since,
    state_known,
)
from tidemark.functions.scalars import (
    age_hours,
    classified,
    default,
    first_present,
    first_truthy,
    flag01,
    floor_div,
    has_media,
    json_str,
    label_y,
    minutes_between,
    ms_to_day,
    origin_post,
    pct,
    ratio_or_null,
    ratio_or_zero,
    safe_cast,
    str_true,
    title_len,
    to_epoch_ms,
)
