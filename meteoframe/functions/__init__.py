"""Column -> Column helpers (built-in expressions only)."""

from meteoframe.functions.text import (  # noqa: F401
    strip, tokens, token, padded_token, before, newline_to_space, is_blank,
    is_comment_or_blank, starts_with_digit, first_tokens, location_name,
)
from meteoframe.functions.numeric import (  # noqa: F401
    safe_double, safe_int, safe_number, sentinel_to_null,
    null_if_missing, zero_if_missing, mean_half_up, clamp,
)
from meteoframe.functions.weather import (  # noqa: F401
    dust_grade, sky_label, pty_label, strong_wind_alert, discomfort_index,
    discomfort_alert, outdoor_score,
)
from meteoframe.functions import dates  # noqa: F401
