from .columns import (  # noqa: F401
    alert_description,
    alert_id,
    alert_key,
    alert_metadata,
    display_time,
    error_marker,
    error_rate,
    is_error,
    message_length,
    seconds,
)
