from shopflow.functions.expressions import (  # noqa: F401
    hour_of,
    is_valid_event,
    money_product,
    null_safe_true,
    safe_cast,
    to_event_time,
)
