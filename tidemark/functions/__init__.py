from .exact import exact_avg, exact_sum
from .ordering import first_value, last_value, order_key
from .time import (clock_label, epoch_millis, event_time, to_ntz,
                   with_event_time, with_proc_time)

__all__ = [
    "exact_avg", "exact_sum", "first_value", "last_value", "order_key",
    "clock_label", "epoch_millis", "event_time", "to_ntz",
    "with_event_time", "with_proc_time",
]
