from candlewick.functions.clock import day_path, day_ranges, event_time, utc_date, window_label, window_seconds
from candlewick.functions.numeric import ratio, round_sum
from candlewick.functions.ordering import trade_order

__all__ = ["day_path", "day_ranges", "event_time", "ratio", "round_sum", "trade_order", "utc_date",
           "window_label", "window_seconds"]
