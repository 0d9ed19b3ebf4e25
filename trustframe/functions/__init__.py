from trustframe.functions.exprs import (safe_div, rate, order_key, round_doubles, right_closed_bins,
                                        label_map, nan_to_null, as_double)

__all__ = ["safe_div", "rate", "order_key", "round_doubles", "right_closed_bins", "label_map",
           "nan_to_null", "as_double"]
