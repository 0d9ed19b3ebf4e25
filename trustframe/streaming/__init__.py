from trustframe.streaming.monitor_stream import (event_stream, hourly_window_stream,
                                                 latest_windows, run_batch_function,
                                                 run_hourly_monitor)

from trustframe.streaming.stateful import (drift_alerts_by_window, final_counts, final_histograms, to_files, violation_runs,
                                           windows_stream)

__all__ = ["to_files", "final_counts", "windows_stream", "violation_runs", "final_histograms", "drift_alerts_by_window",
           "event_stream", "hourly_window_stream", "run_hourly_monitor", "latest_windows",
           "run_batch_function"]
