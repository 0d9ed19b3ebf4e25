from trustframe.sources.tables import table, TABLES
from trustframe.sources.readers import (read_headered_csv, read_fixed_csv, read_required_csv,
                                        load_dataset, DATASETS)
from trustframe.sources.sinks import (cached_result, save_splits, load_splits, write_report,
                                      append_history, parse_requests)

__all__ = ["table", "TABLES", "read_headered_csv", "read_fixed_csv", "read_required_csv",
           "load_dataset", "DATASETS", "cached_result", "save_splits", "load_splits",
           "write_report", "append_history", "parse_requests"]
