from tidegauge.streaming.arrival import arrival_windows
from tidegauge.streaming.batches import (batch_sql, placed, run_batches, start_batches,
                                         stream_id)

__all__ = ["arrival_windows", "batch_sql", "run_batches", "start_batches", "placed", "stream_id"]
