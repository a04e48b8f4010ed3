from tableloom.streaming.arrivals import arrived, ingest_new_files, split_batch, stream_csv
from tableloom.streaming.conversation_state import conversation_state, current_state, run_state

__all__ = [
    "arrived",
    "conversation_state",
    "current_state",
    "ingest_new_files",
    "run_state",
    "split_batch",
    "stream_csv",
]
