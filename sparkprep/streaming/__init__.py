"""Incremental loading as a stream that runs until no new file is left."""

from sparkprep.streaming.landing import (
    load_new_files,
    stage_new_files,
    stream_landing,
    stream_to_store,
)

__all__ = ["load_new_files", "stage_new_files", "stream_landing", "stream_to_store"]
