"""Readers and writers.  Every reader takes an explicit schema."""

from rollcall.sources.commits import CommitConflict, CommitLog  # noqa: F401
from rollcall.sources.files import (  # noqa: F401
    append_ledger, export_csv, export_ordered, read_mapping, read_ordered, read_watermark, write_watermark,
)
from rollcall.sources.feed import (  # noqa: F401
    land_feed, read_catalogue, read_feed, read_feed_stream, read_landed_feed,
)
from rollcall.sources.json_array import read_json_array, write_json_array  # noqa: F401
from rollcall.sources.keyed_state import KeyedState  # noqa: F401
from rollcall.sources.lms import read_snapshot, read_students  # noqa: F401
from rollcall.sources.sinks import upsert_state, write_change_set  # noqa: F401
