"""Creator page analytics on Spark."""

from reelbook.operators.extract import extract_pages, extract_profiles, extract_videos
from reelbook.operators.quality import extraction_counts, filter_invalid_profiles, quarantine
from reelbook.operators.upsert import LatestTable, latest, merge_upsert
from reelbook.session import configure, scratch_dir
from reelbook.streaming.ingest import CreatorStore, start_ingest, start_landing

__all__ = [
    "CreatorStore",
    "LatestTable",
    "configure",
    "extract_pages",
    "extract_profiles",
    "extract_videos",
    "extraction_counts",
    "filter_invalid_profiles",
    "latest",
    "merge_upsert",
    "quarantine",
    "scratch_dir",
    "start_ingest",
    "start_landing",
]
