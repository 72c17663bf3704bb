"""Rate-feed ingestion, validation and keyed upsert as Spark jobs."""

from ratemill.feeds import FACTOR, FEEDS, RENEWAL, STUMPAGE, Column, FeedSpec
from ratemill.operators.merge import MergeRule, collapse_batch, merge_actions, upsert
from ratemill.plans.importer import ImportAborted, ImportResult, import_files
from ratemill.sources.store import TableStore

__all__ = [
    "FACTOR",
    "FEEDS",
    "RENEWAL",
    "STUMPAGE",
    "Column",
    "FeedSpec",
    "ImportAborted",
    "ImportResult",
    "MergeRule",
    "TableStore",
    "collapse_batch",
    "import_files",
    "merge_actions",
    "upsert",
]
