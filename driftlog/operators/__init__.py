"""DataFrame -> DataFrame operators; each works on batch and streaming input
unless its docstring says otherwise."""

from driftlog.operators.decode import (access_log_columns, access_log_fields, decode_args,
                                       decode_envelope,
                                       decode_payload, decode_records, decode_visitor_events,
                                       decode_visitors,
                                       good, quarantined, split_valid)
from driftlog.operators.dedup import daily_first_seen, latest_documents, pick_per_key
from driftlog.operators.offsets import (latest_offsets, ledger_rows, offset_ranges, resume_from,
                                        seed_offsets, starting_offsets_json)
from driftlog.operators.project import (decode_fact, project_doc, project_fact, project_visitor,
                                        rows_to_json, with_doc_id, with_event_day)
from driftlog.operators.parallel import spread
from driftlog.operators.keywords import read_keyword_store, write_keyword_store
from driftlog.operators.rejects import rejected_documents, split_rejected
from driftlog.operators.search import page_key, search, term_filter

__all__ = [
    "access_log_columns", "access_log_fields", "decode_args", "decode_envelope", "decode_payload", "decode_records",
    "decode_visitor_events", "decode_visitors", "good", "quarantined", "split_valid",
    "daily_first_seen", "latest_documents", "pick_per_key",
    "latest_offsets", "ledger_rows", "offset_ranges", "resume_from", "seed_offsets",
    "starting_offsets_json",
    "decode_fact", "project_doc", "project_fact", "project_visitor", "rows_to_json",
    "with_doc_id", "with_event_day",
    "search", "page_key", "term_filter", "spread",
    "read_keyword_store", "write_keyword_store", "rejected_documents", "split_rejected",
]
