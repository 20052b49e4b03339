"""Log-event analytics on Spark DataFrames.

Decode tracking hits carried in access-log envelopes into flat fact rows,
quarantine broken records with a reason, keep the first event per visitor
and day, write documents idempotently with an offset ledger, turn rows into
JSON documents, and search stored documents. Batch and Structured
Streaming share the same operators.
"""

__version__ = "0.1.0"
