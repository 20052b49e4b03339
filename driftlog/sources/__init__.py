"""Sources: parquet tables, records at rest or streamed, Kafka, JDBC."""

from driftlog.sources.jdbc import jdbc_options, jdbc_query
from driftlog.sources.kafka import kafka_options, kafka_records, max_offsets_per_trigger
from driftlog.sources.records import (file_records, records_from_events, table_stream,
                                      visitor_events)
from driftlog.sources.tables import TABLES, read_table

__all__ = ["jdbc_options", "jdbc_query", "kafka_options", "kafka_records",
           "max_offsets_per_trigger", "file_records", "records_from_events", "table_stream",
           "visitor_events", "TABLES", "read_table"]
