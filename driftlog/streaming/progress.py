"""Per-batch source positions from a running query's progress (no extra job)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from driftlog.streaming.sinks import append_offsets


def progress_offsets(progress: dict | None) -> list[dict]:
    """``[{source, topic, partition, start, end}]`` from one progress report.

    Kafka sources report ``{"topic": {"0": n, ...}}`` start/end offsets; other
    sources report their own offset text, returned as ``start``/``end`` with
    no topic or partition.
    """
    out: list[dict] = []
    for src in (progress or {}).get("sources", []):
        start, end = src.get("startOffset"), src.get("endOffset")
        start = json.loads(start) if isinstance(start, str) and start[:1] == "{" else start
        end = json.loads(end) if isinstance(end, str) and end[:1] == "{" else end
        if isinstance(end, dict) and all(isinstance(v, dict) for v in end.values()):
            for topic, parts in end.items():
                for p, until in parts.items():
                    frm = (start or {}).get(topic, {}).get(p) if isinstance(start, dict) else None
                    out.append({"source": src.get("description"), "topic": topic,
                                "partition": int(p), "start": frm, "end": until})
        else:
            out.append({"source": src.get("description"), "topic": None, "partition": None,
                        "start": start, "end": end})
    return out


class OffsetLedger(StreamingQueryListener):
    """Writes the positions of a named query's batches to the ledger, from its progress reports.

    For a stateful query, whose batches no longer hold source positions. A
    report comes after its batch is committed, and a repeated one rewrites
    the same ledger rows.
    """

    def __init__(self, name: str, path: str, group: str, run: int):
        self.name, self.path, self.group, self.run = name, path, group, run

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name != self.name:
            return
        found = [o for o in progress_offsets(json.loads(event.progress.json)) if o["topic"] is not None]
        if found:
            ranges = SparkSession.active().createDataFrame(
                [(o["topic"], o["partition"], o["start"], o["end"]) for o in found],
                "topic string, partition int, from_offset long, until_offset long")
            append_offsets(ranges, event.progress.batchId, self.path, self.group, self.run)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
