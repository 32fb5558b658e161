"""Writing key-value rows to a store outside Spark."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLUSH_ROWS = 1000


class Client(Protocol):
    def put_many(self, rows: list[tuple[str, int, str]]) -> None: ...

    def close(self) -> None: ...


def write_key_values(key_values: DataFrame, connect: Callable[[], Client], flush_rows: int = FLUSH_ROWS, retries: int = 3) -> int:
    """Send ``key, ttl, value`` rows in batches and return how many were sent.

    ``connect`` runs inside each task, so no connection travels with the plan. A task that is
    run again puts the same keys once more, which leaves the store as it was.
    """

    def send(batches):
        client = connect()
        sent = 0
        try:
            for batch in batches:
                rows = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
                for start in range(0, len(rows), flush_rows):
                    part = rows[start : start + flush_rows]
                    for attempt in range(retries):
                        try:
                            client.put_many(part)
                            break
                        except OSError:
                            if attempt + 1 == retries:
                                raise
                    sent += len(part)
        finally:
            client.close()
        yield pa.RecordBatch.from_pydict({"sent": pa.array([sent], pa.int64())})

    counts = key_values.select("key", "ttl", "value").mapInArrow(send, "sent long")
    return counts.agg(F.coalesce(F.sum("sent"), F.lit(0))).first()[0]
