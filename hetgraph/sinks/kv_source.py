"""Key-value writes as a Spark data source whose tasks stage and whose driver commits.

``df.write.format("hetgraph_kv").mode("append").option("root", folder).save()`` takes ``key, ttl, value``. A task
writes one Parquet segment under a name of its own and hands the name over; only when all tasks are done does the
driver publish the names in one numbered commit file. Segments of failed or repeated tasks are in no
commit, so nobody reads them. A job that is aborted leaves an empty file by its name in ``aborted``, for
tasks that still run. ``root`` is any folder that pyarrow's file systems reach and all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "hetgraph_kv"
SCHEMA = "key string, ttl int, value string"
_ARROW = pa.schema([("key", pa.string()), ("ttl", pa.int32()), ("value", pa.string())])


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def _commits(store: fs.FileSystem, root: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    return sorted(f.path for f in found if f.path.endswith(".json"))


@dataclass
class Staged(WriterCommitMessage):
    segment: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.root, self.at = options["root"].rstrip("/"), int(options.get("at", 0))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """One segment per task, batch by batch; a task that has no rows, fails or outlives an abort leaves none."""
        store, root = _open(self.root)
        folder, name, rows, out = f"{root}/segments/{self.job}", f"{uuid.uuid4().hex}.parquet", 0, None
        draft, final = f"{folder}/.{name}.tmp", f"{folder}/{name}"
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    store.create_dir(folder, recursive=True)
                    out = pq.ParquetWriter(draft, _ARROW, filesystem=store, compression="zstd")
                out.write_table(pa.Table.from_batches([batch]).select(_ARROW.names).cast(_ARROW))
                rows += batch.num_rows
            if out is not None:
                out.close()
                self._go_on(store, root)
                store.move(draft, final)
                # The abort is noted before its folder is deleted: a segment that came too late for that is seen here.
                self._go_on(store, root)
        except BaseException:
            if out is not None:
                with suppress(Exception):
                    out.close()
                for path in (draft, final):
                    with suppress(OSError):
                        store.delete_file(path)
            raise
        return Staged(name if rows else None, rows)

    def _note(self, root: str) -> str:
        return f"{root}/aborted/{self.job}"

    def _go_on(self, store: fs.FileSystem, root: str) -> None:
        if store.get_file_info(self._note(root)).type != fs.FileType.NotFound:
            raise RuntimeError("the write was aborted")

    def commit(self, messages: list[Staged | None]) -> None:
        """Publish the segments of all tasks at once, as the next commit."""
        store, root = _open(self.root)
        done = [m for m in messages if m is not None]
        number = 1 + max((int(c.rsplit("/", 1)[1][:-5]) for c in _commits(store, root)), default=0)
        text = {
            "number": number,
            "at": self.at,
            "rows": sum(m.rows for m in done),
            "segments": [f"{self.job}/{m.segment}" for m in done if m.segment],
        }
        store.create_dir(f"{root}/commits", recursive=True)
        draft, final = f"{root}/commits/{self.job}.draft", f"{root}/commits/{number:012d}.json"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(text).encode())
        if store.get_file_info(final).type != fs.FileType.NotFound:
            raise RuntimeError(f"another writer has published commit {number}; write again")
        store.move(draft, final)

    def abort(self, messages: list[Staged | None]) -> None:
        """A failed write leaves its segments unnamed; they are removed here, or by their tasks if those still run."""
        store, root = _open(self.root)
        store.create_dir(f"{root}/aborted", recursive=True)
        store.open_output_stream(self._note(root)).close()
        folder = f"{root}/segments/{self.job}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class KeyValueSource(DataSource):
    """Write-only; ``read_key_values`` reads with Spark's own Parquet reader."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a key-value store is only appended to: later commits win")
        if "root" not in self.options:
            raise ValueError("set the option root")
        return _Writer(dict(self.options))


def put_key_values(key_values: DataFrame, root: str, at: int = 0) -> None:
    """Append ``key, ttl, value`` rows as one commit, written at ``at`` (seconds since 1970)."""
    key_values.sparkSession.dataSource.register(KeyValueSource)
    rows = key_values.select(F.col("key").cast("string"), F.col("ttl").cast("int"), F.col("value").cast("string"))
    rows.write.format(NAME).mode("append").option("root", root).option("at", str(at)).save()


def read_key_values(spark: SparkSession, root: str, now: int | None = None) -> DataFrame:
    """``key, ttl, value`` of the published commits: per key the latest commit wins, equal keys of one commit by the larger value.

    With ``now``, keys whose time to live has passed since their commit are left out. Null keys are rows of no key
    and are left out. A commit names one segment per task of its job, so the list of names is as long as the
    number of tasks, not of rows.
    """
    store, base = _open(root.rstrip("/"))
    parts = []
    for path in _commits(store, base):
        with store.open_input_stream(path) as f:
            text = json.loads(f.read())
        parts += [(s, text["number"], text["at"]) for s in text["segments"]]
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(*[f"{root.rstrip('/')}/segments/{p[0]}" for p in parts])
    # A segment's name is its last two path parts; commits by name are few rows.
    names = spark.createDataFrame(parts, "segment string, number long, at long")
    named = rows.withColumn("segment", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1))
    dated = named.where("key IS NOT NULL").join(names, "segment")
    last = dated.groupBy("key").agg(
        F.max_by(F.struct("ttl", "value", "at"), F.struct("number", "value", "ttl")).alias("e")
    )
    kept = last if now is None else last.where(F.col("e.at") + F.col("e.ttl") > now)
    return kept.select("key", "e.ttl", "e.value")
