"""Datasets declared as functions and refreshed on request: streaming tables, materialised tables, views."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import storage
from millrace.operators import quality
from millrace.operators.quality import Expectation, keep_expected
from millrace.operators.snapshots import SnapshotTable, partition_of

EVENT_SCHEMA = "event_type string, timestamp timestamp, origin struct<update_id: string>, details string"
METRIC_SCHEMA = "dataset string, name string, passed_records long, failed_records long"
STREAM, TABLE, VIEW = "streaming table", "materialised table", "view"
BATCH = "__batch"  # folders of a streaming table


def append_stream(stream: DataFrame, path: str, checkpoint: str, continuous_every: str | None = None):
    """Write a stream to Parquet, each input once.

    By default all input there is now is processed and the call returns; with an interval such as '1 minute'
    the query keeps running and is returned.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def copy_into(spark: SparkSession, table: SnapshotTable, path: str, file_type: str, schema, checkpoint: str) -> None:
    """Append the rows of files that were not loaded before; running it again adds nothing.

    The checkpoint remembers the files and the batch tag the appends, so a crash between the
    two does not load a file twice.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        tag = f"{checkpoint}:{batch_id}"
        if table.exists():
            table.append(batch, tag=tag)
        else:
            table.create(batch, tag=tag)

    query = (
        spark.readStream.schema(schema).format(file_type).load(path).writeStream
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start()
    )
    query.awaitTermination()


class InputFailed(RuntimeError):
    """A dataset was left out because one that it reads has failed."""


@dataclass
class Dataset:
    name: str
    build: Callable[..., DataFrame]
    kind: str
    expectations: list[Expectation] = field(default_factory=list)
    comment: str | None = None
    properties: dict[str, str] = field(default_factory=dict)


class Datasets:
    """Named datasets that read each other by name.

    Each function takes this object and calls :meth:`read` or :meth:`read_stream`; whatever it
    reads is refreshed first, so declaration order and module do not matter. Datasets that do not
    wait for each other are refreshed at the same time, ``at_once`` of them, each in a scheduler pool of its
    name. ``parameters`` hold what differs between runs, such as source paths. Older versions of materialised tables are
    removed when they are older than ``retain``.

    A streaming table is a folder per micro-batch, and so are its metrics; a batch that runs again
    writes the same folders. Rows that break a rule are kept apart in the same write (:meth:`rejected`), and
    counts come from the files' footers, so they are exact. Each run adds its events to a log: its id, what
    each dataset reads, what its rules have counted, and what failed.
    """

    def __init__(self, spark: SparkSession, root: str, parameters: dict[str, str] | None = None, retain: timedelta | None = timedelta(days=7), at_once: int = 4):
        self.retain = retain
        self.spark, self.root, self.parameters = spark, root.rstrip("/"), dict(parameters or {})
        self.declared: dict[str, Dataset] = {}
        self._fresh: dict[str, Future] = {}
        self._todo: set[str] | None = None  # what a run refreshes; the rest is read as it is
        self._waits: dict[str, str] = {}
        self._inputs: dict[str, list[str]] = {}
        self._lock, self._slots, self._here = threading.RLock(), threading.Semaphore(at_once), threading.local()
        self._events: list[tuple] = []
        self.update_id: str | None = None

    def dataset(self, kind: str, name: str | None = None, expectations=(), comment: str | None = None, properties: dict[str, str] | None = None):
        if kind not in (STREAM, TABLE, VIEW):
            raise ValueError(f"unknown kind of dataset {kind}")

        def add(fn):
            key = name or fn.__name__
            if key in self.declared:
                raise ValueError(f"dataset {key} is declared twice")
            self.declared[key] = Dataset(key, fn, kind, list(expectations), comment, dict(properties or {}))
            return fn

        return add

    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def read(self, name: str) -> DataFrame:
        """A declared dataset's rows, refreshed once per run."""
        if name not in self.declared:
            raise KeyError(f"no dataset named {name}")
        reader = getattr(self._here, "dataset", None)
        if reader is None:
            return self._started(name).result()
        if name not in self._inputs[reader]:
            self._inputs[reader].append(name)
        with self._lock:
            self._waits[reader] = name
            chain = [name]
            while chain[-1] in self._waits and self._waits[chain[-1]] not in chain:
                chain.append(self._waits[chain[-1]])
            if reader in chain:
                first = min(range(len(chain)), key=lambda i: list(self.declared).index(chain[i]))
                raise ValueError("datasets read each other in a circle: " + " > ".join([*chain[first:], *chain[:first], chain[first]]))
            future = self._started(name)
        self._slots.release()  # while it waits
        try:
            return future.result()
        except Exception as error:
            raise InputFailed(f"{reader} was left out, as {name} failed") from error
        finally:
            self._slots.acquire()
            with self._lock:
                self._waits.pop(reader, None)

    def rejected(self, name: str) -> DataFrame:
        """Rows that a dataset's rules have kept out, with ``broken``, the names of these rules. Views have none."""
        if self.declared[name].kind == STREAM:
            return quality.read_rejected(self.spark.read, self.path(name), self.read(name).schema)
        rows = SnapshotTable(self.spark, self.path(name)).read()
        if quality.VERDICT not in rows.columns:
            return rows.limit(0).withColumn("broken", F.array().cast("array<string>"))
        broken = rows.filter(F.col(quality.VERDICT) == quality.REJECTED).withColumn("broken", F.split(quality.BROKEN, ","))
        return broken.drop(quality.VERDICT, quality.BROKEN)

    def read_stream(self, name: str) -> DataFrame:
        """The rows a streaming table gained since its reader's last run."""
        if self.declared[name].kind != STREAM:
            raise ValueError(f"{name} is rewritten on refresh and cannot be read as a stream")
        schema = self.read(name).schema
        return quality.read_kept(self.spark.readStream, self.path(name), schema)

    def _started(self, name: str) -> Future:
        """The dataset's refresh in this run, begun in a thread of its own."""
        with self._lock:
            if name not in self._fresh:
                future = self._fresh[name] = Future()
                InheritableThread(target=self._work, args=(name, future), daemon=True).start()
            return self._fresh[name]

    def _work(self, name: str, future: Future) -> None:
        self._here.dataset, self._inputs[name] = name, []
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        with self._slots:
            try:
                frame = self._refreshed(self.declared[name]) if self._todo is None or name in self._todo else self._stored(self.declared[name])
            except Exception as error:
                status = "SKIPPED" if isinstance(error, InputFailed) else "FAILED"
                self._event("flow_progress", {"dataset": name, "status": status, "error": str(error)[:1000]})
                future.set_exception(error)
            else:
                future.set_result(frame)

    def _refreshed(self, d: Dataset) -> DataFrame:
        source = d.build(self)
        if d.kind == VIEW:
            frame = keep_expected(source, d.expectations)
        elif d.kind == STREAM:
            frame = self._append(d, source)
        else:
            table, rules = SnapshotTable(self.spark, self.path(d.name)), bool(d.expectations)
            rows = quality.judged(source, d.expectations) if rules else source
            version = table.create(rows, comment=d.comment, partition_by=[quality.VERDICT, quality.BROKEN] if rules else None, gather=False)
            if rules:
                # The parts' names tell the rules, and their rows come from the footers.
                found: dict[str, int] = {}
                for part in table.parts():
                    names = unquote(partition_of(part).rpartition("=")[2])
                    found[names] = found.get(names, 0) + part["rows"]
                self._note(d, [self._counted(d, found, f"version-{version}")])
            frame = self._stored(d)
            if self.retain is not None and version:
                table.expire(keep_versions=2, retain=self.retain, dry_run=False, force=True)
        self._event("flow_definition", {"output_dataset": d.name, "input_datasets": self._inputs[d.name]})
        return frame

    def _stored(self, d: Dataset) -> DataFrame:
        """A dataset's rows as the last run left them; a view is built."""
        if d.kind == VIEW:
            return keep_expected(d.build(self), d.expectations)
        if d.kind == STREAM:
            return quality.read_kept(self.spark.read, self.path(d.name), self.spark.read.parquet(self._first_folder(d.name)).schema)
        rows = SnapshotTable(self.spark, self.path(d.name)).read()
        if quality.VERDICT not in rows.columns:
            return rows
        return rows.filter(F.col(quality.VERDICT) == quality.KEPT).drop(quality.VERDICT, quality.BROKEN)

    def _first_folder(self, name: str) -> str:
        """An empty folder that holds the schema of a streaming table."""
        return f"{self.path(name)}/{BATCH}=none/{quality.VERDICT}={quality.KEPT}/{quality.BROKEN}={quality.NONE}"

    def _append(self, d: Dataset, source: DataFrame) -> DataFrame:
        """Write what the stream has new, one folder per micro-batch, and count the rules by the written files."""
        path, counts = self.path(d.name), []
        schema = source.schema
        if not storage.exists(self.spark, self._first_folder(d.name)):
            self.spark.createDataFrame([], schema).write.parquet(self._first_folder(d.name))

        def add(batch: DataFrame, number: int) -> None:
            found = quality.write_judged(batch, d.expectations, f"{path}/{BATCH}={number:012d}")
            counts.append(self._counted(d, found, f"batch-{number:012d}"))

        writer = source.writeStream.option("checkpointLocation", f"{self.root}/checkpoints/{d.name}")
        writer.trigger(availableNow=True).foreachBatch(add).start().awaitTermination()
        self._note(d, counts)
        return quality.read_kept(self.spark.read, path, schema)

    def run(self, only: list[str] | None = None, resume: bool = False) -> str:
        """Refresh everything once; returns the id that the run's events carry.

        ``only`` names datasets to refresh, with all they read. ``resume`` refreshes what failed in the last
        run, or was left out behind a failure, and reads the rest as it is. A failure leaves other branches
        alone: they are refreshed, and the first error is raised at the end.
        """
        names = list(self.declared) if only is None else list(only)
        unknown = [n for n in names if n not in self.declared]
        if unknown:
            raise KeyError(f"no dataset named {unknown[0]}")
        self._todo = None
        if resume:
            self._todo = self.unfinished() & set(self.declared)
            names = [n for n in names if n in self._todo]
        self._fresh.clear()
        self.update_id, self._events = uuid.uuid4().hex, []
        self._event("create_update", {"datasets": names})
        try:
            started = [self._started(n) for n in names]
            errors = [f.exception() for f in started]  # waits for all
        finally:
            self._todo = None
            self.spark.createDataFrame(list(self._events), EVENT_SCHEMA).coalesce(1).write.mode("append").json(f"{self.root}/events")
        first = [f.exception() for f in self._fresh.values() if f.done() and f.exception() and not isinstance(f.exception(), InputFailed)]
        if any(errors):
            raise (first or [e for e in errors if e])[0]
        return self.update_id

    def unfinished(self) -> set[str]:
        """Datasets that failed in the newest run of the log, or were left out."""
        if not storage.exists(self.spark, f"{self.root}/events"):
            return set(self.declared)
        newest = quality.of_latest_update(self.events()).filter("event_type = 'flow_progress'")
        name = F.get_json_object("details", "$.flow_progress.dataset")
        return {r[0] for r in newest.filter(F.get_json_object("details", "$.flow_progress.status").isNotNull()).select(name).distinct().collect()}

    def _event(self, kind: str, details: dict) -> None:
        self._events.append((kind, datetime.now(timezone.utc), (self.update_id,), json.dumps({kind: details})))

    def _counted(self, d: Dataset, counts: dict, key: str) -> list[tuple]:
        """Write the rules' counts of one pass under its own key; returns them."""
        rows = quality.rule_counts(counts, d.expectations, d.name)
        if rows:
            self.spark.createDataFrame(rows, METRIC_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/metrics/{d.name}/{key}")
        return rows

    def _note(self, d: Dataset, passes: list[list[tuple]]) -> None:
        rows = [r for rows in passes for r in rows]
        each = [
            {"name": e.name, "dataset": d.name, "passed_records": sum(r[2] for r in rows if r[1] == e.name), "failed_records": sum(r[3] for r in rows if r[1] == e.name)}
            for e in d.expectations
        ]
        if each:
            self._event("flow_progress", {"data_quality": {"expectations": each}})

    def metrics(self) -> DataFrame:
        """Passed and failed records per dataset, rule and refresh or micro-batch, of all runs. Views have none."""
        if not storage.exists(self.spark, f"{self.root}/metrics"):
            return self.spark.createDataFrame([], METRIC_SCHEMA)
        return self.spark.read.schema(METRIC_SCHEMA).parquet(f"{self.root}/metrics/*/*")

    def events(self) -> DataFrame:
        """The log of all runs: type, time, update id and details as JSON."""
        return self.spark.read.schema(EVENT_SCHEMA).json(f"{self.root}/events")

    def describe(self) -> DataFrame:
        rows = [(d.name, d.kind, d.comment, d.properties, [e.name for e in d.expectations]) for d in self.declared.values()]
        return self.spark.createDataFrame(
            rows, "name string, kind string, comment string, properties map<string,string>, expectations array<string>"
        )
