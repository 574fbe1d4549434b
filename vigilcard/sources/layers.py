"""Persisted layers: raw, enriched, alerts, profiles, audit, rejected and labels.

Transaction layers are Parquet, partitioned by ``dt`` (UTC date). They are read at their
root with an explicit schema, so ``dt`` prunes and no file is opened for inference.

Everything a batch writes carries the name of the batch, as a folder below the date or the
table. A marker file stands for as long as the batch is pending; readers leave out what belongs
to a pending batch, and deleting the marker is the commit of all layers at once. A killed batch
therefore does not exist for readers; its writer takes its files back before it starts again.

Dates that many batches have written to are compacted: ``FAN`` folders of a level become one of
the next. A manifest per layer says which folders a compaction is making and which it has replaced;
one new version of it is the swap, and replaced folders are deleted one compaction later, as
readers may still use them.

Profiles are kept as deltas named in a manifest. Reading merges them; now and then they are
merged into one. Ids of raw are kept in levels, so that a batch finds out which of its ids are
stored without reading raw.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, DoubleType, LongType, StringType, StructField, StructType

from vigilcard.functions.cards import utc_date
from vigilcard.operators.align import align, day_literal
from vigilcard.operators.partials import report_partials
from vigilcard.operators.profiles import merge_deltas
from vigilcard.operators.seconds import day_moments
from vigilcard.operators.snapshots import Snapshot, snapshot_of
from vigilcard.schemas import ALERT, AUDIT_READ, ENRICHED, FRAUD_LABELS, PROFILE, RAW, REJECTED
from vigilcard.sources.levels import FAN, Levels
from vigilcard.sources.manifest import Files, Manifest
from vigilcard.sources.scratch import freed_shuffles

SCHEMAS = {"raw": RAW, "enriched": ENRICHED, "alerts": ALERT}
# The folder of rows without a time.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
DAY_MOMENTS = StructType(
    [StructField("customer_key", StringType()), StructField("day", LongType()), StructField("n", LongType()),
     StructField("mean", DoubleType()), StructField("squares", DoubleType()), StructField("dt", DateType())]
)
REPORT_PARTIALS = StructType(
    [StructField("merchant_category", StringType()), StructField("hour_of_day", LongType()), StructField("risk_level", StringType()),
     StructField("risk_score", DoubleType()), StructField("n", LongType()), StructField("volume", DoubleType())]
)
# Tables whose dates can be compacted.
DATED = {**SCHEMAS, "day_moments": DAY_MOMENTS, "report_partials": REPORT_PARTIALS}
# Profile deltas before they are merged into one.
PROFILE_DELTAS = 50
# History snapshots that are kept, the newest ones.
SNAPSHOTS = 4
BATCH = "batch"
# JSON lines repeat their field names, so they are kept compressed. A reader cannot split such a
# file, so a file holds no more lines than one task reads with ease.
JSON_LINES = {"compression": "gzip", "maxRecordsPerFile": 100_000}
EXPORT_FORMATS = ("parquet", "csv", "json", "jsonl")
# Text exports keep microseconds, which the default text form of a timestamp cuts off.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


class LayerStore:
    """The layers below one root folder of any file system Spark can write."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Files(spark)
        self._profiles = Manifest(self._files, f"{self.path('profiles')}/index")
        self._snapshot_list = Manifest(self._files, f"{self.path('snapshots')}/index")
        self._ids = Levels(spark, self.path("ids"), StructType([RAW["transaction_id"]]), "transaction_id")
        self._partials = Manifest(self._files, f"{self.path('report_partials')}/_kept")
        self._batch: str | None = None

    @contextmanager
    def batch(self, owner: str = "none") -> Iterator[str]:
        """Everything written inside becomes visible at the end, in one step, or never.

        A pending batch of the same owner, left by a killed run, is taken back first; an owner
        writes one batch at a time. Inside another batch, that batch goes on.
        """
        if self._batch is not None:
            yield self._batch
            return
        if owner != "none":
            self.roll_back(owner)
        self._batch = f"b-{uuid.uuid4().hex}"
        marker = f"{self._markers()}/{owner}.{self._batch}"
        self._files.write_new(marker, "")
        with freed_shuffles(self.spark):
            try:
                yield self._batch
                self._files.delete(marker)
            finally:
                self._batch = None
            self._merge_profiles()
            self._ids.merge(self._pending())

    def roll_back(self, owner: str | None = None) -> int:
        """Takes back the pending batches of an owner, or all; only for writers that are gone."""
        markers = [n for n in self._files.names(self._markers()) if owner is None or n.split(".")[0] == owner]
        for marker in markers:
            name = marker.split(".")[1]
            folders = [f"{layer}/dt=*" for layer in DATED] + ["audit", "rejected", "fraud_labels", "snapshots/as_of=*/*"]
            for folder in folders:
                for path in self._files.matching(f"{self.root}/{folder}/{BATCH}={name}"):
                    self._files.delete(path)
            self._ids.forget(name)
            gone = [e["folder"] for e in self._profiles.entries() if e["batch"] == name]
            if gone:
                self._profiles.change(lambda entries, name=name: [e for e in entries if e["batch"] != name])
            for path in gone:
                self._files.delete(path)
            self._files.delete(f"{self._markers()}/{marker}")
        return len(markers)

    def _markers(self) -> str:
        return self.path("_pending")

    def _pending(self) -> frozenset[str]:
        """Names of pending batches, without the one that this store is writing."""
        return frozenset(n.split(".")[1] for n in self._files.names(self._markers())) - {self._batch}

    def _visible(self, read: Callable[[], DataFrame | None]) -> DataFrame | None:
        """A table without the rows of pending batches and without their names.

        Files are listed when the table is read; what was pending before or is pending after
        that may have been listed in part, so both are left out.
        """
        before = self._pending()
        table = read()
        if table is None:
            return None
        pending = sorted(before | self._pending())
        return (table.filter(~F.col(BATCH).isin(pending)) if pending else table).drop(BATCH)

    def _dated(self, layer: str) -> DataFrame | None:
        """A table by date without what compactions are making or have replaced; listed again
        if a compaction came between."""
        schema = DATED[layer] if "dt" in DATED[layer].names else StructType(DATED[layer].fields + [StructField("dt", DateType())])
        generations = self._generations(layer)
        while True:
            entries = generations.entries()
            table = self._read(self.path(layer), named(schema))
            if generations.entries() == entries:
                break
        making = sorted(e["batch"] for e in entries if "batch" in e)
        replaced = sorted(e["folder"] for e in entries if "folder" in e)
        if table is not None and making:
            table = table.filter(~F.col(BATCH).isin(making))
        if table is not None and replaced:
            table = table.filter(~_folder().isin(replaced))
        return table

    def _generations(self, layer: str) -> Manifest:
        return Manifest(self._files, f"{self.path(layer)}/_generations")

    def compact(self, layer: str, fan: int = FAN) -> int:
        """Merges the folders of dates, ``fan`` or more of one level to one of the next; returns
        how many folders were replaced.

        All dates of a level are rewritten by one job, a row once per level, and a date ends with
        less than ``fan`` folders per level, whatever the number of batches. Batches may be written
        and read meanwhile; one compaction of a layer runs at a time, and what a killed one left
        is taken away first. Pending batches are not touched.
        """
        self._clear_replaced(layer)
        schema = DATED[layer] if "dt" in DATED[layer].names else StructType(DATED[layer].fields + [StructField("dt", DateType())])
        generations, level, count = self._generations(layer), 0, 0
        while True:
            replaced = {e["folder"] for e in generations.entries() if "folder" in e}
            found = [_date_and_batch(p) for p in self._files.matching(f"{self.path(layer)}/dt=*/{BATCH}=*")]
            pending = self._pending()  # read behind the list: what has begun since is not on it
            found = [(d, b) for d, b in found if b not in pending and f"{d}/{b}" not in replaced]
            dates: dict[str, list[str]] = {}
            for day, batch in found:
                if _level(batch) == level:
                    dates.setdefault(day, []).append(f"{day}/{batch}")
            full = sorted(folder for folders in dates.values() if len(folders) >= fan for folder in folders)
            if full:
                made = f"g{level + 1}-{uuid.uuid4().hex}"
                generations.change(lambda entries: [*entries, {"batch": made}])
                rows = self._read(self.path(layer), named(schema)).filter(_folder().isin(full))
                self._write_dated(layer, rows.withColumn(BATCH, F.lit(made)))
                self._swap(generations, made, full)
                count += len(full)
            elif not any(_level(b) > level for _, b in found):
                return count
            level += 1

    def _swap(self, generations: Manifest, made: str, full: list[str]) -> None:
        """Shows what a compaction has made and hides what it replaces, unless another one has
        taken it away as the remains of a killed one; then nothing changes."""
        lost = []

        def swapped(entries: list[dict]) -> list[dict]:
            lost[:] = [] if {"batch": made} in entries else [made]
            if lost:
                return [*entries, {"batch": made}]
            return [e for e in entries if e != {"batch": made}] + [{"folder": f} for f in full]

        generations.change(swapped)
        if lost:
            raise RuntimeError("two compactions of one layer ran at the same time")

    def _clear_replaced(self, layer: str) -> None:
        """Deletes what earlier compactions have replaced, or were making when they were killed."""
        generations = self._generations(layer)
        entries = generations.entries()
        for entry in entries:
            if "batch" in entry:
                for path in self._files.matching(f"{self.path(layer)}/dt=*/{BATCH}={entry['batch']}"):
                    self._files.delete(path)
            else:
                day, batch = entry["folder"].split("/")
                self._files.delete(f"{self.path(layer)}/dt={day}/{BATCH}={batch}")
        if entries:
            generations.change(lambda now: [e for e in now if e not in entries])

    def path(self, layer: str) -> str:
        """Folder of a layer."""
        return f"{self.root}/{layer}"

    def read(self, layer: str) -> DataFrame | None:
        """A transaction layer with its ``dt`` column, or None when it was never written."""
        return self._visible(lambda: self._dated(layer))

    def read_audit(self) -> DataFrame | None:
        """Audit events with all columns an event may have, or None when none were written.

        Every delivery of a micro-batch adds its events; ``distinct_events`` keeps one of each.
        """
        return self._visible(lambda: _if_present(lambda: self.spark.read.schema(named(AUDIT_READ)).json(self.path("audit"))))

    def read_rejected(self) -> DataFrame | None:
        """Lines and rows that carried no id, or None when there were none."""
        return self._visible(lambda: self._read(self.path("rejected"), named(REJECTED)))

    def read_labels(self) -> DataFrame | None:
        """Ground-truth labels, or None when there are none."""
        return self._visible(lambda: self._read(self.path("fraud_labels"), named(FRAUD_LABELS)))

    def read_profiles(self) -> DataFrame | None:
        """The card profiles, or None when none was written."""
        deltas = self._profile_deltas()
        if not deltas:
            return None
        return merge_deltas([(e["seq"], self._read(e["folder"], PROFILE)) for e in deltas])

    def append_new(
        self,
        layer: str,
        df: DataFrame,
        stored_ids: DataFrame | None = None,
        unique: bool = False,
        fresh: bool = False,
    ) -> None:
        """Appends the rows whose id is not stored yet; stored rows are never changed.

        ``unique`` says that every row has an id of its own; otherwise rows without an id go to
        the rejected layer and one row of each id is taken, see ``one_per_id``. ``stored_ids``
        may hand over the ids of ``df`` that are known to be stored; ``fresh`` says that none is.
        """
        rows = df.select(*SCHEMAS[layer].names)
        with self.batch() as name:
            if not unique:
                self.append_rejected(rows.filter("transaction_id IS NULL"), f"no id for {layer}")
                rows = one_per_id(rows) if has_repeated_ids(rows) else rows.filter("transaction_id IS NOT NULL")
            met = self.ids_already_in(layer, rows) if stored_ids is None and not fresh else stored_ids
            if met is not None:
                rows = rows.join(met, "transaction_id", "left_anti")
            if layer == "raw" and not self._ids.started() and self.read("raw") is None:
                self._ids.start()
            self._write(layer, rows)
            if layer == "raw" and self._ids.started():
                written = self._written("raw", name, StructType([RAW["transaction_id"]]))
                if written is not None:
                    self._ids.add(written, name)
            if layer == "enriched" and self._partials.exists():
                written = self._written("enriched", name, ENRICHED)
                if written is not None:
                    self._write_report_partials(written, name)

    def _written(self, layer: str, name: str, schema: StructType) -> DataFrame | None:
        """Rows that a batch has written to a layer, or None if it has written none."""
        folders = f"{self.path(layer)}/dt=*/{BATCH}={name}"
        if not self._files.matching(folders):
            return None
        return self.spark.read.option("basePath", self.path(layer)).schema(schema).parquet(folders).select(*schema.names)

    def indexed_ids(self) -> DataFrame:
        """Ids in the index of raw, as ``transaction_id``."""
        return self._ids.read(self._pending()).distinct()

    def rebuild_id_index(self) -> None:
        """Indexes a raw layer that was written before there was an id index."""
        raw = self.read("raw")
        if raw is not None and not self._ids.started():
            self._ids.add(raw.select("transaction_id"), "rebuilt")

    def ids_already_in(self, layer: str, df: DataFrame) -> DataFrame | None:
        """Ids of ``df`` that a layer holds, or None when the layer does not exist.

        Ids of raw come from the id index, of which only the buckets are opened that ids of
        ``df`` fall in. Else the id column of the layer is scanned. With a small ``df`` the join
        broadcasts the ids of ``df``, and the result is never larger than ``df``.
        """
        stored = self.read(layer)
        if stored is None:
            return None
        ids = df.select("transaction_id")
        if layer == "raw" and self._ids.started():
            stored = self._ids.near(ids, self._pending())
        return stored.select("transaction_id").join(ids, "transaction_id", "left_semi").distinct()

    def append_rejected(
        self, rows: DataFrame, reason: str, query_id: str | None = None, epoch: int | None = None
    ) -> None:
        """Appends rows without an id, as the line they came from or else as JSON text."""
        line = F.to_json(F.struct(*[c for c in rows.columns if c != "rejected_line"]), {"timeZone": "UTC"})
        if "rejected_line" in rows.columns:
            line = F.coalesce("rejected_line", line)
        rejected = rows.select(
            F.lit(reason).alias("reason"),
            line.alias("line"),
            F.lit(query_id).cast("string").alias("query_id"),
            F.lit(epoch).cast("long").alias("epoch"),
        )
        if not rejected.isEmpty():
            with self.batch() as name:
                rejected.write.mode("append").parquet(f"{self.path('rejected')}/{BATCH}={name}")

    def append_audit(self, events: DataFrame) -> None:
        """Appends audit events as compressed JSON lines; every call adds its events again."""
        with self.batch() as name:
            writer = events.write.mode("append").options(**JSON_LINES).option("ignoreNullFields", "false")
            writer.json(f"{self.path('audit')}/{BATCH}={name}")

    def write_profiles(self, batch_profiles: DataFrame) -> None:
        """Adds the profiles of a batch as a delta; many deltas are merged into one."""
        with self.batch() as name:
            folder = self._new_profile_folder(batch_profiles)

            def added(entries: list[dict]) -> list[dict]:
                seq = max((e["seq"] for e in entries), default=-1) + 1
                return [*entries, {"seq": seq, "folder": folder, "batch": name, "old": False}]

            self._profiles.change(added)

    def _merge_profiles(self) -> None:
        if len(self._profile_deltas()) > PROFILE_DELTAS:
            self.compact_profiles()

    def compact_profiles(self) -> None:
        """Merges all deltas into one. Replaced folders are deleted one merge later, as readers
        may still use them."""
        deltas = self._profile_deltas()
        if len(deltas) > 1:
            names, last = {e["folder"] for e in deltas}, deltas[-1]["seq"]
            merged = {"seq": last, "folder": self._new_profile_folder(self.read_profiles()), "batch": "merged", "old": False}
            before = [e["folder"] for e in self._profiles.entries() if e["old"]]
            self._profiles.change(lambda entries: [
                merged, *({**e, "old": e["folder"] in names} for e in entries if e["folder"] not in before)])
            for folder in before:
                self._files.delete(folder)

    def _new_profile_folder(self, profiles: DataFrame) -> str:
        folder = f"{self.path('profiles')}/{uuid.uuid4().hex}"
        profiles.select(*PROFILE.names).write.parquet(folder)
        return folder

    def _profile_deltas(self) -> list[dict]:
        """Deltas that count, oldest first."""
        pending = self._pending()
        found = [e for e in self._profiles.entries() if not e["old"] and e["batch"] not in pending]
        return sorted(found, key=lambda e: e["seq"])

    def write_snapshot(self, as_of: date) -> None:
        """Builds the history snapshot as of a day from raw, on top of the newest earlier one."""
        second = int(datetime(as_of.year, as_of.month, as_of.day, tzinfo=timezone.utc).timestamp())
        raw = self.read("raw")
        if raw is None:
            raise LookupError("there is no raw layer to take a snapshot of")
        base = self.snapshot_before(second)
        rows = raw.filter(F.col("dt").isNull() | (F.col("dt") < F.lit(as_of)))
        if base is not None:
            rows = raw.filter((F.col("dt") >= day_literal(base.as_of)) & (F.col("dt") < F.lit(as_of)))
        made = snapshot_of(align(rows), second, base)
        for table in Snapshot.TABLES:
            getattr(made, table).write.mode("overwrite").parquet(f"{self._snapshot_path(second, table)}/{BATCH}=base")
        gone = sorted({*self._snapshots(), second})[:-SNAPSHOTS]
        self._snapshot_list.change(
            lambda entries: [e for e in entries if e["as_of"] not in (*gone, second)] + [{"as_of": second}])
        for old in gone:
            self._files.delete(f"{self.path('snapshots')}/as_of={old}")

    def maintain_snapshot(self, second: int) -> None:
        """Takes the snapshot that a batch of a later second of this day can use, if a day has
        begun since the newest one: it ends a day or more before the day of ``second``."""
        day = (second // 86400 - 1) * 86400
        if self.read("raw") is not None and all(s < day for s in self._snapshots()):
            self.write_snapshot(datetime.fromtimestamp(day, timezone.utc).date())

    def snapshot_before(self, second: int) -> Snapshot | None:
        """The newest snapshot that ends at or before a second."""
        usable = [s for s in self._snapshots() if s <= second]
        if not usable:
            return None
        newest = max(usable)
        paths = [self._snapshot_path(newest, table) for table in Snapshot.TABLES]
        tables = [self._visible(lambda path=path: self.spark.read.parquet(path)) for path in paths]
        return Snapshot(newest, *tables)

    def add_late_rows(self, rows: DataFrame, since: int | None) -> None:
        """Adds stored rows to the snapshots that should have held them.

        Without a late row or a row without time nothing is read or written. Tables may
        repeat rows afterwards; readers take the last per key or only test for presence.
        """
        late = [s for s in self._snapshots() if since is None or s > since]
        for second in late:
            early = rows.filter(F.col("timestamp").isNull() | (F.col("timestamp") < F.timestamp_seconds(F.lit(second))))
            made = snapshot_of(align(early), second)
            with self.batch() as name:
                for table in Snapshot.TABLES:
                    path = f"{self._snapshot_path(second, table)}/{BATCH}={name}"
                    getattr(made, table).write.mode("append").parquet(path)

    def _snapshot_path(self, second: int, table: str) -> str:
        return f"{self.path('snapshots')}/as_of={second}/{table}"

    def _snapshots(self) -> list[int]:
        return [entry["as_of"] for entry in self._snapshot_list.entries()]

    def write_day_moments(self, rows: DataFrame) -> None:
        """Adds the amounts of transactions that are new in raw to the moments of their days."""
        found = day_moments(align(rows)).withColumn("dt", F.date_from_unix_date(F.col("day").cast("int")))
        with self.batch() as name:
            self._write_dated("day_moments", found.withColumn(BATCH, F.lit(name)))

    def read_day_moments(self) -> DataFrame | None:
        """Moments per customer, day and batch, or None when there are none."""
        return self._visible(lambda: self._dated("day_moments"))

    def keep_report_partials(self) -> None:
        """Keeps partial aggregates for reports from now on. Those of stored rows are made once;
        later batches add their own and commit them with their other layers. No batch may be
        written meanwhile. Nothing happens if the store keeps them already."""
        if self._partials.exists():
            return
        with self.batch("partials") as name:
            stored = self.read("enriched")
            if stored is not None:
                self._write_report_partials(stored.drop("dt"), name)
        self._partials.change(lambda entries: entries)

    def _write_report_partials(self, enriched: DataFrame, name: str) -> None:
        # In place of what the batch has written before: it may append more than once.
        for path in self._files.matching(f"{self.path('report_partials')}/dt=*/{BATCH}={name}"):
            self._files.delete(path)
        self._write_dated("report_partials", report_partials(enriched).withColumn(BATCH, F.lit(name)))

    def read_report_partials(self) -> DataFrame | None:
        """Partial aggregates by date and batch, or None when the store keeps none."""
        if not self._partials.exists():
            return None
        found = self._visible(lambda: self._dated("report_partials"))
        dated = StructType(REPORT_PARTIALS.fields + [StructField("dt", DateType())])
        return self.spark.createDataFrame([], dated) if found is None else found

    def write_labels(self, labels: DataFrame) -> None:
        """Appends ground-truth labels."""
        with self.batch() as name:
            path = f"{self.path('fraud_labels')}/{BATCH}={name}"
            labels.select(*FRAUD_LABELS.names).write.mode("append").parquet(path)

    def register_views(self) -> None:
        """Temp views ``raw``, ``enriched``, ``alerts`` and ``fraud_labels``; empty if missing."""
        tables = {name: (self.read(name), schema) for name, schema in SCHEMAS.items()}
        tables["fraud_labels"] = (self.read_labels(), FRAUD_LABELS)
        for name, (table, schema) in tables.items():
            view = self.spark.createDataFrame([], schema) if table is None else table
            view.createOrReplaceTempView(name)

    def export(self, layer: str, target: str, fmt: str) -> None:
        """Writes a layer as Parquet, CSV (arrays as JSON text) or JSON lines."""
        if fmt not in EXPORT_FORMATS:
            raise ValueError(f"unsupported format {fmt!r}: use one of {', '.join(EXPORT_FORMATS)}")
        table = self.read(layer)
        if table is None:
            raise LookupError(f"layer {layer!r} holds no records")
        if fmt == "parquet":
            table.write.parquet(target)
        elif fmt == "csv":
            writer = csv_ready(table).write.option("header", True).option("escape", '"')
            writer.option("timestampFormat", TIME_FORMAT).option("timeZone", "UTC").csv(target)
        else:
            writer = table.write.option("ignoreNullFields", "false")
            writer.option("timestampFormat", TIME_FORMAT).option("timeZone", "UTC").json(target)

    def _read(self, path: str, schema: StructType) -> DataFrame | None:
        return _if_present(lambda: self.spark.read.schema(schema).parquet(path))

    def _write(self, layer: str, df: DataFrame) -> None:
        self._write_dated(layer, df.withColumns({"dt": utc_date(F.col("timestamp")), BATCH: F.lit(self._batch)}))

    def _write_dated(self, layer: str, dated: DataFrame) -> None:
        # Rows of one date meet in few files; a large date is split again by size.
        dated.hint("rebalance", F.col("dt")).write.mode("append").partitionBy("dt", BATCH).parquet(self.path(layer))


def _folder() -> Column:
    """Date and batch of a row as its folder names them; prunes like the two columns."""
    return F.concat(F.coalesce(F.col("dt").cast("string"), F.lit(NO_DATE)), F.lit("/"), F.col(BATCH))


def _date_and_batch(path: str) -> tuple[str, str]:
    day, batch = path.rstrip("/").split("/")[-2:]
    return day.split("=", 1)[1], batch.split("=", 1)[1]


def _level(batch: str) -> int:
    """Level of a folder by its name; 0 for what a batch has written."""
    made = re.match(r"g(\d+)-", batch)
    return int(made[1]) if made else 0


def named(schema: StructType) -> StructType:
    """A stored schema with the name of the batch that wrote a row."""
    return StructType(schema.fields + [StructField(BATCH, StringType(), True)])


def one_per_id(rows: DataFrame) -> DataFrame:
    """One row per id: the latest by time, among equals the greatest by the other columns in
    their order. Rows without an id are left out."""
    others = [c for c in rows.columns if c not in ("transaction_id", "timestamp")]
    latest = F.max(F.struct("timestamp", *others)).alias("latest")
    chosen = rows.filter("transaction_id IS NOT NULL").groupBy("transaction_id").agg(latest)
    return chosen.select("transaction_id", "latest.*").select(*rows.columns)


def has_repeated_ids(rows: DataFrame) -> bool:
    """Whether an id comes more than once; only ids are shuffled for that, not whole rows."""
    counts = rows.filter("transaction_id IS NOT NULL").groupBy("transaction_id").count()
    return bool(counts.agg(F.coalesce(F.max("count"), F.lit(0)) > 1).first()[0])


def distinct_events(audit: DataFrame) -> DataFrame:
    """Audit events with one copy of those that a micro-batch delivered again.

    Events of a stream are one per (event, transaction, query, epoch); events outside of
    streams, which have no epoch, all stay.
    """
    key = ["event", "transaction_id", "query_id", "epoch"]
    streamed = audit.filter("epoch IS NOT NULL")
    others = [c for c in audit.columns if c not in key]
    once = streamed.groupBy(*key).agg(F.min(F.struct("audit_ts", *[c for c in others if c != "audit_ts"])).alias("first"))
    return audit.filter("epoch IS NULL").unionByName(once.select(*key, "first.*"))


def csv_ready(df: DataFrame) -> DataFrame:
    """Array columns as JSON text, the rest unchanged."""
    return df.select(
        *[
            F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def csv_schema(schema: StructType) -> StructType:
    """Schema of the CSV form of a table."""
    return StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, ArrayType) else f.dataType, True)
            for f in schema.fields
        ]
    )


def _if_present(read):
    try:
        return read()
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
