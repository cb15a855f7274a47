"""A versioned table kept as an append log of batches plus a commit log.

Layout under ``root``::

    data/batch_id=N/part-*.parquet   rows written by commit N (immutable)
    _commits/part-*.parquet           one row per commit (metadata only)

A data commit writes its rows to ``batch_id=N`` (overwriting only that
directory, so a replayed commit is idempotent) and then appends one commit
row.  Reads resolve which batches a version can see from the commit log and
filter on the ``batch_id`` partition column, so Spark prunes whole
directories before it lists files.  With declared keys, the table is the
latest row per key over the visible batches (upsert on read).

Commits and the choice of a version's batches read the log on the driver: one
small row per commit, never table data.  ``history``, ``snapshots``,
``rows_growing`` and ``version_at`` are queries over the log.  Limits: one writer at a time, no atomic
multi-table commit; this is a convention over Parquet, not a table format.

Schemas carry a field id per column (``metadata.field_id``).  Renames keep
the id, so old files are read by id and come back under the new name;
dropped ids are not read; added ids read NULL from older files; widened
types are cast on read.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.upsert import upsert_by_key

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("committed_at", T.TimestampNTZType()),
    T.StructField("operation", T.StringType()),
    T.StructField("batch_id", T.LongType()),       # data written by this commit
    T.StructField("parent", T.LongType()),         # version current before it
    T.StructField("target", T.LongType()),         # rollback target
    T.StructField("schema_json", T.StringType()),  # table schema after it
    T.StructField("token", T.StringType()),        # caller's idempotency token
    T.StructField("added_rows", T.LongType()),     # rows an append brought in; 0 for other commits
    T.StructField("total_rows", T.LongType()),     # rows of the append log after it
    # Versions that this one does not descend from: those strictly between, one entry per rollback in its ancestry.
    T.StructField("skipped", T.ArrayType(T.StructType([T.StructField("after", T.LongType()), T.StructField("before", T.LongType())]))),
])

# Type changes allowed by widen_type (old simple type -> new simple type).
_WIDEN = {("int", "bigint"), ("float", "double"), ("smallint", "int"),
          ("smallint", "bigint"), ("tinyint", "smallint"), ("tinyint", "int"),
          ("tinyint", "bigint")}


def _with_ids(schema: T.StructType, start: int = 1) -> T.StructType:
    fields, nxt = [], start
    for f in schema.fields:
        fid = f.metadata.get("field_id")
        if fid is None:
            fid, nxt = nxt, nxt + 1
        fields.append(T.StructField(f.name, f.dataType, True, {"field_id": fid}))
    return T.StructType(fields)


def _max_id(schema: T.StructType) -> int:
    return max([f.metadata.get("field_id", 0) for f in schema.fields] or [0])


def _ntz(ts) -> dt.datetime:
    if ts is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(ts, str):
        return dt.datetime.fromisoformat(ts)
    return ts


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, keys: list[str] | None = None,
                 ts: str = "ts", seq: str = "seq"):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.ts, self.seq = keys, ts, seq
        self.data_path = f"{self.root}/data"
        self.log_path = f"{self.root}/_commits"
        self._log_cache: list | None = None

    # ------------------------------------------------------------ commit log
    def commits(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).parquet(self.log_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise  # an unreadable log is not an empty one
            return self.spark.createDataFrame([], COMMIT_SCHEMA)

    def _log(self) -> list:
        """Commit rows on the driver, oldest first (metadata only).

        Cached per instance and dropped by every write through it; another
        writer's commits are seen after ``refresh()``.
        """
        if self._log_cache is None:
            self._log_cache = sorted(self.commits().collect(), key=lambda r: r.version)
        return self._log_cache

    def refresh(self) -> "VersionedTable":
        self._log_cache = None
        return self

    def _append_commit(self, **row) -> int:
        log = self._log()
        version = (log[-1].version + 1) if log else 1
        parent = log[-1].version if log else None
        # A rollback goes on from its target, any other commit from its parent.
        base = next((r for r in log if r.version == row["target"]), None) if row.get("target") is not None else (log[-1] if log else None)
        added = row.get("added_rows", 0)
        skipped = [tuple(x) for x in (base.skipped or [])] if base else []
        if row.get("target") is not None:
            skipped.append((row["target"], version))
        rec = {"version": version, "committed_at": _ntz(row.get("committed_at")),
               "operation": row["operation"], "batch_id": row.get("batch_id"),
               "parent": parent, "target": row.get("target"),
               "schema_json": row.get("schema_json") or (log[-1].schema_json if log else None),
               "token": row.get("token"), "added_rows": added,
               "total_rows": (base.total_rows or 0 if base else 0) + added, "skipped": skipped}
        (self.spark.createDataFrame([rec], COMMIT_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.log_path))
        self.refresh()
        return version

    def current_version(self) -> int | None:
        log = self._log()
        return log[-1].version if log else None

    def schema(self, version: int | None = None) -> T.StructType | None:
        log = self._upto(version)
        for r in reversed(log):
            if r.schema_json:
                return T.StructType.fromJson(json.loads(r.schema_json))
        return None

    def _last_id(self) -> int:
        """Highest field id ever given out, dropped columns included: ids are never reused."""
        seen = {r.schema_json for r in self._log() if r.schema_json}
        return max([_max_id(T.StructType.fromJson(json.loads(j))) for j in seen] or [0])

    def _upto(self, version: int | None) -> list:
        log = self._log()
        if version is None:
            return log
        return [r for r in log if r.version <= version]

    # ------------------------------------------------------------ writes
    def _data_schema(self, df: DataFrame, evolve: bool) -> T.StructType:
        cur = self.schema()
        if cur is None:
            return _with_ids(df.schema)
        names = {f.name for f in cur.fields}
        extra = [f for f in df.schema.fields if f.name not in names]
        if extra and not evolve:
            raise ValueError(f"columns not in the table schema: {[f.name for f in extra]}")
        return T.StructType(cur.fields + _with_ids(T.StructType(extra), self._last_id() + 1).fields)

    def commit(self, df: DataFrame, committed_at=None, evolve: bool = False,
               token: str | None = None) -> int:
        """Append ``df`` as one new version.

        With a ``token`` (e.g. "<query id>:<micro-batch id>") a commit that
        already happened is not repeated: a retry after a crash between the
        commit row and the caller's own bookkeeping returns the old version.
        A crash before the commit row leaves an uncommitted directory that no
        reader sees and that the retry overwrites.
        """
        log = self._log()
        if token is not None:
            done = [r.version for r in log if r.token == token]
            if done:
                return done[0]
        schema = self._data_schema(df, evolve)
        version = (log[-1].version + 1) if log else 1
        # Rows take the table's declared types, so all files of one schema
        # epoch share physical types (a failing cast is a schema violation).
        cols = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                for f in schema.fields if f.name in df.columns]
        path = f"{self.data_path}/batch_id={version}"
        df.select(*cols).write.mode("overwrite").parquet(path)
        added = self.spark.read.schema(schema).parquet(path).count()  # from the file footers
        return self._append_commit(operation="append", batch_id=version, committed_at=committed_at,
                                   schema_json=schema.json(), token=token, added_rows=added)

    def bulk_commit(self, df: DataFrame, batch: Column, committed_at: Column) -> None:
        """Backfill: one version per distinct ``batch`` value, in one write job.

        Versions are the batch values (positive longs, increasing in commit
        order); commit times are max(committed_at) per batch.  Rows go to
        their ``batch_id=N`` directories through one partitioned write with
        dynamic overwrite, so a rerun replaces exactly the same directories.
        """
        if self._log():
            raise ValueError("bulk_commit backfills an empty table")
        schema = _with_ids(df.schema)
        staged = df.withColumn("batch_id", batch.cast("long")).withColumn("_cat", committed_at)
        (staged.drop("_cat").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.data_path))
        by_version = Window.orderBy("version")  # one row per commit
        log = (staged.groupBy("batch_id").agg(F.max("_cat").cast("timestamp_ntz").alias("committed_at"),
                                              F.count(F.lit(1)).alias("added_rows"))
               .select(F.col("batch_id").alias("version"), "committed_at",
                       F.lit("append").alias("operation"), "batch_id", "added_rows")
               .withColumn("parent", F.lag("version").over(by_version))
               .withColumn("target", F.lit(None).cast("long"))
               .withColumn("total_rows", F.sum("added_rows").over(by_version.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("skipped", F.array().cast(COMMIT_SCHEMA["skipped"].dataType))
               .withColumn("schema_json", F.lit(schema.json()))
               .withColumn("token", F.lit(None).cast("string")))
        log.select(*COMMIT_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(self.log_path)
        self.refresh()

    def compact(self, committed_at=None) -> int:
        """Rewrite the current state as one batch (latest row per key).

        Later reads of the current version touch only that batch; earlier
        versions stay readable from their own batches.  Retention (deleting
        batches no version needs) is left to the operator.
        """
        state = self.snapshot()
        log = self._log()
        version = (log[-1].version + 1) if log else 1
        state.write.mode("overwrite").parquet(f"{self.data_path}/batch_id={version}")
        return self._append_commit(operation="compact", batch_id=version, committed_at=committed_at,
                                   schema_json=self.schema().json())

    def rollback_to(self, version: int, committed_at=None) -> int:
        """New commit whose visible data is that of ``version`` (no data rewritten)."""
        if version not in {r.version for r in self._log()}:
            raise ValueError(f"no version {version}")
        return self._append_commit(operation="rollback", target=version, committed_at=committed_at,
                                   schema_json=self.schema(version).json())

    # ------------------------------------------------------------ schema changes
    def _schema_commit(self, schema: T.StructType, op: str, committed_at=None) -> int:
        return self._append_commit(operation=op, committed_at=committed_at, schema_json=schema.json())

    def add_column(self, name: str, dtype: str, committed_at=None) -> int:
        cur = self.schema()
        if name in cur.fieldNames():
            raise ValueError(f"column {name} exists")
        f = T.StructField(name, T.DataType.fromDDL(dtype), True, {"field_id": self._last_id() + 1})
        return self._schema_commit(T.StructType(cur.fields + [f]), "add_column", committed_at)

    def _require(self, name: str) -> T.StructType:
        cur = self.schema()
        if name not in cur.fieldNames():
            raise ValueError(f"no column {name}")
        return cur

    def drop_column(self, name: str, committed_at=None) -> int:
        cur = self._require(name)
        return self._schema_commit(T.StructType([f for f in cur.fields if f.name != name]),
                                   "drop_column", committed_at)

    def rename_column(self, old: str, new: str, committed_at=None) -> int:
        cur = self._require(old)
        if new in cur.fieldNames():
            raise ValueError(f"column {new} exists")
        fields = [T.StructField(new, f.dataType, True, f.metadata) if f.name == old else f
                  for f in cur.fields]
        return self._schema_commit(T.StructType(fields), "rename_column", committed_at)

    def reorder_columns(self, order: list[str], committed_at=None) -> int:
        cur = {f.name: f for f in self.schema().fields}
        missing = [n for n in order if n not in cur]
        if missing:
            raise ValueError(f"no columns {missing}")
        rest = [n for n in cur if n not in order]
        return self._schema_commit(T.StructType([cur[n] for n in order + rest]),
                                   "reorder_columns", committed_at)

    def widen_type(self, name: str, dtype: str, committed_at=None) -> int:
        cur = self._require(name)
        new_t = T.DataType.fromDDL(dtype)
        fields = []
        for f in cur.fields:
            if f.name == name:
                old, new = f.dataType, new_t
                ok = (old.simpleString(), new.simpleString()) in _WIDEN or (
                    isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType)
                    and new.scale == old.scale and new.precision >= old.precision)
                if not ok:
                    raise ValueError(f"cannot widen {old.simpleString()} to {new.simpleString()}")
                f = T.StructField(f.name, new, True, f.metadata)
            fields.append(f)
        return self._schema_commit(T.StructType(fields), "widen_type", committed_at)

    # ------------------------------------------------------------ reads
    def visible_batches(self, version: int | None = None, logical: bool = False) -> list[int]:
        """Batch ids seen by ``version`` (default: current), following rollbacks.

        ``logical`` lists the appended batches, looking through compactions,
        which rewrite rows without changing the table's contents.
        """
        log = self._log()
        by_v = {r.version: r for r in log}
        if not log:
            return []
        v = version if version is not None else log[-1].version
        if v not in by_v:
            raise ValueError(f"no version {v}")
        out: list[int] = []
        while v is not None:
            r = by_v[v]
            if r.operation == "rollback":
                v = r.target
                continue
            if r.operation == "compact" and logical:
                v = r.parent
                continue
            if r.batch_id is not None:
                out.append(r.batch_id)
            if r.operation == "compact":  # holds the whole state of its parent
                break
            v = r.parent
        return sorted(out)

    def version_at(self, ts) -> int:
        """Newest version committed at or before ``ts``."""
        t = _ntz(ts)
        newest = self.commits().where(F.col("committed_at") <= F.lit(t).cast("timestamp_ntz")).agg(F.max("version")).first()[0]
        if newest is None:
            raise ValueError(f"no version at or before {ts}")
        return newest

    def log_rows(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """All visible rows (no upsert), projected onto the version's schema.

        ``only`` reads these appended batches instead of all visible ones.
        """
        batches = self.visible_batches(version) if only is None else sorted(only)
        schema = self.schema(version)
        if not batches:
            return self.spark.createDataFrame([], T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())]))
        by_schema: dict[str, list[int]] = {}
        write_schema = {r.batch_id: r.schema_json for r in self._log() if r.batch_id is not None}
        for b in batches:
            by_schema.setdefault(write_schema[b], []).append(b)
        parts = []
        for sj, bs in by_schema.items():
            old = T.StructType.fromJson(json.loads(sj))
            old_by_id = {f.metadata["field_id"]: f for f in old.fields}
            raw = (self.spark.read.option("basePath", self.data_path)
                   .parquet(*[f"{self.data_path}/batch_id={b}" for b in bs])
                   .where(F.col("batch_id").isin(bs)))
            cols = []
            for f in schema.fields:
                src = old_by_id.get(f.metadata["field_id"])
                c = F.col(f"`{src.name}`") if src is not None and src.name in raw.columns else F.lit(None)
                cols.append(c.cast(f.dataType).alias(f.name))
            parts.append(raw.select(*cols, F.col("batch_id").cast("long").alias("batch_id")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def snapshot(self, version: int | None = None, touched: DataFrame | None = None) -> DataFrame:
        """The table as of ``version``; with ``touched``, only the rows whose keys it holds."""
        rows = self.log_rows(version)
        if touched is not None:
            t = touched.select(*[F.col(k).alias(f"_t_{k}") for k in self.keys])
            rows = rows.join(t, reduce(lambda x, y: x & y, [rows[k].eqNullSafe(F.col(f"_t_{k}")) for k in self.keys]), "left_semi")
        if not self.keys:
            return rows.drop("batch_id")
        return upsert_by_key(rows.drop("batch_id"), self.keys, self.ts, self.seq)

    def as_of_time(self, ts) -> DataFrame:
        return self.snapshot(self.version_at(ts))

    # ------------------------------------------------------------ metadata tables
    def snapshots(self) -> DataFrame:
        """version, committed_at, operation, parent, added_rows: the commit log alone, no data read."""
        return self.commits().select("version", "committed_at", "operation", "parent",
                                     F.coalesce("added_rows", F.lit(0)).alias("added_rows"))

    def history(self) -> DataFrame:
        """Order in which versions became current; marks ancestors of the current one."""
        # The newest commit names the versions that rollbacks have cut off: one row, joined back to the log.
        c = self.commits()
        newest = c.agg(F.max_by("skipped", "version").alias("_cut"))
        cut = F.exists("_cut", lambda x: (F.col("version") > x["after"]) & (F.col("version") < x["before"]))
        return c.join(newest).select(F.col("committed_at").alias("made_current_at"), "version", "parent",
                                     F.coalesce(~cut, F.lit(True)).alias("is_current_ancestor"))

    def files(self) -> DataFrame:
        """One row per data file of a committed batch: path, size, record count, batch id."""
        committed = [r.batch_id for r in self._log() if r.batch_id is not None]
        if not committed:
            return self.spark.createDataFrame([], "file_path string, file_size long, batch_id long, record_count long")
        # Directories without a commit (a crash, a write in progress) are no part of the table.
        raw = self.spark.read.parquet(self.data_path).where(F.col("batch_id").isin(committed))
        return (raw.select(F.col("_metadata.file_path").alias("file_path"),
                           F.col("_metadata.file_size").alias("file_size"),
                           F.col("batch_id").cast("long").alias("batch_id"))
                .groupBy("file_path", "file_size", "batch_id")
                .agg(F.count(F.lit(1)).alias("record_count")))

    def manifests(self) -> DataFrame:
        """Files grouped by the commit that added them."""
        return (self.files().groupBy("batch_id")
                .agg(F.count(F.lit(1)).alias("file_count"),
                     F.sum("file_size").alias("total_bytes"),
                     F.sum("record_count").alias("row_count")))

    def diff(self, v_old: int, v_new: int) -> DataFrame:
        """Rows added, removed or changed between two versions (by key).

        Only keys in the batches that one version sees and the other does not can
        differ: those batches are read first, and all others for their keys alone.
        Versions with different columns are compared in full.
        """
        if not self.keys:
            # Append-only: the difference is whole batches, found from the
            # commit log alone; only those directories are read.
            b_old, b_new = set(self.visible_batches(v_old, logical=True)), set(self.visible_batches(v_new, logical=True))
            added = self.log_rows(v_new, b_new - b_old).drop("batch_id").withColumn("change", F.lit("added"))
            removed = self.log_rows(v_old, b_old - b_new).drop("batch_id").withColumn("change", F.lit("removed"))
            return added.unionByName(removed, allowMissingColumns=True)
        touched = None
        if self.schema(v_old).fieldNames() == self.schema(v_new).fieldNames():
            b_old, b_new = (set(self.visible_batches(v, logical=True)) for v in (v_old, v_new))
            touched = (self.log_rows(v_new, b_new - b_old).select(*self.keys)
                       .union(self.log_rows(v_old, b_old - b_new).select(*self.keys)).distinct())
        old, new = self.snapshot(v_old, touched), self.snapshot(v_new, touched)
        rest = [c for c in new.columns if c not in self.keys]
        # A column that the old version lacks compares as NULL.
        was = [F.col(c) if c in old.columns else F.lit(None).cast(new.schema[c].dataType).alias(c) for c in rest]
        o = old.select(*[F.col(k).alias(f"_o_{k}") for k in self.keys], F.struct(*was).alias("_old"))
        n = new.select(*[F.col(k).alias(f"_n_{k}") for k in self.keys], F.struct(*rest).alias("_new"))
        same = reduce(lambda x, y: x & y, [F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in self.keys])
        j = o.join(n, same, "full_outer").select(
            *[F.coalesce(f"_n_{k}", f"_o_{k}").alias(k) for k in self.keys], "_old", "_new")
        change = (F.when(F.col("_old").isNull(), "added")
                  .when(F.col("_new").isNull(), "removed")
                  .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
        return (j.withColumn("change", change).where(F.col("change").isNotNull())
                .select(*self.keys, "change", "_old", "_new"))

    def rows_growing(self) -> DataFrame:
        """Rows in the append log after each commit; flags commits that did not grow it.

        Only appends add rows: a compaction keeps the total, and a rollback
        brings back the total of its target.  Read from the commit log alone.
        """
        c = self.commits()
        before = c.select(F.col("version").alias("_v"), F.col("total_rows").alias("_before"))
        return (c.join(before, c["parent"] == F.col("_v"), "left")
                .select("version", F.coalesce("added_rows", F.lit(0)).alias("added_rows"), "total_rows",
                        (F.col("parent").isNull() | (F.col("total_rows") > F.col("_before"))).alias("growing")))
