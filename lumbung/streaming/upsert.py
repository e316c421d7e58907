"""A table of which the newest row of each key counts, kept by upserts of batches, with totals that follow along.

Rows lie in runs: a batch's rows, dealt to buckets by the key's hash, are one directory of Parquet files. A manifest lists the runs of each bucket, oldest first, and is what a version of the table is:
it is moved to its place in one step after the files are written, so a write that broke off leaves nothing behind that is read. A batch rewrites of the buckets that it touches only
those recent runs that together are not twice as large as what it adds; so older, larger runs are rewritten seldom, a row logarithmically often, and a
bucket has few runs. Readers take of each key the row of the latest run.

Batches are known by writer and epoch. A batch that was committed is not committed again; a stream with a new checkpoint is another writer, whose epochs begin anew.
One writer may commit at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import store
from ..operators.relational import keep_last

#: Buckets of a new table, and versions that stay when old ones are removed.
BUCKETS, VERSIONS = 16, 5
_BUCKET, _COMMIT = "_bucket", "_commit"


@dataclass
class Manifest:
    """A version: the runs of each bucket as (folder, rows, first commit), the last epoch of each writer, and where the totals are."""

    version: int = 0
    key: str = "url"
    buckets: int = BUCKETS
    schema: str | None = None
    runs: dict[str, list] = field(default_factory=dict)
    writers: dict[str, int] = field(default_factory=dict)
    totals: str | None = None
    by: list[str] = field(default_factory=list)

    def paths(self, folder: str, buckets: Sequence[int] | None = None) -> list[str]:
        chosen = self.runs if buckets is None else [str(b) for b in buckets if str(b) in self.runs]
        return [f"{folder}/{run}/{_BUCKET}={b}" for b in chosen for run, _ in self.runs[b]]


def _name(version: int) -> str:
    return f"{version:020d}.json"


def manifest(spark: SparkSession, folder: str) -> Manifest | None:
    """The last version; None if there is none."""
    versions = sorted(n for n in store.listed(spark, f"{folder}/manifests") if n.endswith(".json") and not n.startswith("."))
    return Manifest(**json.loads(store.read_text(spark, f"{folder}/manifests/{versions[-1]}"))) if versions else None


def _read(spark: SparkSession, state: Manifest, folder: str, paths: Sequence[str]) -> DataFrame:
    schema = spark.createDataFrame([], _types(state)).schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _types(state: Manifest) -> str:
    return f"{state.schema}, {_COMMIT} bigint"


def _newest(rows: DataFrame, key: str) -> DataFrame:
    return keep_last(rows, key, [_COMMIT])


def upsert(batch: DataFrame, folder: str, writer: str, epoch: int, *, key: str = "url", order: str = "seq", by: Sequence[str] = (), buckets: int = BUCKETS) -> bool:
    """Commits a batch: of each key its last row by `order` replaces what the table has. False if this writer's epoch was committed before.

    by: columns of which the table keeps totals, see totals(); set with the first batch, as are key and buckets. Rows with a null key are one key; columns that a batch lacks are null.
    """
    spark = batch.sparkSession
    now = manifest(spark, folder) or Manifest(key=key, buckets=buckets, by=list(by), schema=", ".join(f"`{n}` {t}" for n, t in batch.dtypes))
    if now.writers.get(writer, -1) >= epoch:
        return False
    names = [f.name for f in spark.createDataFrame([], now.schema).schema]
    full = batch.select(*[F.col(n) if n in batch.columns else F.lit(None).alias(n) for n in names])
    fresh = keep_last(full, now.key, [order]).withColumn(_COMMIT, F.lit(now.version + 1).cast("long")).withColumn(_BUCKET, F.pmod(F.xxhash64(now.key), F.lit(now.buckets)).cast("int"))
    fresh = store.settled(fresh)
    added = {r[0]: r[1] for r in fresh.groupBy(_BUCKET).agg(F.count(F.lit(1))).collect()}  # a row a bucket
    after = Manifest(now.version + 1, now.key, now.buckets, now.schema, dict(now.runs), now.writers | {writer: epoch}, now.totals, now.by)
    if added:
        run, merged = f"data/{now.version + 1:08d}-{uuid.uuid4().hex}", []
        for bucket, rows in added.items():
            kept = list(now.runs.get(str(bucket), []))
            while kept and kept[-1][1] < 2 * rows:
                old, more = kept.pop()
                merged.append(f"{folder}/{old}/{_BUCKET}={bucket}")
                rows += more
            after.runs[str(bucket)] = [*kept, [run, rows]]
        old = _read(spark, now, folder, merged).withColumn(_BUCKET, F.pmod(F.xxhash64(now.key), F.lit(now.buckets)).cast("int"))
        written = _newest(old.unionByName(fresh), now.key) if merged else fresh
        written.repartition(min(len(added), 200), _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{folder}/{run}")
        if now.by:
            after.totals = _follow(spark, now, folder, fresh, sorted(added))
    if not store.write_text(spark, f"{folder}/manifests/{_name(after.version)}", json.dumps(after.__dict__), replace=False):
        raise RuntimeError(f"version {after.version} of {folder} was committed by another writer")
    return True


def _follow(spark: SparkSession, now: Manifest, folder: str, fresh: DataFrame, touched: list[int]) -> str:
    """New totals: those before, plus one for each fresh row, minus one for each row that it replaces. Of the table only keys and `by` are read, in buckets that are touched."""
    before = _read(spark, now, folder, now.paths(folder, touched)).select(now.key, *now.by, _COMMIT)
    mine = fresh.select(F.col(now.key).alias("_key"))
    replaced = _newest(before.join(mine, before[now.key].eqNullSafe(mine["_key"]), "left_semi"), now.key)
    deltas = fresh.select(*now.by, F.lit(1).alias("n")).union(replaced.select(*now.by, F.lit(-1)))
    if now.totals:
        deltas = spark.read.parquet(f"{folder}/{now.totals}").select(*now.by, "n").union(deltas)
    path = f"totals/{now.version + 1:08d}-{uuid.uuid4().hex}"
    deltas.groupBy(*now.by).agg(F.sum("n").cast("long").alias("n")).filter("n <> 0").coalesce(1).write.parquet(f"{folder}/{path}")
    return path


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """The table: of each key the newest row. Buckets of one run need no comparing."""
    now = manifest(spark, folder)
    if now is None:
        raise FileNotFoundError(f"{folder} has no table yet")
    single = [b for b, runs in now.runs.items() if len(runs) == 1]
    several = [b for b in now.runs if b not in single]
    rows = _read(spark, now, folder, now.paths(folder, single))
    if several:
        rows = rows.unionByName(_newest(_read(spark, now, folder, now.paths(folder, several)), now.key))
    return rows.drop(_COMMIT)


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """The number of rows (n) by the columns that the table counts by, as commits have left it: no row of the table is read."""
    now = manifest(spark, folder)
    if now is None or not now.totals:
        raise FileNotFoundError(f"{folder} keeps no totals")
    return spark.read.parquet(f"{folder}/{now.totals}")


def vacuum(spark: SparkSession, folder: str, versions: int = VERSIONS) -> int:
    """Removes manifests before the last `versions`, and what no manifest that stays lists, also of writes that broke off. How many folders went. Not beside a running upsert()."""
    names = sorted(n for n in store.listed(spark, f"{folder}/manifests") if n.endswith(".json") and not n.startswith("."))
    kept = [Manifest(**json.loads(store.read_text(spark, f"{folder}/manifests/{n}"))) for n in names[-versions:]]
    for n in names[:-versions]:
        store.removed(spark, f"{folder}/manifests/{n}")
    used = {run for m in kept for runs in m.runs.values() for run, _ in runs} | {m.totals for m in kept}
    gone = [f"{kind}/{n}" for kind in ("data", "totals") for n in store.listed(spark, f"{folder}/{kind}") if f"{kind}/{n}" not in used]
    for n in gone:
        store.removed(spark, f"{folder}/{n}")
    return len(gone)


def _writer(spark: SparkSession, checkpoint: str) -> str:
    """The name of the stream that a checkpoint is of: kept beside its state, so a new checkpoint is a new writer."""
    path = f"{checkpoint}/writer"
    store.write_text(spark, path, uuid.uuid4().hex, replace=False)
    return store.read_text(spark, path)


def upsert_stream(rows: DataFrame, folder: str, checkpoint: str, order: str = "seq", *, key: str = "url", by: Sequence[str] = (), buckets: int = BUCKETS) -> StreamingQuery:
    """Starts a query that upserts each micro-batch into the table in folder. A batch that is run again after a failure is committed once; old versions are removed on the way."""
    writer = _writer(rows.sparkSession, checkpoint)

    def commit(batch: DataFrame, epoch: int) -> None:
        if upsert(batch, folder, writer, epoch, key=key, order=order, by=by, buckets=buckets) and epoch % VERSIONS == VERSIONS - 1:
            vacuum(batch.sparkSession, folder)

    return rows.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
