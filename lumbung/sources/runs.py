"""Runs that can be broken off: phases written to a folder, each known by a fingerprint of all that its rows depend on."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, is_dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import store


def digest(about: object) -> str:
    """The same for the same values, in any process; the order of categories in a lexicon counts."""
    plain = json.dumps(about, default=lambda x: asdict(x) if is_dataclass(x) else str(x), ensure_ascii=False)
    return hashlib.sha256(plain.encode()).hexdigest()[:32]


def _files(table: DataFrame) -> list[tuple[str, int, int]]:
    folders: dict[str, list[str]] = {}
    for path in map(unquote, table.inputFiles()):
        folders.setdefault(path.rpartition("/")[0], []).append(path.rpartition("/")[2])
    there = {folder: store.listed(table.sparkSession, folder) for folder in folders}
    return sorted((f"{folder}/{n}", *there[folder].get(n, (-1, -1))) for folder, names in folders.items() for n in names)


def fingerprint(table: DataFrame) -> str:
    """Of a table's rows: its plan with the names, lengths and times of its files. Rows that are not from files, as of local tables, are hashed themselves, whatever their order."""
    plan = table._jdf.queryExecution().analyzed().canonicalized().toString()
    files = _files(table)
    known = files and not any(x in plan for x in ("LocalRelation", "LogicalRDD", "ExternalRDD", "InMemoryRelation"))
    if known:
        return digest([plan, files])
    each = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in table.columns])
    return digest([table.schema.json(), list(map(str, table.agg(F.count(F.lit(1)), F.bit_xor(each), F.sum(each.cast("decimal(20,0)"))).first()))])


class Run:
    """Phases of one run in a folder: <phase>/<fingerprint>, with a manifest beside it that is written last and lists the files.

    about: what all phases depend on. A phase's fingerprint has that of those before it, so when a setting or an input changes, the phases that depend on it are made again, and rows of another run are
    never taken. A phase whose files are not as its manifest says is made again too. Several runs may share a folder.
    """

    def __init__(self, spark: SparkSession, folder: str, about: object) -> None:
        self.spark, self.folder, self.mark = spark, folder, digest(about)

    def phase(self, name: str, inputs: Sequence[DataFrame], make: Callable[[], DataFrame]) -> DataFrame:
        """The phase's rows, read from the folder; made and written first if they are not there."""
        self.mark = digest([self.mark, name, [fingerprint(t) for t in inputs]])
        path = f"{self.folder}/{name}/{self.mark}"
        if not self._whole(path):
            made = make()
            made.write.mode("overwrite").parquet(path)
            files = {n: size for n, (size, _) in store.listed(self.spark, path).items()}
            store.write_text(self.spark, f"{path}.json", json.dumps({"phase": name, "files": files, "schema": made.schema.json()}))
        return self.spark.read.parquet(path)

    def _whole(self, path: str) -> bool:
        manifest = store.read_text(self.spark, f"{path}.json")
        if manifest is None:
            return False
        there = store.listed(self.spark, path)
        return all(there.get(n, (-1, 0))[0] == size for n, size in json.loads(manifest)["files"].items())


def phases_of(spark: SparkSession, folder: str) -> dict[str, int]:
    """Phases in a folder, and of how many runs each is written whole."""
    return {name: n for name in store.listed(spark, folder) if (n := sum(f.endswith(".json") and not f.startswith(".") for f in store.listed(spark, f"{folder}/{name}")))}
