"""A table with one row per key that takes changes without being rewritten.

The store is a list of runs, oldest and largest first. A run holds rows of some keys,
hashed into buckets and sorted by key, and never changes. A change writes the changed
keys as a new run; for every key the newest run that has it counts. Runs at the end
are merged as soon as one is less than twice as large as what came after it, so there
are at most about ``log2`` of all rows of them, a row is rewritten about as often, and
what a change writes follows the changed keys and not the table.

A version is a small manifest that names its runs. It is put in place as a whole once
all files are there: readers see the version before or the new one, and a writer that
dies between leaves only files that no manifest names. Writing a version again starts
from the one before it, so a repeated batch replaces itself. Manifests beyond ``keep``
and files that no manifest needs are deleted with each change. There may be one writer
and any number of readers; a reader has ``keep`` changes of time for its query.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.serving import latest_per_key
from .files import Files

VERSION = "version"
BUCKET = "bucket"
#: Rows of one bucket, which is one file; smaller runs are one file.
BUCKET_ROWS = 500_000
#: A run has at most so many buckets smaller than that: with more, the files of a change
#: cost more than their rows.
SMALL_BUCKETS = 128
#: Up to so many requested keys are sent to the files; more are joined.
FEW_KEYS = 10_000


@dataclass
class Run:
    path: str
    rows: int
    buckets: int


@dataclass
class Manifest:
    """One version: its runs, their columns, and whatever the writer adds."""

    version: int
    runs: list[Run]
    schema: dict
    more: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "runs": [vars(run) for run in self.runs],
                "schema": self.schema,
                "more": self.more,
            }
        )

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        runs = [Run(**run) for run in found["runs"]]
        return Manifest(found["version"], runs, found["schema"], found["more"])


class KeyedStore:
    """Rows by ``key`` below ``folder``; see the module text."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: str = "userId",
        keep: int = 4,
        bucket_rows: int = BUCKET_ROWS,
    ):
        self.spark, self.folder, self.key = spark, folder.rstrip("/"), key
        self.keep, self.bucket_rows = max(2, keep), bucket_rows
        self.files = Files(spark, self.folder)

    # Versions

    def versions(self) -> list[int]:
        names = [n for n in self.files.names("manifests") if n.endswith(".json")]
        return sorted(int(n.removesuffix(".json")) for n in names)

    def manifest(self, below: int | None = None) -> Manifest | None:
        """The newest version, older than ``below`` if given; None if there is none."""
        known = [v for v in self.versions() if below is None or v < below]
        return Manifest.of(self.files.read(_manifest_name(known[-1]))) if known else None

    # Reading

    def _read(self, run: Run, manifest: Manifest) -> DataFrame:
        schema = StructType.fromJson(manifest.schema).add(StructField(BUCKET, IntegerType()))
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{run.path}")

    def rows(self, manifest: Manifest | None = None) -> DataFrame:
        """The newest row of every key.

        Each run without the keys of the runs after it. Those are smaller, by half at
        least in all; as long as they may be broadcast the largest run is only scanned.
        """
        manifest = manifest or self._required()
        return self._newest(manifest, manifest.runs)

    def _newest(self, manifest: Manifest, runs: list[Run]) -> DataFrame:
        found = newer = None
        for run in reversed(runs):
            part = self._read(run, manifest).drop(BUCKET)
            keys = part.select(F.col(self.key).alias("newer key"))
            if newer is not None:
                part = part.join(newer, self._is("newer key"), "left_anti")
            found = part if found is None else found.unionByName(part)
            newer = keys if newer is None else newer.unionByName(keys)
        return found

    def lookup(self, requested: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        """The newest rows of the keys in ``requested``, which need not be distinct.

        Up to ``FEW_KEYS`` of them are broadcast, and only the buckets they hash to are
        read: no row of the store is shuffled but those asked for. More are joined.
        """
        manifest = manifest or self._required()
        keys = requested.select(F.col(self.key).alias("asked key")).distinct()
        few = [r[0] for r in keys.limit(FEW_KEYS + 1).collect()]
        if len(few) > FEW_KEYS:
            return self.rows(manifest).join(keys, self._is("asked key"), "left_semi")
        kind = StructType([StructField("asked key", requested.schema[self.key].dataType)])
        asked = self.spark.createDataFrame([(k,) for k in few], kind)
        found = None
        for run in manifest.runs:
            part = self._read(run, manifest)
            if run.buckets > 1:
                hashed = asked.select(_bucket("asked key", run.buckets)).distinct()
                part = part.filter(F.col(BUCKET).isin([r[0] for r in hashed.collect()]))
            part = part.drop(BUCKET).join(F.broadcast(asked), self._is("asked key"), "left_semi")
            found = part if found is None else found.unionByName(part)
        return latest_per_key(found, self.key, [VERSION])

    def _is(self, other: str) -> Column:
        return F.col(self.key).eqNullSafe(F.col(other))

    def _required(self) -> Manifest:
        manifest = self.manifest()
        if manifest is None:
            raise LookupError(f"nothing is stored below {self.folder} yet")
        return manifest

    # Writing

    def write_run(self, rows: DataFrame, version: int, at_most: int) -> Run:
        """Write rows, one per key, as a run that no manifest names yet."""
        full = -(-at_most // BUCKET_ROWS)
        buckets = max(1, min(-(-at_most // self.bucket_rows), max(full, SMALL_BUCKETS)))
        path = f"runs/{version}-{uuid.uuid4().hex[:12]}"
        (
            rows.withColumn(BUCKET, _bucket(self.key, buckets))
            .repartition(buckets, BUCKET)
            .sortWithinPartitions(BUCKET, self.key)
            .write.option("compression", "zstd")
            .partitionBy(BUCKET)
            .parquet(f"{self.folder}/{path}")
        )
        written = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{path}").count()
        return Run(path, written, buckets)

    def run_rows(self, run: Run, schema: StructType) -> DataFrame:
        """The rows of one run, also before a manifest names it."""
        return self._read(run, Manifest(0, [], schema.jsonValue()))

    def commit(
        self,
        version: int,
        before: Manifest | None,
        run: Run | None,
        schema: StructType,
        more: dict,
    ) -> Manifest:
        """Make ``version`` out of the one before it and a new run, and tidy up."""
        runs = [*(before.runs if before else [])] + ([run] if run and run.rows else [])
        now = Manifest(version, runs, schema.jsonValue(), more)
        now.runs = self._compacted(now)
        self.files.write(_manifest_name(version), now.text())
        self._tidy(version)
        return now

    def _compacted(self, now: Manifest) -> list[Run]:
        """Merges the runs at the end that have become too much alike in size."""
        runs = now.runs
        first = merged_from(runs)
        if first >= len(runs) - 1:
            return runs
        merged = self._newest(now, runs[first:])
        return [*runs[:first], self.write_run(merged, now.version, sum(r.rows for r in runs[first:]))]

    def _tidy(self, version: int) -> None:
        known = [v for v in self.versions() if v <= version]
        for old in known[: -self.keep]:
            self.files.delete(_manifest_name(old))
        kept = [Manifest.of(self.files.read(_manifest_name(v))) for v in self.versions()]
        needed = {run.path.removeprefix("runs/") for m in kept for run in m.runs}
        for name in self.files.names("runs"):
            if name not in needed:
                self.files.delete(f"runs/{name}")


def merged_from(runs: list[Run]) -> int:
    """The first of the last runs that are to be one: those less than twice what follows."""
    first = len(runs) - 1
    after = runs[first].rows if runs else 0
    while first > 0 and runs[first - 1].rows < 2 * after:
        first -= 1
        after += runs[first].rows
    return first


def _manifest_name(version: int) -> str:
    return f"manifests/{version:012d}.json"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)
