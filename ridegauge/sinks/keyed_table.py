"""Result tables that hold the last row written for each key, in buckets of keys.

A batch writes only its own rows, to a folder of its own with one part per bucket; nothing is
rewritten in place, so a batch that fails half-way or runs twice changes nothing.  A mark of the
table's own, named after the run and holding the schema, follows each finished write; readers see what
is marked.  Before every ``fold_every``-th batch the buckets that were touched since the last fold, and
no others, are written anew with one row per key.  So a read is a plain scan of folded buckets; only
buckets with newer batches have to pick the newest rows.  What a fold supersedes stays until the next
one, for readers that have begun.
"""

from collections import defaultdict
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridegauge.operators.keyed import latest_by
from ridegauge.session import folders, mark, marked, note_of, removed
from ridegauge.sinks.widening import as_schema, merged

_BATCH = "upsert_batch"
_BUCKET = "upsert_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table at ``path``; ``schema`` describes it while it is empty.

    Rows fall into ``buckets`` by the hash of ``cluster``, some of the key's columns (all by default):
    those by which rows are looked up together.  All users of a table name the same of both.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    schema: T.StructType
    fold_every: int = 50
    buckets: int = 16
    cluster: tuple[str, ...] = ()

    def upsert(self, rows: DataFrame, batch: int, run: str = "only") -> None:
        """Write the rows of one batch.  Batch numbers grow, and belong to one ``run``.

        A batch that is already there is left alone; its rows are still computed, because a stream
        that repeats a batch has to write its state.  New columns are added to the table, and a wider
        type widens its column.  The batch numbers of another run (a stream on a new checkpoint) say
        nothing about the batches that are here, so it needs a table of its own and gets an error.
        """
        generation = batch // self.fold_every
        folds, folded = self._folds(), self._last_fold()
        batches = self._batches(folded)
        others = {*folds.values(), *batches.values()} - {run}
        if others:
            raise ValueError(f"{self.path} holds batches of run {others.pop()}, not of {run}")
        if generation < folded or (generation == folded and batch in batches):
            rows.write.format("noop").mode("overwrite").save()
            return
        if generation > folded:
            self._write(self._read(self._touched()), self._fold(generation), run)
            self._remove_before(folded)
        self._write(rows, self._batch(generation, batch), run)

    def read(self) -> DataFrame:
        """The current rows."""
        return self._read()

    def read_like(self, rows: DataFrame) -> DataFrame:
        """The current rows of the buckets that ``rows`` fall into; no other bucket is read."""
        return self._read({r[0] for r in rows.select(self._bucket()).distinct().collect()})

    def rows_of(self, batch: int) -> DataFrame:
        """What a batch of the current generation has written."""
        folder = self._batch(batch // self.fold_every, batch)
        paths = [f"{folder}/{bucket}" for bucket in folders(self.spark, folder)]
        schema = T.StructType.fromJson(note_of(self.spark, folder))
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _bucket(self) -> Column:
        hashed = F.xxhash64(*(self.cluster or self.keys))
        return F.pmod(hashed, F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def _write(self, rows: DataFrame, target: str, run: str) -> None:
        dealt = rows.withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
        dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(target)
        mark(self.spark, target, run, rows.schema.jsonValue())

    def _versions(self, up_to: int, with_batches: bool = True) -> dict[int, list[str]]:
        """The folders that hold each bucket: its newest fold, then the batches since, oldest first."""
        found: dict[int, list[str]] = defaultdict(list)
        for fold in sorted(f for f in self._folds() if f <= up_to):
            for name in folders(self.spark, self._fold(fold)):
                found[int(name.partition("=")[2])] = [f"{self._fold(fold)}/{name}"]
        for batch in sorted(self._batches(up_to)) if with_batches else ():
            for name in folders(self.spark, self._batch(up_to, batch)):
                found[int(name.partition("=")[2])].append(f"{self._batch(up_to, batch)}/{name}")
        return found

    def _touched(self) -> set[int]:
        folded = self._last_fold()
        names = (name for b in self._batches(folded) for name in folders(self.spark, self._batch(folded, b)))
        return {int(name.partition("=")[2]) for name in names}

    def _read(self, wanted: set[int] | None = None) -> DataFrame:
        versions = self._versions(self._last_fold())
        kept = [paths for bucket, paths in versions.items() if wanted is None or bucket in wanted]
        sources = [self._fold(fold) for fold in sorted(self._folds())]
        sources += [self._batch(self._last_fold(), b) for b in sorted(self._batches(self._last_fold()))]
        schemas = {folder: T.StructType.fromJson(note_of(self.spark, folder)) for folder in sources}
        whole = merged([self.schema, *schemas.values()])

        def scanned(paths: list[str]) -> list[DataFrame]:
            alike: dict[T.StructType, list[str]] = defaultdict(list)
            for path in paths:
                alike[schemas[path.rpartition("/")[0]]].append(path)
            return [as_schema(self.spark.read.schema(own).parquet(*found), whole) for own, found in alike.items()]

        done = [paths[0] for paths in kept if len(paths) == 1 and paths[0].startswith(f"{self.path}/folds/")]
        parts = scanned(done)
        open_ = [paths for paths in kept if paths[0] not in done]
        ages = [
            rows.withColumn(_BATCH, F.lit(age))
            for age in range(max(map(len, open_), default=0))
            for rows in scanned([paths[age] for paths in open_ if len(paths) > age])
        ]
        if ages:
            parts.append(latest_by(reduce(DataFrame.union, ages), list(self.keys), _BATCH).select(*whole.names))
        return reduce(DataFrame.union, parts) if parts else self.spark.createDataFrame([], whole)

    def _remove_before(self, folded: int) -> None:
        """Remove what nobody reads who began at the fold ``folded`` or later."""
        needed = {path for paths in self._versions(folded, with_batches=False).values() for path in paths}
        for old in [0, *self._folds()]:
            if old < folded:
                removed(self.spark, self._rows(old))
                names = folders(self.spark, self._fold(old))
                gone = [name for name in names if f"{self._fold(old)}/{name}" not in needed]
                for path in [self._fold(old)] if len(gone) == len(names) else [f"{self._fold(old)}/{n}" for n in gone]:
                    removed(self.spark, path)

    def _rows(self, generation: int) -> str:
        return f"{self.path}/rows/{generation}"

    def _batch(self, generation: int, batch: int) -> str:
        return f"{self._rows(generation)}/{_BATCH}={batch}"

    def _fold(self, generation: int) -> str:
        return f"{self.path}/folds/{generation}"

    def _folds(self) -> dict[int, str]:
        return {int(name): run for name, run in marked(self.spark, f"{self.path}/folds").items()}

    def _last_fold(self) -> int:
        return max(self._folds(), default=0)

    def _batches(self, generation: int) -> dict[int, str]:
        found = marked(self.spark, self._rows(generation))
        return {int(name.partition("=")[2]): run for name, run in found.items()}
