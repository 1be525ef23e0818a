"""N1-N4, N6-N9 against a large history: an index of history's keys.

The index holds the keys of all loaded rows, nothing else, in ``buckets``
folders by a hash of the key, and grows with each load (one commit, so that a
load which is repeated adds nothing).  A batch reads only the buckets its own
keys fall into; where the batch's keys are measured to be few they are sent to
that scan, and no row of history is shuffled.  Otherwise both sides meet in a
shuffle of keys.

Keys are stored null-safe (a null is its type's placeholder and a flag), as
``new_rows`` compares them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.incremental import matched_keys
from ledgerline.operators.joins import normalised_keys, spread_join
from ledgerline.operators.lifecycle import Run
from ledgerline.operators.staging import staged_measured
from ledgerline.sources.commits import Commit, append_committed, commits, read_committed

BUCKETS = 256


def _keyed(df: DataFrame, keys: list[str], types: dict[str, str], buckets: int) -> tuple[DataFrame, list[str]]:
    """Key columns as stored, and their bucket."""
    cast = df.withColumns({f"__x{i}": F.col(k).cast(types[k]) for i, k in enumerate(keys)})
    keyed, names = normalised_keys(cast, [f"__x{i}" for i in range(len(keys))], "__k")
    return keyed.drop(*[f"__x{i}" for i in range(len(keys))]).withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")), names


class KeyIndex:
    """The index at ``path`` for keys of the given types (name -> type)."""

    def __init__(self, spark: SparkSession, path: str, types: dict[str, str], buckets: int = BUCKETS):
        self.spark, self.path, self.types, self.buckets = spark, path.rstrip("/"), dict(types), buckets
        self.keys = list(types)

    def add(self, rows: DataFrame, load: str, run: Run) -> Commit:
        """Add the keys of a load; each key once.  Rows of a bucket are brought
        together, so a load adds one file a bucket."""
        keyed, names = _keyed(rows.select(*self.keys), self.keys, self.types, self.buckets)
        each = keyed.select(*names, "__bucket").distinct().repartition("__bucket")
        return append_committed(each, self.path, load, run, "key_index", partition_by="__bucket")

    def _read(self, wanted: list[int], names: list[str]) -> DataFrame:
        """Keys of the wanted buckets; other buckets' files are not opened."""
        stored = read_committed(self.spark, self.path)
        if stored is None:
            none = self.spark.createDataFrame([], ", ".join(f"`{k}` {t}" for k, t in self.types.items()))
            return _keyed(none, self.keys, self.types, self.buckets)[0].select(*names)
        return stored.filter(F.col("__bucket").isin(wanted)).select(*names)

    def _joined(self, batch: DataFrame, how: str, keys: list[str] | None) -> DataFrame:
        own = keys or self.keys
        keyed, names = _keyed(batch, own, dict(zip(own, self.types.values())), self.buckets)
        few, size = staged_measured(keyed.select(*names, "__bucket").distinct(), "batch-keys")
        wanted = sorted(r["__bucket"] for r in few.select("__bucket").distinct().collect())  # ``buckets`` at most
        known = matched_keys(self._read(wanted, names), (few.select(*names), size), names)
        return spread_join(keyed, known, names, how).select(*batch.columns)

    def new_rows(self, batch: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """Rows of ``batch`` whose key no load has added."""
        return self._joined(batch, "left_anti", keys)

    def existing_rows(self, batch: DataFrame, keys: list[str] | None = None) -> DataFrame:
        return self._joined(batch, "left_semi", keys)

    def catch_up(self, table: str, run: Run) -> list[str]:
        """Add the committed loads of ``table`` that the index lacks, as after a
        run that died between the two commits; returns their names."""
        have = {r["load"] for r in commits(self.spark, self.path).select("load").collect()}
        late = sorted(r["load"] for r in commits(self.spark, table).select("load").collect() if r["load"] not in have)
        for load in late:
            rows = read_committed(self.spark, table, [load])
            if rows is not None:
                self.add(rows, load, run)
        return late
