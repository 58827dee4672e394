"""A stored table with one row per key that takes batches of changes.

Rows lie in hash buckets of the key. A batch reads and rewrites only the buckets it
touches, under a new folder name; a manifest says which folder holds which bucket, and the
next manifest is written last. Readers see the table before or after a batch, never in
between, and a batch that broke off leaves nothing behind but unreferenced files. One
writer at a time; superseded folders stay until they are cleaned.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import cut_lineage

BUCKETS = 64
OWN_COLUMNS = ("_bucket", "_created", "_batch")
MANIFEST = "bucket int, folder string, buckets int, fields string"


@dataclass(frozen=True)
class Upserted:
    """Rows received, those refused for a null key, and keys by what happened to them."""

    received: int
    failed: int
    inserted: int
    updated: int
    unchanged: int


def latest_rows(df: DataFrame, key: str, version: str | None) -> DataFrame:
    """One row per key: the highest version, among equals the row that sorts last."""
    whole = F.struct(*[c for c in df.columns])
    order = whole if version is None else F.struct(F.col(version), whole)
    return df.groupBy(key).agg(F.max_by(whole, order).alias("_row")).select("_row.*")


@dataclass(frozen=True)
class KeyedTable:
    """With ``version``, the higher version of a key wins whichever batch brought it, so batches may
    come in any order; without, the later batch wins. ``buckets`` counts for a new table only."""

    spark: SparkSession
    path: str
    key: str
    version: str | None = None
    buckets: int = BUCKETS

    def _numbers(self) -> tuple[list[int], list[int]]:
        """Numbers of all manifests and of the complete ones."""
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return [], []
        found = [s.getPath() for s in files.listStatus(folder)]
        done = [p for p in found if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName()) for p in found), sorted(int(p.getName()) for p in done)

    def _manifest(self) -> list:
        """One line per bucket in use; empty before the first batch."""
        done = self._numbers()[1]
        return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{done[-1]}").collect() if done else []

    def _read(self, lines: list, fields: T.StructType) -> DataFrame:
        stored = T.StructType([*fields.fields, T.StructField("_created", T.StringType()), T.StructField("_batch", T.StringType())])
        if not lines:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(*[f"{self.path}/{r['folder']}" for r in lines])

    def read(self) -> DataFrame:
        """The table's rows as of the last complete batch."""
        lines = self._manifest()
        if not lines:
            raise FileNotFoundError(f"no batch has been written to {self.path}")
        return self._read(lines, T.StructType.fromJson(json.loads(lines[0]["fields"]))).drop("_created", "_batch")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def upsert(self, batch: DataFrame) -> Upserted:
        """Insert new keys and update known ones; doing it again changes nothing.

        Rows with a null key are refused and counted. Of a key's rows in the batch the latest
        counts. A batch that changes no row leaves the table's files as they are.
        """
        if clash := set(OWN_COLUMNS) & set(batch.columns):
            raise ValueError(f"columns {sorted(clash)} are the table's own")
        lines = self._manifest()
        fields, buckets = batch.schema, self.buckets
        if lines:
            fields, buckets = T.StructType.fromJson(json.loads(lines[0]["fields"])), lines[0]["buckets"]
            if [(f.name, f.dataType) for f in fields] != [(f.name, f.dataType) for f in batch.schema]:
                raise ValueError(f"the batch has {batch.schema.simpleString()}, the table {fields.simpleString()}")
        given = cut_lineage(batch)
        rows = given.agg(F.count("*").alias("received"), F.count_if(F.col(self.key).isNull()).alias("failed")).first()
        latest = cut_lineage(latest_rows(given.filter(F.col(self.key).isNotNull()), self.key, self.version).withColumn("_bucket", self._bucket(buckets)))
        touched = {r["_bucket"]: r["count"] for r in latest.groupBy("_bucket").count().collect()}
        keys, stamp = sum(touched.values()), uuid.uuid4().hex
        if not keys:
            return Upserted(rows["received"], rows["failed"], 0, 0, 0)
        kept = [r for r in lines if r["bucket"] not in touched]
        old = self._read([r for r in lines if r["bucket"] in touched], fields)
        folder = f"data/{stamp}"
        self._merged(old, latest, fields.names, buckets, stamp).write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        lines = [*kept, *[(b, f"{folder}/_bucket={b}", buckets, fields.json()) for b in sorted(touched)]]
        written = self._read([r for r in self.spark.createDataFrame(lines[len(kept) :], MANIFEST).collect()], fields).agg(
            F.count_if(F.col("_created") == stamp).alias("inserted"),
            F.count_if((F.col("_batch") == stamp) & (F.col("_created") != stamp)).alias("updated"),
        ).first()
        inserted, updated = written["inserted"], written["updated"]
        if inserted or updated:
            number = max(self._numbers()[0], default=0) + 1
            self.spark.createDataFrame([tuple(r) for r in lines], MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifest/{number}")
        return Upserted(rows["received"], rows["failed"], inserted, updated, keys - inserted - updated)

    def _merged(self, old: DataFrame, latest: DataFrame, names: list[str], buckets: int, stamp: str) -> DataFrame:
        """The touched buckets' rows after the batch, each key's old and new row brought together once."""
        whole = F.struct(*names).alias("_row")
        before = old.select(self._bucket(buckets).alias("_bucket"), F.col(self.key).alias("_key"), whole, F.lit(0).alias("_new"), "_created", "_batch")
        missing = F.lit(None).cast("string")
        now = latest.select("_bucket", F.col(self.key).alias("_key"), whole, F.lit(1).alias("_new"), missing.alias("_created"), missing.alias("_batch"))
        both = before.unionByName(now).repartitionByRange("_bucket", "_key").groupBy("_bucket", "_key").agg(
            F.max(F.when(F.col("_new") == 0, F.col("_row"))).alias("_old"), F.max(F.when(F.col("_new") == 1, F.col("_row"))).alias("_now"),
            F.max("_created").alias("_created"), F.max("_batch").alias("_batch"),
        )
        if self.version is None:
            newer = ~F.col("_now").eqNullSafe(F.col("_old"))
        else:
            newer = F.struct(F.col("_now")[self.version], "_now") > F.struct(F.col("_old")[self.version], "_old")
        takes = F.col("_old").isNull() | (F.col("_now").isNotNull() & newer)
        row = F.when(takes, F.col("_now")).otherwise(F.col("_old"))
        return both.select(
            "_bucket", F.coalesce("_created", F.lit(stamp)).alias("_created"),
            F.when(takes, F.lit(stamp)).otherwise(F.col("_batch")).alias("_batch"), row.alias("_row"),
        ).select("_row.*", "_created", "_batch", "_bucket")
