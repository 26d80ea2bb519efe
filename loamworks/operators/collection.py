"""Vector collections: immutable Parquet folders, and manifests of those that hold."""

from __future__ import annotations

import functools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loamworks.schemas import VECTOR

_SEGMENT = T.StructType([*VECTOR.fields, T.StructField("gone", T.BooleanType())])


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    """old with the rows of new (id, embedding, text, metadata, namespace, seq) put in by id.

    The row of the highest seq wins; the namespace stays that of the first row of the id. Aggregated before the shuffle.
    """
    columns = ["embedding", "text", "metadata"]
    both = old.select("id", *columns, "namespace", F.lit(-1).cast("long").alias("seq")).unionByName(new.select("id", *columns, "namespace", F.col("seq").cast("long")))
    last = both.groupBy("id").agg(F.max_by(F.struct(*columns), "seq").alias("row"), F.min_by("namespace", "seq").alias("namespace"))
    return last.select("id", *[f"row.{c}" for c in columns], "namespace")


def deleted(old: DataFrame, ids: DataFrame) -> DataFrame:
    """old without the given ids, whatever their namespace."""
    return old.join(ids.select("id"), "id", "left_anti")


#: Segments that a collection gathers before they are merged into its base.
SEGMENTS = 8


class Collection:
    """A collection in a folder all executors reach: a base, and segments of what was put in or taken out since.

    An upsert writes a segment of the size of its batch; after SEGMENTS of them the base is written anew. Each version
    is an immutable manifest, renamed into its place when all that it names is complete, so readers see one version or
    the next; a writer that another one has overtaken fails.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        fs, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._path = lambda name: fs.Path(f"{self.folder}/{name}")
        self._files = self._path("versions").getFileSystem(conf)
        self._context = fs.FileContext.getFileContext(self._path("versions").toUri(), conf)

    def version(self) -> int:
        """Number of the version that holds; 0 for none."""
        if not self._files.exists(self._path("versions")):
            return 0
        return max((int(x.getPath().getName()) for x in self._files.listStatus(self._path("versions")) if x.getPath().getName().isdigit()), default=0)

    def _manifest(self, version: int) -> dict:
        if version == 0:
            return {"base": 0, "segments": []}
        stream = self._files.open(self._path(f"versions/{version:08d}"))
        try:
            return json.loads(stream.readUTF())
        finally:
            stream.close()

    def ensure(self) -> None:
        """Make an empty collection if there is none."""
        if self.version() == 0:
            self._commit({"base": 0, "segments": []}, 1)

    def read(self, namespace: str | None = None, version: int | None = None) -> DataFrame:
        """Rows of the collection, of the newest version by default; a namespace prunes partitions of the base."""
        held = self._manifest(self.version() if version is None else version)
        base = self.spark.read.schema(VECTOR).parquet(f"{self.folder}/base-{held['base']:08d}") if held["base"] else self.spark.createDataFrame([], VECTOR)
        if held["segments"]:
            parts = [self.spark.read.schema(_SEGMENT).parquet(f"{self.folder}/segment-{x:08d}").withColumn("version", F.lit(x)) for x in held["segments"]]
            late = functools.reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.max_by(F.struct(*_SEGMENT.names[1:]), "version").alias("row"))
            put = late.where("not row.gone").select("id", *[f"row.{c}" for c in VECTOR.names[1:]])
            base = base.join(late.select("id"), "id", "left_anti").select(*VECTOR.names).unionByName(put)
        return base if namespace is None else base.where(F.col("namespace") == namespace)

    def upsert(self, rows: DataFrame) -> None:
        """Put rows (id, embedding, text, metadata, namespace, seq) in; doing it twice changes nothing.

        The row of the highest seq wins; an id that is there already keeps its namespace.
        """
        version = self.version()
        last = rows.groupBy("id").agg(F.max_by(F.struct("embedding", "text", "metadata"), "seq").alias("row"), F.min_by("namespace", "seq").alias("own"))
        there = self.read(version=version).select("id", F.col("namespace").alias("known"))
        named = last.join(there, "id", "left").select("id", "row.*", F.coalesce("known", "own").alias("namespace"), F.lit(False).alias("gone"))
        self._add(named, version)

    def delete(self, ids: DataFrame) -> None:
        """Take ids out, whatever their namespace; without ids nothing happens."""
        if not ids.isEmpty():
            version = self.version()
            rows = ids.select("id").distinct().withColumns({x.name: F.lit(None).cast(x.dataType) for x in _SEGMENT.fields[1:-1]})
            self._add(rows.withColumn("gone", F.lit(True)), version)

    def compact(self) -> None:
        """Write the base anew, without segments."""
        version = self.version()
        self.read(version=version).select(*VECTOR.names).write.mode("overwrite").partitionBy("namespace").parquet(f"{self.folder}/base-{version + 1:08d}")
        self._commit({"base": version + 1, "segments": []}, version + 1)

    def _add(self, rows: DataFrame, version: int) -> None:
        held = self._manifest(version)
        rows.select(*_SEGMENT.names).write.mode("overwrite").parquet(f"{self.folder}/segment-{version + 1:08d}")
        self._commit(held | {"segments": [*held["segments"], version + 1]}, version + 1)
        if len(held["segments"]) + 1 > SEGMENTS:
            self.compact()

    def _commit(self, manifest: dict, version: int) -> None:
        aside = self._path(f"versions/{version:08d}-{uuid.uuid4().hex}")
        stream = self._files.create(aside, False)
        try:
            stream.writeUTF(json.dumps(manifest))
        finally:
            stream.close()
        plain = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._context.rename(aside, self._path(f"versions/{version:08d}"), plain)
