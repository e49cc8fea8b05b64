"""A table of documents that are replaced by id: versions on top of a base that is merged by buckets of ids.

A version is written as it comes, to ``version=N``. A reader takes the base, without the ids that a later version has, and of each such
id its highest version: only ids and version numbers are grouped, documents (with their vectors) are not sorted. :meth:`compact`
merges versions into the base, bucket by bucket of a hash of the id, one shuffle of those buckets alone that a version touches; a list
of which generation holds which bucket is written last, in one file, so readers see the old state or the new one, and a merge that
fails leaves the old one. :meth:`vacuum` removes what no list names any more, once no reader of an old list runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BUCKETS = 64
KEYS = ("index_name", "_id")


def newest(later: DataFrame, base: DataFrame | None = None, keys: tuple[str, ...] = KEYS, version: str = "version") -> DataFrame:
    """Rows of ``later``, each key as in its highest version, and those of ``base`` (without a version) whose key no version has. Only
    keys and version numbers are grouped."""
    last = later.groupBy(*keys).agg(F.max(version).alias(version))
    rows = later.join(last, [*keys, version], "left_semi").drop(version)
    return rows if base is None else base.join(last, list(keys), "left_anti").unionByName(rows)


@dataclass(frozen=True)
class Upserts:
    folder: str
    buckets: int = BUCKETS

    def _at(self, *parts: str) -> str:
        return "/".join([self.folder.rstrip("/"), *parts])

    def _listed(self, spark: SparkSession, pattern: str) -> list[int]:
        """The numbers of the folders name=number that are complete."""
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._at(pattern, "_SUCCESS"))
        found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place) or []
        return sorted(int(x.getPath().getParent().getName().split("=")[1]) for x in found)

    def _held(self, spark: SparkSession) -> tuple[int, int, dict[int, int]]:
        """(generation, the last version that is in the base, generation by bucket), by the last list."""
        lists = self._listed(spark, "_manifest/generation=*")
        if not lists:
            return 0, -1, {}
        rows = spark.read.schema("bucket int, held int, upto long").json(self._at("_manifest", f"generation={lists[-1]}")).collect()
        return lists[-1], rows[0].upto, {r.bucket: r.held for r in rows if r.held}

    def write(self, rows: DataFrame, version: int) -> None:
        """The documents of one version; the same version written again replaces itself. Versions that are in the base are closed."""
        rows.write.mode("overwrite").partitionBy("index_name").parquet(self._at(f"version={version}"))

    def _base(self, spark: SparkSession, held: dict[int, int], buckets: list[int] | None = None) -> DataFrame | None:
        """Partitions of the base by the generation that holds them; every other one is pruned."""
        rows = None
        for generation in sorted({g for b, g in held.items() if buckets is None or b in buckets}):
            mine = [b for b, g in held.items() if g == generation and (buckets is None or b in buckets)]
            some = spark.read.option("basePath", self._at("_base", f"generation={generation}")).parquet(self._at("_base", f"generation={generation}")).filter(F.col("bucket").isin(mine))
            rows = some if rows is None else rows.unionByName(some)
        return rows

    def _later(self, spark: SparkSession, upto: int) -> DataFrame | None:
        versions = [v for v in self._listed(spark, "version=*") if v > upto]
        if not versions:
            return None
        return spark.read.option("basePath", self.folder).parquet(*[self._at(f"version={v}") for v in versions])

    def read(self, spark: SparkSession) -> DataFrame:
        """The documents, each as in its highest version."""
        _, upto, held = self._held(spark)
        base, later = self._base(spark, held), self._later(spark, upto)
        if later is None:
            if base is None:
                raise FileNotFoundError(f"{self.folder} holds no version")
            return base.drop("bucket")
        return newest(later, base.drop("bucket") if base is not None else None)

    def compact(self, spark: SparkSession) -> int:
        """Merges all versions so far into the base; the generation of the base after it. Nothing to merge: the same as before."""
        generation, upto, held = self._held(spark)
        later = self._later(spark, upto)
        if later is None:
            return generation
        newest = max(v for v in self._listed(spark, "version=*"))
        later = later.withColumn("bucket", F.pmod(F.xxhash64("_id"), F.lit(self.buckets)).cast("int"))
        touched = sorted(r.bucket for r in later.select("bucket").distinct().collect())  # at most as many as there are buckets
        rows, base = later, self._base(spark, held, touched)
        if base is not None:
            rows = base.withColumn("version", F.lit(-1)).unionByName(later)
        place = F.row_number().over(Window.partitionBy("bucket", *KEYS).orderBy(F.col("version").desc()))
        merged = rows.repartition(F.col("bucket")).withColumn("__place", place).filter("__place = 1").drop("__place", "version")
        merged.write.mode("overwrite").partitionBy("bucket", "index_name").parquet(self._at("_base", f"generation={generation + 1}"))
        held = held | dict.fromkeys(touched, generation + 1)
        told = spark.createDataFrame([(b, held.get(b, 0), newest) for b in range(self.buckets)], "bucket int, held int, upto long")
        told.coalesce(1).write.mode("overwrite").json(self._at("_manifest", f"generation={generation + 1}"))
        return generation + 1

    def vacuum(self, spark: SparkSession) -> list[str]:
        """Removes versions that are in the base, and lists and buckets that the last list has replaced; their folders."""
        generation, upto, held = self._held(spark)
        old = [f"version={v}" for v in self._listed(spark, "version=*") if v <= upto]
        old += [f"_manifest/generation={g}" for g in self._listed(spark, "_manifest/generation=*") if g < generation]
        old += [f"_base/generation={g}" for g in self._listed(spark, "_base/generation=*") if g not in held.values()]
        for name in old:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._at(name))
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        return old
