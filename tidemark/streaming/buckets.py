"""Tables in hash buckets of their key: a new version writes the buckets it touches and refers to the others."""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.files import delete_folder, folder_names, path_exists, put_text, read_text

BUCKET = "_bucket"


def key_bucket(keys: Sequence[str], schema: T.StructType, buckets: int) -> Column:
    """Bucket of a row; keys are cast to the table's types first, since a hash depends on the type."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int")


class BucketedTable:
    """Versions of a table, below `path/v=<version>/_bucket=<n>`.

    The note `path/_buckets/<version>.json` holds, for every bucket with rows, the version whose
    folder has them, so it is as long as there are buckets, however many rows and versions there are.
    A version counts once its note is there; what a failed try left is replaced by the next one.
    Choose `buckets` so that one holds some 256 MB: it is fixed by the first version. Rows of equal
    keys share a bucket, so keys should be unique or nearly so. NULL is a key like any other.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 8):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets = list(keys), buckets

    def _note(self, version: int) -> str:
        return f"{self.path}/_buckets/{version}.json"

    def manifest(self, version: int) -> dict[int, int]:
        """Version that holds each bucket; a bucket without rows is left out."""
        if version == 0:
            return {}
        text = read_text(self.spark, self._note(version))
        if text is None:
            raise ValueError(f"{self.path} has no version {version}")
        note = json.loads(text)
        if note["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {note['buckets']} buckets, not {self.buckets}")
        return {int(b): v for b, v in note["held"].items()}

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of `rows`: at most as many values as there are buckets."""
        found = rows.select(key_bucket(self.keys, self.schema, self.buckets).alias(BUCKET)).distinct()
        return sorted(r[BUCKET] for r in found.collect())

    def read(self, version: int, only: Collection[int] | None = None) -> DataFrame:
        """Rows of a version, or of the buckets `only`; other buckets are not even listed."""
        held = self.manifest(version)
        paths = [f"{self.path}/v={v}/{BUCKET}={b}" for b, v in sorted(held.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def write(self, df: DataFrame, version: int, base: int = 0, touched: Collection[int] | None = None) -> None:
        """Make `version` of `base` by replacing the buckets `touched` with `df`, which has rows of these alone.

        Without `touched` all buckets are replaced.
        """
        held = {} if touched is None else {b: v for b, v in self.manifest(base).items() if b not in touched}
        folder = f"{self.path}/v={version}"
        if touched is None or touched:
            rows = df.select(*self.schema.names).withColumn(BUCKET, key_bucket(self.keys, self.schema, self.buckets))
            (rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static")
             .partitionBy(BUCKET).parquet(folder))
            written = {int(name.split("=")[1]) for name in folder_names(self.spark, folder) if name.startswith(f"{BUCKET}=")}
            if touched is not None and not written <= set(touched):
                raise ValueError(f"rows of buckets {sorted(written - set(touched))[:5]} are not among the touched ones")
            held.update(dict.fromkeys(written, version))
        put_text(self.spark, self._note(version), json.dumps({"buckets": self.buckets, "held": held}), replace=True)

    def pair(self, before: int, after: int) -> tuple[DataFrame, DataFrame]:
        """Both versions without the buckets that they share."""
        old, new = self.manifest(before), self.manifest(after)
        differ = {b for b in {*old, *new} if old.get(b) != new.get(b)}
        return self.read(before, differ), self.read(after, differ)

    def sweep(self, keep: Collection[int]) -> list[str]:
        """Remove what no version of `keep` refers to; returns the folders removed, relative to the table.

        Versions above the newest of `keep` may be in the making and are left alone. Notes go first: a
        sweep that dies half-way leaves folders without a note, which the next one removes.
        """
        keep = {v for v in keep if v > 0}
        if not keep or not path_exists(self.spark, f"{self.path}/_buckets"):
            return []
        needed = {(v, b) for k in keep for b, v in self.manifest(k).items()}
        for name in folder_names(self.spark, f"{self.path}/_buckets"):
            stem = name.removesuffix(".json")
            if stem.isdigit() and int(stem) < max(keep) and int(stem) not in keep:
                delete_folder(self.spark, f"{self.path}/_buckets/{name}")
        gone = []
        for name in folder_names(self.spark, self.path):
            if not name.startswith("v=") or int(name[2:]) > max(keep):
                continue
            version = int(name[2:])
            parts = [p for p in folder_names(self.spark, f"{self.path}/{name}") if p.startswith(f"{BUCKET}=")]
            loose = [p for p in parts if (version, int(p.split("=")[1])) not in needed]
            targets = [f"{name}/{p}" for p in loose] if len(loose) < len(parts) else [name]
            for target in targets:
                delete_folder(self.spark, f"{self.path}/{target}")
            gone += targets
        return gone
