"""A model registry with optimistic commits (ML-5, SNK-6).

The registry is a log of numbered version files, one registry row each.  A version is committed by creating its file
only if it is absent, which the file system does for one of any number of promoters; the others read what was
committed, decide anew, and try the next number.  So ids are dense, and every row is better than all rows before it.
"""

from __future__ import annotations

import json
import os
import time
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aspectflow.schemas import MODEL_NAME_FORMAT, REGISTRY

RETRIES = 1000
PARTIAL_WAIT = 0.02         # seconds between looks at a version whose writer has created but not filled it yet
PARTIAL_LOOKS = 250


class RegistryLog:
    """Versions under ``<path>/_log``; ``<path>`` itself holds the same rows as Parquet for other readers."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.log = spark, path.rstrip("/"), path.rstrip("/") + "/_log"
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def _fs(self):
        return self._path(self.log).getFileSystem(self._conf)

    def exists(self) -> bool:
        return self._fs().exists(self._path(self.log))

    def _create(self, name: str, content: bytes) -> bool:
        """Create a file with this content unless it is there; False if it is.

        Distributed stores decide that in one place.  Hadoop's local file system looks first and creates then, so
        plain local paths use the operating system's exclusive create.
        """
        target = self._path(f"{self.log}/{name}")
        fs = self._fs()
        if fs.getScheme() == "file":
            local = urlparse(fs.makeQualified(target).toString()).path
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "xb") as f:
                    f.write(content)
            except FileExistsError:
                return False
            return True
        try:
            out = fs.create(target, False)
        except Exception as exc:  # noqa: BLE001 - told apart by its Java class
            cause = getattr(exc, "java_exception", None)
            if cause is not None and "AlreadyExists" in cause.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        return True

    def rows(self) -> list[dict]:
        """All committed rows in version order.  The log has a row per promoted model."""
        if not self.exists():
            return []
        for _ in range(PARTIAL_LOOKS):
            texts = [(r["name"], r["value"]) for r in self.spark.read.text(self.log, wholetext=True)
                     .select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("name"), "value")
                     .where("name rlike '^[0-9]+[.]json$'").collect()]
            try:
                rows = [json.loads(t) for _, t in sorted(texts)]
            except json.JSONDecodeError:          # a writer is between create and close
                rows = None
            # an empty file has no row in a text table, so the numbers must be dense too
            if rows is not None and [r["id"] for r in rows] == list(range(1, len(rows) + 1)):
                return rows
            time.sleep(PARTIAL_WAIT)
        raise RuntimeError(f"a version of {self.log} was created but never filled")

    def frame(self) -> DataFrame:
        """The registry as rows."""
        rows = [(r["id"], r["model_name"], r["macro_f1"], r["balanced_acc"], r["created_at"]) for r in self.rows()]
        out = self.spark.createDataFrame(rows, "id long, model_name string, macro_f1 double, balanced_acc double, created_at double")
        return out.withColumn("created_at", F.timestamp_seconds("created_at"))

    def promote(self, macro_f1: float, balanced_acc: float, artefact: str | None = None, models_dir: str | None = None) -> dict | None:
        """Commit a row if ``macro_f1`` is strictly above every committed one (0.0 without any); None if it isn't.

        The comparison and the commit are one step: where another promoter commits first, its row is read and the
        comparison is made again.  ``artefact`` is the staged model's folder; it gets the row's name in ``models_dir``
        after the commit, by the winner or, if that dies in between, by the next :meth:`settle`.
        """
        self._adopt()
        for _ in range(RETRIES):
            rows = self.rows()
            if not macro_f1 > max((r["macro_f1"] for r in rows), default=0.0):
                if artefact:
                    self._fs().delete(self._path(artefact), True)
                return None
            number = len(rows) + 1
            row = {"id": number, "model_name": MODEL_NAME_FORMAT % number, "macro_f1": macro_f1, "balanced_acc": balanced_acc,
                   "created_at": time.time(), "artefact": artefact}
            if self._create(f"{number:012d}.json", json.dumps(row).encode()):
                self._publish(row)
                if models_dir:
                    self.settle(models_dir)
                return row
        raise RuntimeError(f"{self.log}: {RETRIES} commits were lost to other promoters")

    def settle(self, models_dir: str) -> None:
        """Give every committed model that is still staged its name."""
        fs = self._fs()
        for row in self.rows():
            staged, final = row.get("artefact"), f"{models_dir.rstrip('/')}/{row['model_name']}"
            if staged and fs.exists(self._path(staged)) and not fs.exists(self._path(final)):
                fs.rename(self._path(staged), self._path(final))

    def _publish(self, row: dict) -> None:
        """The committed row as Parquet beside the log; writing it again changes nothing."""
        (self.frame().where(F.col("id") == row["id"]).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/version={row['id']}"))

    def _adopt(self) -> None:
        """Rows of a registry that was kept as Parquet before it had a log become its first versions."""
        fs = self._fs()
        if self.exists() or not fs.exists(self._path(self.path)):
            return
        old = self.spark.read.schema(REGISTRY).option("recursiveFileLookup", "true").parquet(self.path).orderBy("id").collect()
        for i, r in enumerate(old, 1):
            at = r["created_at"].timestamp() if r["created_at"] else 0.0
            self._create(f"{i:012d}.json", json.dumps({"id": i, "model_name": r["model_name"], "macro_f1": r["macro_f1"],
                                                       "balanced_acc": r["balanced_acc"], "created_at": at, "artefact": None}).encode())
