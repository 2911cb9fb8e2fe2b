"""Fitted models shared across sessions, and the one that serves.

A store is a folder on shared storage. A model's address is the digest of all that it
was fitted from (input files, settings, features, code), so a later session that asks for
the same finds it, and changed data or settings never do. Every publication is
one small file that is created only if it isn't there yet, and names a folder that was
written to the end before: readers see a whole model or none, and of two sessions
that fit the same model at once the first to publish wins.

The champion of a name is the highest of its numbered version files; a challenger becomes
the next number, and only if the gate accepts it.
"""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

#: Names the store's folder; without it, it lies beside the checkpoints.
STORE_SETTING = "spark.demandkit.models"


def store_root(spark: SparkSession) -> str:
    """The folder that all sessions share: the setting, else a folder in the one of
    ``spark.checkpoint.dir``, else (local master only) one of this machine."""
    def get(name):
        return spark.conf.get(name, None) or spark.sparkContext.getConf().get(name, None)

    if get(STORE_SETTING):
        return get(STORE_SETTING).rstrip("/")
    if get("spark.checkpoint.dir"):
        return get("spark.checkpoint.dir").rstrip("/") + "/demandkit-models"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {STORE_SETTING} or spark.checkpoint.dir to a shared folder")
    return f"{os.environ.get('TMPDIR', tempfile.gettempdir())}/demandkit-models-{os.getuid()}"


def code_digest() -> str:
    """Of the modules that decide what a fitted model is."""
    folder = Path(__file__).resolve().parents[1]
    files = ["operators/models.py", "operators/prepare.py", "operators/features.py", "sources/tables.py"]
    return hashlib.sha256(b"".join((folder / f).read_bytes() for f in files)).hexdigest()


def address(content: dict) -> str:
    return hashlib.sha256(json.dumps(content, sort_keys=True, default=str).encode()).hexdigest()[:32]


class ModelStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or store_root(spark)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- small files ----------------------------------------------------------

    def create(self, name: str, content: dict) -> bool:
        """Write a small file if there is none of this name yet; False otherwise."""
        path = self._path(f"{self.root}/{name}")
        if self._fs.exists(path):
            return False
        data = json.dumps(content, sort_keys=True).encode()
        part = self._path(f"{self.root}/{name}.{uuid.uuid4().hex}.part")
        out = self._fs.create(part, False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        # A rename never replaces a file; where it isn't atomic the content is still whole.
        if self._fs.exists(path) or not self._fs.rename(part, path):
            self._fs.delete(part, False)
            return False
        return True

    def read(self, name: str) -> dict | None:
        path = self._path(f"{self.root}/{name}")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names of the whole small files of a folder."""
        path = self._path(f"{self.root}/{folder}")
        if not self._fs.exists(path):
            return []
        return sorted(n for s in self._fs.listStatus(path) if not (n := s.getPath().getName()).endswith(".part")
                      and not n.startswith((".", "_")) and s.isFile())

    # --- models ---------------------------------------------------------------

    def get(self, key: str) -> PipelineModel | None:
        found = self.read(f"models/{key}.json")
        return PipelineModel.load(f"{self.root}/{found['folder']}") if found else None

    def holds(self, content: dict) -> bool:
        return self.read(f"models/{address(content)}.json") is not None

    def fitted(self, content: dict, fit: Callable[[], PipelineModel]) -> PipelineModel:
        """The model of this content: loaded, or fitted now and published."""
        key = address(content)
        model = self.get(key)
        if model is None:
            model = fit()
            folder = f"fits/{key}-{uuid.uuid4().hex}"
            model.write().save(f"{self.root}/{folder}")
            self.create(f"models/{key}.json", {"folder": folder, "content": json.loads(json.dumps(content, default=str))})
        return model

    # --- the model that serves --------------------------------------------------

    def champion(self, name: str) -> dict | None:
        """Content of the newest version file of ``name``, with its number."""
        versions = self.names(f"champions/{name}")
        return self.read(f"champions/{name}/{versions[-1]}") if versions else None

    def promote(self, name: str, content: dict, over: dict | None) -> bool:
        """Make ``content`` the next version after ``over`` (what the caller compared it
        with). False if another version came in between: compare again."""
        number = (over or {}).get("version", 0) + 1
        return self.create(f"champions/{name}/{number:08d}.json", {**content, "version": number})
