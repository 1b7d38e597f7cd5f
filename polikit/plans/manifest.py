"""The record of a run: which steps are finished, and what they were made from.

A step's key is a digest of its name, the rules and options, and the key of the step before it;
the first one's comes from the input files (path, bytes, time of change). A step is fresh
if the record has its key and all its outputs are committed. Another input or other
rules give other keys, so everything that depends on them is made anew.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.published import read_text, write_text

FILE = "_manifest.json"


def digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, default=repr, sort_keys=True).encode()).hexdigest()


def input_key(frames: list[DataFrame]) -> str:
    """A digest of the input files' state and the frames' columns; of nothing known (never the same) for
    frames that read no files."""
    found = []
    for df in frames:
        names = sorted(df.inputFiles())
        if not names:
            return digest("no files", uuid.uuid4().hex)
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        states = []
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(name)
            status = path.getFileSystem(conf).getFileStatus(path)
            states.append([name, status.getLen(), status.getModificationTime()])
        found.append([df.schema.json(), states])
    return digest("input", found)


class Manifest:
    """The record in ``out_dir``. Without ``resume`` what it held before is not used."""

    def __init__(self, spark: SparkSession, out_dir: str, resume: bool):
        self.spark, self.path = spark, f"{out_dir}/{FILE}"
        before = read_text(spark, self.path) if resume else None
        self.steps: dict[str, dict] = json.loads(before) if before else {}
        self.skipped: list[str] = []
        self.redone: list[str] = []

    def fresh(self, name: str, key: str, paths: list[str]) -> bool:
        """Whether a step can be skipped: it is recorded, its outputs are there, and no step before it was redone."""
        entry = self.steps.get(name)
        ok = not self.redone and entry is not None and entry["key"] == key and entry["paths"] == paths \
            and all(read_text(self.spark, f"{p}/_SUCCESS") is not None for p in paths)
        if ok:
            self.skipped.append(name)
        return ok

    def finish(self, name: str, key: str, paths: list[str], counts: dict[str, int]) -> None:
        self.redone.append(name)
        self.steps[name] = {"key": key, "paths": paths, "counts": counts}
        write_text(self.spark, self.path, json.dumps(self.steps, indent=1, sort_keys=True))
