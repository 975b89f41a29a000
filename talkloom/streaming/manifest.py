"""Freshness by fingerprints of inputs (paths, sizes, times) rather than by comparing times alone."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession


class Manifest:
    """Which inputs each artifact was made of. All paths go through Spark's file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def fingerprint(self, path: str) -> str:
        """Of the files under a path; empty if there is none."""
        fs, p = self._fs(path)
        if not fs.exists(p):
            return ""
        files, found = fs.listFiles(p, True), []
        while files.hasNext():
            f = files.next()
            found.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
        return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()

    def _load(self) -> dict[str, dict[str, str]]:
        fs, p = self._fs(self.path)
        if not fs.exists(p):
            return {}
        text = self.spark.read.text(self.path, wholetext=True).first()
        return json.loads(text["value"]) if text else {}

    def fresh(self, name: str, inputs: list[str]) -> bool:
        return self._load().get(name) == {i: self.fingerprint(i) for i in inputs}

    def made(self, name: str, inputs: list[str]) -> None:
        known = self._load() | {name: {i: self.fingerprint(i) for i in inputs}}
        fs, p = self._fs(self.path)
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(known, indent=2).encode()))
        out.close()
