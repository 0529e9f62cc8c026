"""A staged, resumable workflow: stages with signatures, their outputs kept as tables and skipped while nothing changed."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Stage:
    """run(spark, inputs) -> DataFrame; params and version make its signature."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    needs: tuple[str, ...] = ()
    params: dict = field(default_factory=dict, hash=False)
    version: str = "1"


def source_mark(df: DataFrame) -> str:
    """Of a source: its schema and its files with their lengths and times, or its plan where it has no files."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for path in sorted(df.inputFiles()):
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        status = at.getFileSystem(conf).getFileStatus(at)
        files.append([path, status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps([df.schema.json(), files or df.semanticHash()]).encode()).hexdigest()


def signatures(stages: list[Stage], sources: dict[str, str] | None = None) -> dict[str, str]:
    """A stage's signature covers its own parameters, the signatures of what it needs and the marks of its sources."""
    out: dict[str, str] = dict(sources or {})
    for s in stages:
        body = json.dumps([s.name, s.version, s.params, [out[n] for n in s.needs if n in out]], sort_keys=True, ensure_ascii=False)
        out[s.name] = hashlib.sha256(body.encode()).hexdigest()
    return {s.name: out[s.name] for s in stages}


def run_stages(spark: SparkSession, stages: list[Stage], sources: dict[str, DataFrame], root: str) -> tuple[dict[str, DataFrame], list[str]]:
    """(tables by stage, names of stages that ran). A stage's table lies under its signature, so a changed stage and all
    that follow from it run anew, and all others are read; a table counts once Spark's commit marked it whole."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    tables, ran, marks = dict(sources), [], signatures(stages, {n: source_mark(d) for n, d in sources.items()})
    for s in stages:
        path = f"{root}/{s.name}-{marks[s.name][:16]}"
        done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
        if not done.getFileSystem(conf).exists(done):
            s.run(spark, {n: tables[n] for n in s.needs}).write.mode("overwrite").parquet(path)
            ran.append(s.name)
        tables[s.name] = spark.read.parquet(path)
    return {s.name: tables[s.name] for s in stages}, ran
