"""A file-per-value tracking tree, written from run tables (the input of S4)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_values(values: DataFrame, root: str) -> int:
    """Write one small file per row of ``values (path, body)`` under ``root``;
    tasks write them, a repeated attempt writes the same content again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        for batch in batches:
            for path, body in zip(batch.column("path").to_pylist(), batch.column("body").to_pylist()):
                whole = f"{root.rstrip('/')}/{path}"
                if whole.startswith("file:"):
                    store, inner = fs.LocalFileSystem(), "/" + whole[len("file:"):].lstrip("/")
                else:
                    store, inner = fs.FileSystem.from_uri(whole) if "://" in whole else (fs.LocalFileSystem(), whole)
                store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(inner) as out:
                    out.write(body.encode("utf-8"))
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})
    return values.select("path", "body").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def run_values(runs: DataFrame) -> DataFrame:
    """``(path, body)`` of every value of ``runs (experiment, run_id, run_name,
    start_time, end_time, params, tags, history)``; ``history`` maps a metric
    to its ``(ts_ms, value, step)`` points."""
    ms = lambda c: F.unix_millis(c).cast("string")
    at = F.concat(F.lit("exp-"), "experiment")
    run = F.concat_ws("/", at, "run_id")
    meta = F.concat(F.lit("run_name: "), "run_name", F.lit("\nstart_time: "), ms("start_time"), F.lit("\nend_time: "), ms("end_time"), F.lit("\n"))
    exp = runs.select(F.concat_ws("/", at, F.lit("meta.yaml")).alias("path"), F.concat(F.lit("name: "), "experiment", F.lit("\n")).alias("body")).distinct()
    out = exp.unionByName(runs.select(F.concat_ws("/", run, F.lit("meta.yaml")).alias("path"), meta.alias("body")))
    for kind in ("params", "tags"):
        out = out.unionByName(runs.select(run.alias("_run"), F.explode(kind).alias("k", "v"))
                              .select(F.concat_ws("/", "_run", F.lit(kind), "k").alias("path"), F.col("v").alias("body")))
    line = lambda p: F.concat_ws(" ", p["ts_ms"].cast("string"), p["value"].cast("string"), p["step"].cast("string"))
    return out.unionByName(runs.select(run.alias("_run"), F.explode("history").alias("k", "points"))
                           .select(F.concat_ws("/", "_run", F.lit("metrics"), "k").alias("path"), F.array_join(F.transform("points", line), "\n").alias("body")))
