"""Text folders read run by run: each finished folder once, with what was made of it."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.text_dirs import completed_dirs, has_marker, in_date_range, is_directory, path_date

MARKER_CALLS = 32  # at the same time
_SCHEME = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?")


def data_folders(spark: SparkSession, root: str) -> DataFrame:
    """(folder): the folders at or below ``root`` that hold data files.

    Spark's file index lists them: once there are more folders than
    ``spark.sql.sources.parallelPartitionDiscovery.threshold``, by tasks.
    No file is read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root.rstrip("/")))
    return files.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).distinct()


def _runs(spark: SparkSession, out_dir: str) -> list[int]:
    """Finished runs: those whose manifest is written, which is each run's last write."""
    found = [f.rsplit("/", 2)[-2] for f in completed_dirs(spark, out_dir, "run-*/folders")]
    return sorted(int(name[4:]) for name in found if name[4:].isdigit())


def _read_runs(spark: SparkSession, out_dir: str, what: str, schema) -> DataFrame:
    paths = [f"{out_dir}/run-{n}/{what}" for n in _runs(spark, out_dir)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def taken_folders(spark: SparkSession, out_dir: str) -> DataFrame:
    """(folder, run): the manifest of all finished runs."""
    return _read_runs(spark, out_dir, "folders", "folder string, run bigint")


def new_folders(spark: SparkSession, root: str, out_dir: str, require_success: bool = True,
                date_from=None, date_to=None, most: int | None = None) -> list[str]:
    """Folders below ``root`` that no finished run has taken and that are finished, ascending.

    Finished: a ``_SUCCESS`` marker in the folder or above it, up to
    ``root``; only folders not yet taken are asked, several at a time.
    Day bounds as ``read_text_dirs``. ``most`` leaves the later ones to
    further runs.
    """
    if not is_directory(spark, root):
        raise FileNotFoundError(f"no such folder: {root}")
    left = data_folders(spark, root).join(taken_folders(spark, out_dir).select("folder"), "folder", "left_anti")
    folders = in_date_range(sorted(r.folder for r in left.collect()), date_from, date_to)
    if require_success and folders:
        with ThreadPoolExecutor(MARKER_CALLS) as pool:
            above = sorted({a for f in folders for a in _upto(f, root)})
            marked = {a for a, ok in zip(above, pool.map(lambda a: has_marker(spark, a), above)) if ok}
        folders = [f for f in folders if marked.intersection(_upto(f, root))]
    return folders[:most] if most else folders


def _upto(folder: str, root: str) -> list[str]:
    """A folder and those above it, up to the root (whose scheme may be written otherwise)."""
    below = _SCHEME.sub("", folder)[len(_SCHEME.sub("", root.rstrip("/"))):]
    return [folder.rsplit("/", i)[0] for i in range(below.count("/") + 1)]


def run_incremental(spark: SparkSession, root: str, out_dir: str, job: Callable[[DataFrame], DataFrame],
                    with_date: bool = False, **which) -> int:
    """Run ``job`` over the lines of the folders finished since the last run; the number of folders taken.

    ``job`` gets a frame with ``value`` (and with ``with_date`` the ``date``
    in the folder's path) and returns what to keep. A run writes its result
    to ``out_dir/run-<n>/result`` and then its folders to
    ``out_dir/run-<n>/folders``, whose marker makes it count; a run that
    fails before that counts for nothing, and the next one takes its number
    and its folders. So each folder is in exactly one finished run. Files
    that come into a folder after it was taken are not seen. ``which`` takes
    the arguments of :func:`new_folders`. Nothing new writes nothing. One
    run at a time.
    """
    folders = new_folders(spark, root, out_dir, **which)
    if not folders:
        return 0
    number = max(_runs(spark, out_dir), default=-1) + 1
    lines = spark.read.text(folders)
    if with_date:
        in_path = F.regexp_replace(F.col("_metadata.file_path"), r"/[^/]*$", "")
        days = {str(d) for f in folders if (d := path_date(f))}
        date = F.try_to_date(F.concat_ws("-", *[F.regexp_extract(in_path, r"^.*(\d{4})[-/](\d{2})[-/](\d{2})", i)
                                                for i in (1, 2, 3)]), "yyyy-MM-dd")
        lines = lines.select("value", (date if days else F.lit(None).cast("date")).alias("date"))
    job(lines).write.mode("overwrite").parquet(f"{out_dir}/run-{number}/result")
    taken = spark.createDataFrame([(f, number) for f in folders], "folder string, run bigint")
    taken.write.mode("overwrite").parquet(f"{out_dir}/run-{number}/folders")
    return len(folders)


def read_incremental(spark: SparkSession, out_dir: str, schema) -> DataFrame:
    """The results of all finished runs, one after the other's rows."""
    return _read_runs(spark, out_dir, "result", schema)
