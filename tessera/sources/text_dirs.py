"""Text sources: directory scans, completed-directory filter, dated paths.

Directories are chosen *before* the read (completion marker, date range),
so unwanted data is never listed by the scan or opened by a task. The
choice is one glob on the Hadoop file system per root: metadata only, the
same work Spark's own file index does on the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The marker a finished Hadoop/Spark write leaves in its
# output folder, and the date shapes recognised in a path (yyyy-MM-dd or
# yyyy/MM/dd, optionally behind "dt=").
SUCCESS_MARKER = "_SUCCESS"
PATH_DATE_REGEX = r"(\d{4})[-/](\d{2})[-/](\d{2})"

LISTINGS = 32  # calls to the file system at the same time


def _fs_for(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(conf)


def completed_dirs(spark: SparkSession, root: str, pattern: str = "*") -> list[str]:
    """Folders matching ``root/pattern`` that hold a ``_SUCCESS`` marker.

    One glob for ``root/pattern/_SUCCESS`` lists every marker at once, so the
    cost does not grow with one call per folder.
    """
    glob = f"{root.rstrip('/')}/{pattern}/{SUCCESS_MARKER}"
    p, fs = _fs_for(spark, glob)
    statuses = fs.globStatus(p) or []
    return sorted(str(s.getPath().getParent().toString()) for s in statuses)


def is_directory(spark: SparkSession, path: str) -> bool:
    p, fs = _fs_for(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def has_marker(spark: SparkSession, folder: str) -> bool:
    p, fs = _fs_for(spark, f"{folder.rstrip('/')}/{SUCCESS_MARKER}")
    return bool(fs.exists(p))


def all_dirs(spark: SparkSession, root: str, pattern: str = "*") -> list[str]:
    glob = f"{root.rstrip('/')}/{pattern}"
    p, fs = _fs_for(spark, glob)
    statuses = fs.globStatus(p) or []
    return sorted(str(s.getPath().toString()) for s in statuses if s.isDirectory())


def path_date(path: str) -> dt.date | None:
    """The last ``yyyy-MM-dd`` / ``yyyy/MM/dd`` date found in a path."""
    found = re.findall(PATH_DATE_REGEX, path)
    if not found:
        return None
    y, m, d = found[-1]
    try:
        return dt.date(int(y), int(m), int(d))
    except ValueError:
        return None


def in_date_range(paths: list[str], date_from=None, date_to=None) -> list[str]:
    """Keep paths whose date lies in ``[date_from, date_to]`` (both inclusive).

    With no bound given every path is kept, dated or not; with a bound, a
    path without a date is dropped.
    """
    if date_from is None and date_to is None:
        return list(paths)
    lo = _as_date(date_from)
    hi = _as_date(date_to)
    kept = []
    for p in paths:
        d = path_date(p)
        if d is None:
            continue
        if lo is not None and d < lo:
            continue
        if hi is not None and d > hi:
            continue
        kept.append(p)
    return kept


def _as_date(v):
    if v is None or isinstance(v, dt.date):
        return v.date() if isinstance(v, dt.datetime) else v
    return dt.date.fromisoformat(str(v)[:10])


def file_date(path_col: Column | None = None, strip_file_name: bool | None = None) -> Column:
    """Date in a path, by default of each row's folder (``_metadata.file_path``).

    For the default file path the file name is left out, so the date is the
    folder's, the same one folder pruning used. A given ``path_col`` is read
    as it is (pass ``strip_file_name=True`` for file paths). The last date
    in the path wins.
    """
    c = path_col if path_col is not None else F.col("_metadata.file_path")
    if strip_file_name if strip_file_name is not None else path_col is None:
        c = F.regexp_replace(c, r"/[^/]*$", "")  # the folder holding the file
    last = r"^.*" + PATH_DATE_REGEX  # greedy prefix: the last date wins
    y, m, d = (F.regexp_extract(c, last, i) for i in (1, 2, 3))
    return F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")


def text_folders(spark: SparkSession, root: str, require_success: bool = True,
                 date_from=None, date_to=None) -> tuple[list[str], bool]:
    """Folders at or below ``root`` that hold data files, and whether there is anything at all.

    A folder counts as finished if it, or one above it up to ``root``, has a
    ``_SUCCESS`` marker. A folder whose path names a day outside the range
    is not listed. Listing is one call per folder that is entered, level by
    level, ``LISTINGS`` at the same time.
    """
    top, fs = _fs_for(spark, root.rstrip("/"))
    if not fs.exists(top):
        raise FileNotFoundError(f"no such folder: {root}")
    found, anything = [], False
    bounded = date_from is not None or date_to is not None

    def listed(folder) -> list[tuple]:
        return [(e.getPath(), e.getPath().getName(), e.isDirectory()) for e in fs.listStatus(folder)]

    level = [(top, False)]
    with ThreadPoolExecutor(LISTINGS) as pool:
        while level:
            below = []
            for (folder, finished), entries in zip(level, pool.map(listed, [f for f, _ in level])):
                finished = finished or any(n == SUCCESS_MARKER for _, n, _ in entries)
                shown = [e for e in entries if not e[1].startswith(("_", "."))]
                data = any(not is_folder for _, _, is_folder in shown)
                anything = anything or data
                if data and (finished or not require_success):
                    found.append(str(folder.toString()))
                for path, _, is_folder in shown:
                    if not is_folder:
                        continue
                    day = path_date(str(path.toString())[len(str(top.toString())):])
                    if bounded and day is not None and not in_date_range([str(day)], date_from, date_to):
                        anything = True
                        continue
                    below.append((path, finished))
            level = below
    return sorted(in_date_range(found, date_from, date_to)), anything


def read_text_dirs(spark: SparkSession, root: str | list[str], pattern: str | None = None,
                   require_success: bool = True, date_from=None, date_to=None,
                   with_date: bool = False) -> DataFrame:
    """Lines (``value``) of the text files under the chosen folders.

    ``root`` is a folder of text files, a folder of such folders at any
    depth (``2014-05-01``, ``2014/05/01``, ``day=2014-05-01``), or a list of
    folders. ``require_success`` keeps only finished writes: a ``_SUCCESS``
    marker in the folder or above it. ``date_from``/``date_to`` choose
    folders by the day in their path before anything is read or, under one
    root, listed. ``pattern`` looks for folders by a glob below ``root``
    instead. ``with_date`` adds a ``date`` column from each file's path.

    An empty root reads as empty; a root that holds something of which
    nothing is chosen raises ``FileNotFoundError``.
    """
    if isinstance(root, (list, tuple)):
        dirs = [d.rstrip("/") for d in root]
        anything = bool(dirs)
        if require_success:
            with ThreadPoolExecutor(LISTINGS) as pool:
                dirs = [d for d, done in zip(dirs, list(pool.map(lambda d: has_marker(spark, d), dirs))) if done]
        dirs = in_date_range(dirs, date_from, date_to)
    elif pattern is None:
        dirs, anything = text_folders(spark, root, require_success, date_from, date_to)
    else:
        every = all_dirs(spark, root, pattern)
        anything = bool(every)
        dirs = in_date_range(completed_dirs(spark, root, pattern) if require_success else every, date_from, date_to)
    if not dirs:
        if anything:
            raise FileNotFoundError(f"{root} holds data, but no finished folder in the wanted range")
        empty = spark.createDataFrame([], "value string")
        return empty.withColumn("date", F.lit(None).cast("date")) if with_date else empty
    df = spark.read.text(dirs)
    if with_date:
        df = df.select("value", file_date().alias("date"))
    return df.select("value", *(["date"] if with_date else []))


def read_partitioned_text(spark: SparkSession, root: str, date_col: str = "day",
                          date_from=None, date_to=None,
                          require_success: bool = True) -> DataFrame:
    """Lines of a text table written with ``partitionBy(date_col)``.

    The write's ``_SUCCESS`` marker sits at ``root``; with
    ``require_success`` an unfinished write reads as empty. The day folders
    of the range (both ends inclusive) are chosen by their names in one
    listing of ``root``; only these are listed and read.
    """
    empty = spark.createDataFrame([], f"value string, {date_col} date")
    if require_success and not has_marker(spark, root):
        return empty
    days = in_date_range(all_dirs(spark, root, f"{date_col}=*"), date_from, date_to)
    if not days:  # an empty write leaves no day folder
        return empty
    df = spark.read.option("basePath", root).text(days)
    return df.withColumn(date_col, F.col(date_col).cast("date"))
