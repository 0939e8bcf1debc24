"""Change a Parquet table file by file: files without affected rows are not touched."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.text import quoted
from tableferry.session import delete_folder, file_system
from tableferry.sources.relation import sql_name

_FILE, _PATH, _PLACE = "__file", "__path", "__place"


def files_with(spark: SparkSession, name: str, predicate: str) -> list[str]:
    """The files of a table that hold rows for which the predicate is true, in order of name.

    The driver lists the files of a table for every scan, so it can hold these names.
    """
    table = spark.table(sql_name(name))
    path = table.metadataColumn("_metadata")["file_path"]
    found = table.where(F.expr(predicate)).select(path.alias(_PATH)).distinct()
    return sorted(row[0] for row in found.toLocalIterator())


def rewrite_files(
    spark: SparkSession, name: str, predicate: str, change: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Change the rows of those files that hold affected ones; returns their names.

    Each such file is written anew beside the table, with its rows in the same order,
    and takes the place and the name of the old one in one step, so that no reader
    meets a row twice or misses one. A file that is left without rows is deleted. A
    job that fails before has changed nothing; if a replacement fails, the error
    names the folder of those that are still to be put in place.
    """
    paths = files_with(spark, name, predicate)
    if not paths:
        return paths
    schema = spark.table(sql_name(name)).schema
    rows = spark.read.schema(schema).parquet(*paths)
    told = rows.metadataColumn("_metadata")
    placed = change(rows.withColumns({_PATH: told["file_path"], _PLACE: told["row_index"]}))
    numbers = spark.createDataFrame(list(zip(paths, range(len(paths)))), f"{_PATH} string, {_FILE} int")
    # All rows of a file go to one task, which holds no more than a file had.
    dealt = placed.join(numbers, _PATH).repartition(len(paths), _FILE)
    folder = f"{paths[0].rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex}"  # hidden from scans
    try:
        (
            dealt.sortWithinPartitions(_FILE, _PLACE)
            .select(*map(quoted, schema.fieldNames()), _FILE)
            .write.option("maxRecordsPerFile", 0)
            .partitionBy(_FILE)
            .parquet(folder)
        )
    except Exception:
        delete_folder(spark, folder)
        raise
    try:
        for number, path in enumerate(paths):
            _replace(spark, f"{folder}/{_FILE}={number}", path)
    except Exception as error:
        error.add_note(f"new files of {name} that are not in place yet are in {folder}")
        raise
    finally:
        spark.catalog.refreshTable(sql_name(name))
    delete_folder(spark, folder)
    return paths


def _replace(spark: SparkSession, folder: str, path: str) -> None:
    """Put the one file of a folder in the place of another, or delete that if there is none."""
    jvm = spark.sparkContext._jvm
    system, source = file_system(spark, folder)
    target = jvm.org.apache.hadoop.fs.Path(path)
    new = []
    if system.exists(source):
        new = [s.getPath() for s in system.listStatus(source) if s.getPath().getName().startswith("part-")]
    if not new:
        system.delete(target, False)
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    context.rename(new[0], target, how)
