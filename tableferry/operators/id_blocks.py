"""Blocks of ids that several writers of a table reserve without meeting.

A reservation is a file in the shared folder. Its name is the number of the
reservation and its text says which ids it takes, so that whoever comes next knows
where to go on. A file is written under another name and takes its own in one step
that fails if the name is there: of two writers that want the same number one has
to try again.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import SparkSession

from tableferry.operators.ids import ID, table_max
from tableferry.session import file_system, work_dir

_TRIES = 1000


def _folder(spark: SparkSession, name: str) -> str:
    """The folder of a table's reservations; it stays as long as the table has ids."""
    told = hashlib.md5(name.replace("`", "").lower().encode()).hexdigest()
    return f"{work_dir(spark)}/ferry-ids-{told}"


def _read(spark: SparkSession, path) -> tuple[int, int]:
    system, target = file_system(spark, path)
    stream = system.open(target)
    try:
        first, count = bytes(stream.readAllBytes()).decode().split()
    finally:
        stream.close()
    return int(first), int(count)


def reservations(spark: SparkSession, name: str) -> list[tuple[int, int, int]]:
    """The reservations of a table, in order: number, first id, count."""
    folder = _folder(spark, name)
    system, target = file_system(spark, folder)
    if not system.exists(target):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(target))
    return [(int(n), *_read(spark, f"{folder}/{n}")) for n in names if n.isdigit()]


def _last(spark: SparkSession, folder: str) -> tuple[int, int]:
    """The number of the next reservation, and the id after the last one."""
    system, target = file_system(spark, folder)
    names = [s.getPath().getName() for s in system.listStatus(target)]
    numbers = [n for n in names if n.isdigit()]
    if not numbers:
        return 0, 1
    first, count = _read(spark, f"{folder}/{max(numbers)}")
    return int(max(numbers)) + 1, first + count


def _claim(spark: SparkSession, written: str, wanted: str) -> bool:
    """Give a file its name, unless something has that name."""
    system, source = file_system(spark, written)
    _, target = file_system(spark, wanted)
    if system.getScheme() == "file":  # a rename there would replace what it meets
        try:
            os.link(source.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            system.delete(source, False)
        return True
    done = system.rename(source, target)
    if not done:
        system.delete(source, False)
    return done


def reserve_ids(spark: SparkSession, name: str, count: int, column: str = ID) -> int:
    """Reserve ``count`` ids of a table that follow on all others; returns the first.

    They come after the largest id in the table and after all reservations. Ids
    that were reserved and not written, as by a job that failed, are not given
    again: they stay a gap, and no id is given twice.
    """
    folder = _folder(spark, name)
    system, target = file_system(spark, folder)
    system.mkdirs(target)
    for _ in range(_TRIES):
        number, following = _last(spark, folder)
        first = max(following, (table_max(spark, name, column) or 0) + 1)
        written = f"{folder}/_{uuid.uuid4().hex}"
        _, path = file_system(spark, written)
        stream = system.create(path, False)
        stream.write(bytearray(f"{first} {count}".encode()))
        stream.close()
        if _claim(spark, written, f"{folder}/{number:012d}"):
            return first
    raise RuntimeError(f"no block of ids of {name} could be reserved in {_TRIES} tries")
