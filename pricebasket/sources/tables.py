"""Publishing tables: create, or replace without ever losing the old one.

A table is written under a name of its own first, beside the published ones;
only when that is complete does it take the published name, by renames.  A run
that dies while it writes leaves the old table as it was.  One that dies between
the renames leaves the old table under its set-aside name, where ``recover``
(and every later publishing or reading) finds it and puts it back.

Layout under a folder ``root``: ``<root>/<name>`` is the published table, a plain
folder that any reader can read; ``_new`` and ``_old`` hold tables being written
and set aside, and are there during a publishing only.  In a catalog, the same
names are tables: ``<name>``, ``<name>__new_<id>``, ``<name>__old``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

NEW, OLD = "_new", "_old"


class TableExists(ValueError):
    """A table was to be created, but its name is taken."""


class FolderStore:
    """Tables as folders of files under ``root``."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        at = hadoop.Path(self.root)
        self._path, self._fs = hadoop.Path, at.getFileSystem(conf)
        self._context = hadoop.FileContext.getFileContext(self._fs.makeQualified(at).toUri(), conf)
        # no option: a rename fails if its target is there, and never moves a folder into it
        self._plain = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def new_name(self, name: str) -> str:
        return f"{NEW}/{name}-{uuid.uuid4().hex}"

    def old_name(self, name: str) -> str:
        return f"{OLD}/{name}"

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def rename(self, name: str, to: str) -> None:
        self._fs.mkdirs(self._at(to).getParent())
        self._context.rename(self._fs.makeQualified(self._at(name)), self._fs.makeQualified(self._at(to)), self._plain)

    def drop(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
        holder = self._at(name).getParent()
        if holder.getName() in (NEW, OLD) and self._fs.exists(holder) and not self._fs.listStatus(holder):
            self._fs.delete(holder, False)

    def moved(self, name: str) -> None:
        """The holder of a table that was renamed goes if it is empty."""
        self.drop(name)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.mode("errorifexists").format(self.fmt).save(f"{self.root}/{name}")

    def read(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read.format(self.fmt)
        return (reader.schema(schema) if schema is not None else reader).load(f"{self.root}/{name}")


class CatalogStore:
    """Tables of the schema ``root`` of the catalog."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def new_name(self, name: str) -> str:
        return f"{name}__new_{uuid.uuid4().hex}"

    def old_name(self, name: str) -> str:
        return f"{name}__old"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.root}.{name}")

    def rename(self, name: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {self.root}.`{name}` RENAME TO {self.root}.`{to}`")

    def drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.root}.`{name}`")

    def moved(self, name: str) -> None:
        pass

    def write(self, df: DataFrame, name: str) -> None:
        df.write.mode("errorifexists").saveAsTable(f"{self.root}.{name}")

    def read(self, name: str, schema=None) -> DataFrame:
        return self.spark.table(f"{self.root}.`{name}`")


Store = FolderStore | CatalogStore


def store(spark: SparkSession, root: str, fmt: str = "parquet") -> Store:
    """``fmt="table"``: the catalog schema ``root``; else files in the folder ``root``."""
    return CatalogStore(spark, root) if fmt == "table" else FolderStore(spark, root, fmt)


def recover(to: Store, name: str) -> None:
    """Finish or undo a replacement that died between its renames."""
    old = to.old_name(name)
    if not to.exists(old):
        return
    if to.exists(name):  # the new table took the name: the old one is spare
        to.drop(old)
    else:
        to.rename(old, name)
        to.moved(old)


def publish_table(to: Store, df: DataFrame, name: str, if_exists: str = "replace") -> DataFrame:
    """Write ``df`` as the table ``name`` and read it back.

    ``if_exists="replace"`` is CREATE OR REPLACE TABLE: readers find the old table
    until the new one is complete.  ``"error"`` is CREATE TABLE: ``TableExists`` if
    the name is taken, before anything runs or, if another run took it meanwhile,
    at the end; the table that is there stays."""
    if if_exists not in ("replace", "error"):
        raise ValueError(f"if_exists must be 'replace' or 'error', not {if_exists!r}")
    recover(to, name)
    if if_exists == "error" and to.exists(name):
        raise TableExists(name)
    new, old = to.new_name(name), to.old_name(name)
    try:
        to.write(df, new)
        if to.exists(name):
            if if_exists == "error":
                raise TableExists(name)
            to.rename(name, old)
        to.rename(new, name)
    except BaseException:
        to.drop(new)
        recover(to, name)
        raise
    to.moved(new)
    to.drop(old)
    return to.read(name, df.schema)


def read_published(to: Store, name: str) -> DataFrame:
    """The published table, also after a run that died between its renames."""
    recover(to, name)
    return to.read(name)
