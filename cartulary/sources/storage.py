"""Parquet tables by path.

Three kinds of table:

* versioned (`write_version`): each full rewrite goes to `<table>/v=<n>/`. A version is
  visible once its `_SUCCESS` marker exists, so a reader never sees a half-written one
  and a job may read version n while it writes n + 1;
* partitioned (`replace_partition`, `append`): plain directories, replaced one
  partition at a time;
* keyed (`replace_folders`): rows lie in folders by key hash. `<table>/w=<n>/_folder=<b>/` holds
  folder b as write n left it, and the versioned `<table>/manifest` names the write of each folder.
  A merge adds a write of the folders it touched, then a manifest: readers see all of it or
  nothing, and other folders are neither read nor copied.

Each table has one writer. Nothing here spans two tables atomically.
"""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def _files(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _files(spark, path)
    return fs.exists(jvm_path)


def matching_paths(spark: SparkSession, pattern: str, files_only: bool = False) -> list[str]:
    jvm_path, fs = _files(spark, pattern)
    found = fs.globStatus(jvm_path) or []
    return sorted(s.getPath().toString() for s in found if s.isFile() or not files_only)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _files(spark, path)
    fs.delete(jvm_path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint setting.

    Only where it is unset and the session is local (tests) a local one is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^-]*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = tempfile.mkdtemp(prefix="cartulary-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing the rows once to the shared folder, so that later branches read the same ones."""
    return stage(df, "settled")[0]


#: Rows full of digests: as hex text only this codec stores them in half.
DENSE = "zstd"


def stage(df: DataFrame, label: str, *partitions: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """Write once to the shared folder and read back: computed once, still columnar."""
    path = scratch_folder(df.sparkSession, label)
    df.write.partitionBy(*partitions).parquet(path, compression=codec)
    return df.sparkSession.read.schema(_nullable(df)).parquet(path), path


def _nullable(df: DataFrame) -> StructType:
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])


# -- versioned tables ---------------------------------------------------------------------


def _versions(spark: SparkSession, table: str) -> dict[int, bool]:
    """Version number -> complete or not."""
    numbers = {
        int(match.group(1)): False
        for path in matching_paths(spark, f"{table}/v=*")
        if (match := re.search(r"/v=(\d+)$", path))
    }
    for path in matching_paths(spark, f"{table}/v=*/_SUCCESS"):
        numbers[int(re.search(r"/v=(\d+)/_SUCCESS$", path).group(1))] = True
    return numbers


def current_version(spark: SparkSession, table: str) -> int | None:
    return max((n for n, complete in _versions(spark, table).items() if complete), default=None)


def table_exists(spark: SparkSession, table: str) -> bool:
    return is_keyed(spark, table) or current_version(spark, table) is not None


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a versioned or keyed table."""
    if is_keyed(spark, table):
        return read_folders(spark, table, read_manifest(spark, table)).drop(FOLDER)
    version = current_version(spark, table)
    if version is None:
        raise FileNotFoundError(f"no complete version of {table}")
    return spark.read.parquet(f"{table}/v={version}")


def write_version(df: DataFrame, table: str, keep: int = 2) -> int:
    """Full rewrite with whatever schema `df` has. Older versions beyond `keep` are dropped."""
    spark = df.sparkSession
    known = _versions(spark, table)
    number = max(known, default=0) + 1
    df.write.parquet(f"{table}/v={number}")
    complete = sorted(n for n, done in known.items() if done)
    for old in complete[: max(0, len(complete) + 1 - keep)]:
        drop_path(spark, f"{table}/v={old}")
    return number


# -- keyed tables -------------------------------------------------------------------------

FOLDER = "_folder"
#: Folders of a new table. One is one task of a merge, so a table takes as many as its size asks for.
KEY_FOLDERS = 64


@dataclass(frozen=True)
class Manifest:
    """The write that each folder lies in, how many folders keys are dealt to, and the rows' schema."""

    writes: dict[int, int]
    folders: int
    schema: StructType


def folder_of(df: DataFrame, key: str, folders: int) -> Column:
    """The folder of each row by its key; rows without a key are spread by their content."""
    plain = [name for name, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    place = F.when(F.col(key).isNull(), F.xxhash64(*plain)).otherwise(F.xxhash64(key))
    return F.pmod(place, F.lit(folders)).cast("int")


def is_keyed(spark: SparkSession, table: str) -> bool:
    return current_version(spark, f"{table}/manifest") is not None


def read_manifest(spark: SparkSession, table: str) -> Manifest:
    version = current_version(spark, f"{table}/manifest")
    rows = spark.read.parquet(f"{table}/manifest/v={version}").collect()
    return Manifest({r.folder: r.write for r in rows if r.folder is not None}, rows[0].folders, StructType.fromJson(json.loads(rows[0].schema)))


def read_folders(spark: SparkSession, table: str, manifest: Manifest, folders: list[int] | None = None) -> DataFrame:
    """The rows of some folders, or of all, with `_folder`."""
    wanted = [b for b in (manifest.writes if folders is None else folders) if b in manifest.writes]
    schema = StructType([*manifest.schema.fields, StructField(FOLDER, IntegerType())])
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{table}/w={manifest.writes[b]}/{FOLDER}={b}" for b in wanted]
    placed = StructType([*schema.fields, StructField("w", IntegerType())])
    return spark.read.schema(placed).option("basePath", table).parquet(*paths).select(*schema.fieldNames())


def write_folders(df: DataFrame, table: str) -> int:
    """Write rows with `_folder` beside the table's; they are not part of it before `replace_folders`."""
    spark = df.sparkSession
    number = 1 + max((int(p.rsplit("=", 1)[1]) for p in matching_paths(spark, f"{table}/w=*")), default=0)
    df.write.partitionBy(FOLDER).parquet(f"{table}/w={number}", compression=DENSE)
    return number


def replace_folders(spark: SparkSession, table: str, number: int, folders: int, schema: StructType, keep: int = 2) -> None:
    """Make the folders of write `number` part of the table, in place of older ones."""
    written = [int(p.rsplit("=", 1)[1]) for p in matching_paths(spark, f"{table}/w={number}/{FOLDER}=*")]
    before = read_manifest(spark, table).writes if is_keyed(spark, table) else {}
    own = json.dumps(schema.jsonValue())
    rows = [(None, None, folders, own), *[(b, w, folders, own) for b, w in {**before, **dict.fromkeys(written, number)}.items()]]
    write_version(spark.createDataFrame(rows, "folder int, write int, folders int, schema string").coalesce(1), f"{table}/manifest", keep)
    named = spark.read.option("basePath", f"{table}/manifest").parquet(*matching_paths(spark, f"{table}/manifest/v=*"))
    used = {(r.write, r.folder) for r in named.select("write", "folder").distinct().collect()}
    for path in matching_paths(spark, f"{table}/w=*/{FOLDER}=*"):
        write, folder = re.search(rf"/w=(\d+)/{FOLDER}=(\d+)$", path).groups()
        if (int(write), int(folder)) not in used:
            drop_path(spark, path)


# -- partitioned tables -------------------------------------------------------------------


def read_partitioned(spark: SparkSession, table: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(table)


def replace_partition(df: DataFrame, table: str, column: str, value: object) -> None:
    """Make `column = value` hold exactly the rows of `df`, none included.

    Dynamic partition overwrite is not used: an empty `df` would leave the old rows.
    """
    df.drop(column).write.mode("overwrite").parquet(f"{table}/{column}={value}", compression=DENSE)


def replace_partitions(df: DataFrame, table: str, column: str, values: list) -> None:
    """Replace the partitions `values` in one job; one that gets no row ends up empty.

    Each keeps its old rows until the job commits.
    """
    spark = df.sparkSession
    files = f"{table}/{column}={{{','.join(map(str, values))}}}/part-*"
    before = set(matching_paths(spark, files))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(table, compression=DENSE)
    )
    after = matching_paths(spark, files)
    name = lambda path: path.rsplit("/", 2)[1]
    filled = {name(path) for path in after} - {name(path) for path in before.intersection(after)}
    for value in values:
        if f"{column}={value}" not in filled:
            replace_partition(df.limit(0), table, column, value)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").parquet(table)


def drop_partitions_before(spark: SparkSession, table: str, column: str, cutoff: str) -> list[str]:
    """Delete the partition directories whose value sorts before `cutoff`."""
    gone = []
    for path in matching_paths(spark, f"{table}/{column}=*"):
        value = path.rsplit(f"{column}=", 1)[1]
        if value < cutoff:
            drop_path(spark, path)
            gone.append(value)
    return gone
