"""Versioned data-model datasets (S3, S5, S6, S7) and the hyper-parameter table.

A data model lives in the folder ``version / model / out / split`` of a dataset root; each
folder has its model's own columns.  A writer claims its number first, by creating a file that
must not exist (so two writers get two numbers), writes the folders, and creates the version's
``_COMMITTED`` marker last.  Readers see versions with a marker only: what a job leaves behind that died on
the way is never read, and its number is not used again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def latest_version(df: DataFrame, version: str = "version") -> DataFrame:
    """Rows of the highest version."""
    top = df.agg(F.max(version).alias("_v"))
    return df.join(top, F.col(version) == F.col("_v"), "left_semi")


def _folder(spark: SparkSession, path: str):
    """(file system, path) of a folder in whatever store Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


MARKER, CLAIMS = "_COMMITTED", "_claims"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _folder(spark, folder)
    if not fs.exists(path):
        return []
    found = [re.fullmatch(r"version=(\d+)", st.getPath().getName()) for st in fs.listStatus(path)]
    return sorted(int(m[1]) for m in found if m)


def _marker(spark: SparkSession, root: str, version: int):
    return _folder(spark, f"{root}/version={version}/{MARKER}")


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    """The versions that are whole, ascending."""
    return [v for v in _numbers(spark, root) if (lambda fs, p: fs.exists(p))(*_marker(spark, root, v))]


def abandoned_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers that were claimed or begun and have no marker: of writers that still run, or that died."""
    done = set(committed_versions(spark, root))
    return [v for v in sorted({*_numbers(spark, root), *_numbers(spark, f"{root}/{CLAIMS}")}) if v not in done]


def latest_version_number(spark: SparkSession, root: str) -> int:
    """Highest committed version in a dataset root, 0 when there is none."""
    return max(committed_versions(spark, root), default=0)


def _created(spark: SparkSession, fs, path) -> bool:
    """Create an empty file unless it exists; False where it does, also when another writer was first by a moment."""
    from py4j.protocol import Py4JJavaError
    try:
        if fs.getScheme() != "file":
            return fs.createNewFile(path)   # one creator wins in the store
        fs.mkdirs(path.getParent())         # Hadoop's local files look first and create then; Java's create or fail
        java = spark._jvm.java
        java.nio.file.Files.createFile(java.io.File(path.toUri().getPath()).toPath(),
                                       spark._sc._gateway.new_array(java.nio.file.attribute.FileAttribute, 0))
        return True
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise


def claim_version(spark: SparkSession, root: str, version: int | None = None) -> int:
    """The number of a new version, which no other writer gets: the highest begun + 1, or ``version``
    itself, which must be new."""
    while True:
        taken = {*_numbers(spark, root), *_numbers(spark, f"{root}/{CLAIMS}")}
        v = max(taken, default=0) + 1 if version is None else version
        fs, claim = _folder(spark, f"{root}/{CLAIMS}/version={v}")
        if v not in taken and _created(spark, fs, claim):   # fails where another writer was first
            return v
        if version is not None:
            raise FileExistsError(f"version {v} of {root} exists; versions are never overwritten")


def commit_version(spark: SparkSession, root: str, version: int) -> None:
    """Make a claimed version visible; everything of it must be written."""
    fs, marker = _marker(spark, root, version)
    if not _created(spark, fs, marker):
        raise FileExistsError(f"version {version} of {root} is committed already")


def check_committed(spark: SparkSession, root: str, version: int | None) -> int:
    """The version to read: the latest one, or ``version`` if it is whole."""
    if version is None:
        version = latest_version_number(spark, root)
    elif version not in committed_versions(spark, root):
        raise FileNotFoundError(f"{root} has no committed version {version}")
    return version


def _partition(root: str, version: int, model: int, out: int, split: str) -> str:
    return f"{root}/version={version}/model={model}/out={out}/split={split}"


def write_data_model(splits: dict[str, DataFrame], root: str, *, version: int, model: int,
                     out: int) -> None:
    """Write each split of one data model to its folder of a claimed version; a folder that
    exists is refused, before anything is written.  ``commit_version`` makes it visible."""
    paths = {split: _partition(root, version, model, out, split) for split in splits}
    for split, df in splits.items():
        fs, path = _folder(df.sparkSession, paths[split])
        if fs.exists(path):
            raise FileExistsError(f"{paths[split]} exists; versions are never overwritten")
    for split, df in splits.items():
        df.write.mode("errorifexists").parquet(paths[split])


def read_data_model(spark: SparkSession, root: str, *, model: int, out: int, split: str = "main",
                    version: int | None = None) -> DataFrame:
    """S3: one data model with exactly its own columns (models differ); ``version=None``
    reads the latest."""
    return spark.read.parquet(_partition(root, check_committed(spark, root, version), model, out, split))


def write_processed(df: DataFrame, root: str, *, version: int | None = None, audit=None) -> int:
    """The processed table of Entry 1 as a new version of a dataset; returns the version.  The table of an
    ``audit`` (A12) is kept with it."""
    spark = df.sparkSession
    v = claim_version(spark, root, version)
    df.write.mode("errorifexists").parquet(f"{root}/version={v}/table")
    if audit is not None:
        out = spark.read.parquet(f"{root}/version={v}/table")
        audit.step("written", out.count(), out)   # from the files' footers
        audit.table(spark).write.mode("errorifexists").parquet(f"{root}/version={v}/steps")
    commit_version(spark, root, v)
    return v


def read_processed(spark: SparkSession, root: str, *, version: int | None = None) -> DataFrame:
    """The processed table; ``version=None`` reads the latest."""
    return spark.read.parquet(f"{root}/version={check_committed(spark, root, version)}/table")


def read_steps(spark: SparkSession, root: str, *, version: int | None = None) -> DataFrame:
    """The step counts kept with a processed version."""
    return spark.read.parquet(f"{root}/version={check_committed(spark, root, version)}/steps")


def hyper_parameters(params: DataFrame, *, algorithm: str, model_version: int, data_model: int,
                     out: int, algo_version: int | None = None) -> DataFrame:
    """The parameter row for (algorithm, model version, data model, outcome);
    without ``algo_version`` the latest algorithm version is taken."""
    sel = params.where((F.col("algorithm") == algorithm) & (F.col("model_version") == model_version)
                       & (F.col("data_model") == data_model) & (F.col("out") == out))
    if algo_version is not None:
        return sel.where(F.col("algo_version") == algo_version)
    return latest_parameters(sel)


def latest_parameters(params: DataFrame) -> DataFrame:
    """S10 over a whole table: per key, the params of the highest algorithm
    version (a later ``param_id`` wins a tie, when the table has one)."""
    keys = ["algorithm", "model_version", "data_model", "out"]
    order = (F.struct("algo_version", "param_id") if "param_id" in params.columns
             else F.col("algo_version"))
    return params.groupBy(*keys).agg(F.max("algo_version").alias("algo_version"),
                                     F.max_by("params", order).alias("params"))
