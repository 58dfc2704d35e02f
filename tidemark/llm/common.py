"""Helpers shared by the operators: inputs, staging, sizes."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import until_exit
from tidemark.session import shared_dir

#: Separators of words as Java and RE2 expressions: ASCII white space only.
SPACE = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it.

    Clusters that install the package on executors already have it on their path; there the
    extra entry names a folder that does not exist and changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names, shared by all executors. It is removed when the
    application ends."""
    return f"{until_exit(spark, f'{shared_dir(spark)}/llm-{uuid.uuid4().hex}')}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here, and a lost
    executor costs the tasks it ran, not the stages before."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fold(column: str = "doc_id") -> F.Column:
    """crc32 of an id as text, as the contracts use it to set rows aside."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of a table has, whatever case: the given ones, with as many underscores before them as that takes."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
