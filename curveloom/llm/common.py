"""What the operators share: tables, scratch tables in the shared folder, and connected components."""

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curveloom.sources.store import kept


def prepare(spark: SparkSession) -> None:
    """Lets the Python workers of this machine import the package from where the driver has it, and give memory back early.

    Workers live on from stage to stage, and what one stage's batches leave in their allocators would count against the next.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    for name, value in (("MALLOC_ARENA_MAX", "2"), ("ARROW_DEFAULT_MEMORY_POOL", "system")):
        environment.setdefault(name, value)
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, without lineage, safe from lost executors.

    It is deleted with the ``scratch`` of ``curveloom.sources.store`` that it is written in.
    """
    return kept(df, f"training-data/{name}")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for added columns: as wanted, with underscores in front while the input has such a column."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        names.append(name)
        taken.add(name.lower())
    return names


def in_share(hashed: Column, share: float) -> Column:
    """True for a share of the 64-bit hashes, however small: all 63 bits below the sign are compared."""
    return hashed.bitwiseAND(F.lit(2 ** 63 - 1)) <= F.lit(min(2 ** 63 - 1, int(share * 2.0 ** 63)))


def documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (a missing text is empty), whatever other columns there are."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(F.col(text_column)).alias("text"))


def whole_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for each node of the links: the smallest node that can be reached.

    Alternating large-star and small-star steps (Kiveris et al. 2014): every round is a grouping of the links that
    are left, so no task holds more than the neighbours of one node, and no link or component reaches the driver.
    A star's neighbours are aggregated to their minimum before the shuffle, so a hot node costs one row a task.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = written(links.selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "links")
    while True:
        both = links.unionByName(links.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("low")).selectExpr("u", "least(u, low) AS low")
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "low AS v").where("u <> v").distinct()
        large = written(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").selectExpr("if(v = low, u, v) AS u", "low AS v").where("u <> v").distinct()
        after = written(small, "small-star")
        # A fixed point has every node under its component's smallest one, and the steps no longer change it.
        if _same(links, after):
            return after.selectExpr("u AS node", "v AS component").unionByName(
                after.selectExpr("v AS node", "v AS component").distinct())
        links = after


def _same(one: DataFrame, two: DataFrame) -> bool:
    digest = [F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"),
              F.expr("bit_xor(xxhash64(v, u))").alias("x")]
    return one.agg(*digest).first() == two.agg(*digest).first()
