"""Shared means against skew, long lineage and unchecked broadcasts."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Bound for a broadcast: bytes of all its values, counted before.
BROADCAST_BYTES = 8 << 20

# A value is hot when it has more rows than an even share of one partition, and at least
# this many; below, a task has little to do whatever its rows are.
HOT_ROWS = 20_000


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, which all executors share; else the session's warehouse.

    A warehouse on the driver's own disk does for a local session only. On a cluster executors could not read back what
    others wrote there, so such a session has to name a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    master = spark.conf.get("spark.master", "local")
    own_disk = warehouse.startswith("file:") or "://" not in warehouse
    if own_disk and not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path below the shared folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that lost executors do not replay its history."""
    path = scratch_path(df.sparkSession, "lineage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_size(df: DataFrame) -> int:
    """Bytes of all values of ``df``, written out as text; one aggregate."""
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def settle(df: DataFrame, most: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether its values take at most ``most`` bytes.

    For tables that drive a job, such as prepared queries: the plans that use them several
    times stay short, and nothing passes through the driver.
    """
    stored = cut_lineage(df)
    return stored, byte_size(stored) <= (BROADCAST_BYTES if most is None else most)


def hinted(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


# Rows that one task takes of a table whose rows are short and whose steps are not.
TASK_ROWS = 10_000


def dealt(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in tasks of about ``task_rows`` rows, however few files or row groups hold them.

    A scan is split by bytes, so millions of short rows that pack well are one task, and with it all steps in the row
    that follow. Rows are dealt by their own values, so a repeated task deals them alike and a NULL or repeated
    key weighs nothing; a table of one task's size stays as it is.
    """
    tasks = -(-df.count() // task_rows)
    return df.repartition(tasks, *df.columns) if tasks > 1 else df


def _salt(spread_by: list[str], salts: Column) -> Column:
    """Salt from the row's own values, so that a repeated task gives the same one."""
    return F.pmod(F.xxhash64(*spread_by), salts).cast("int")


# Values that a sketch of frequent ones follows at least, and per partition.
SKETCH_VALUES, SKETCH_PER_PARTITION = 4096, 16


def hot_values(df: DataFrame, on: list[str], hot_rows: int | None = None) -> DataFrame:
    """Rows ``(_hot, _salts)``: hash of each value of ``on`` that has more rows than an even share of one partition,
    and how many such shares it fills.

    One pass over the columns of ``on``: a sketch with a bounded number of counters per task, merged at the end. It
    follows several times as many values as can pass an even share, so those are in it; a count may be
    somewhat high, which only adds salts.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    followed = F.lit(min(1_000_000, max(SKETCH_VALUES, SKETCH_PER_PARTITION * partitions)))
    top = F.call_function("approx_top_k", F.xxhash64(*on), followed, followed)
    share = F.greatest(F.lit(HOT_ROWS), F.count("*") / partitions) if hot_rows is None else F.lit(hot_rows)
    found = df.agg(top.alias("top"), share.alias("share")).select("share", F.explode("top").alias("at"))
    return found.filter(F.col("at.count") > F.col("share")).select(
        F.col("at.item").alias("_hot"), F.ceil(F.col("at.count") / F.col("share")).cast("int").alias("_salts")
    )


def salted(df: DataFrame, on: list[str], spread_by: list[str], hot: DataFrame, small: bool) -> DataFrame:
    """``df`` with ``_salt``: rows of values in ``hot (_hot, _salts)`` are spread over their salts by ``spread_by``, others have 0."""
    joined = df.join(hinted(hot, small), F.xxhash64(*on) == F.col("_hot"), "left")
    return joined.withColumn("_salt", F.coalesce(_salt(spread_by, F.col("_salts")), F.lit(0))).drop("_hot", "_salts")


def per_salt(df: DataFrame, on: list[str], hot: DataFrame, small: bool) -> DataFrame:
    """``df``, the other side of ``salted``: rows of hot values repeated for each of their salts."""
    joined = df.join(hinted(hot, small), F.xxhash64(*on) == F.col("_hot"), "left")
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    return joined.withColumn("_salt", every_salt).drop("_hot", "_salts")


def hot_of_counts(counts: DataFrame, on: list[str], n_col: str, least: int) -> tuple[DataFrame, bool]:
    """Hot values ``(_hot, _salts)`` of a table that has the rows per value already, settled.

    A value is hot above an even share of one partition, and above ``least``; so there are no more of them than partitions.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(least, (counts.agg(F.sum(n_col)).first()[0] or 0) // partitions)
    hot = counts.filter(F.col(n_col) > share).groupBy(F.xxhash64(*on).alias("_hot"))
    return settle(hot.agg(F.ceil(F.max(n_col) / share).cast("int").alias("_salts")))


def lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: list[str], how: str = "left", hot_rows: int | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """Join ``left``, where one value of ``on`` may hold most rows, with ``right``.

    The hot values of ``left`` are found in one pass over its key columns; ``left`` itself is not stored, and without
    a hot value this is a plain join. Else the rows of hot values are spread
    over as many salts as the value fills shares of a partition, and their rows on the right, usually one, are repeated
    per salt; NULL counts as a value. A hash collision only adds salts. ``spread_by``
    names columns of ``left`` that differ between the rows of one value. ``keys`` is a cheaper table to find hot values
    in, with at least as many rows per value.
    """
    hot = cut_lineage(hot_values(left if keys is None else keys, on, hot_rows))
    size = byte_size(hot)
    if size == 0:
        return left.join(right, on, how)
    small = size <= BROADCAST_BYTES
    return salted(left, on, spread_by, hot, small).join(per_salt(right, on, hot, small), [*on, "_salt"], how).drop("_salt")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark cuts every partition to one row per key before the shuffle, so a key with very
    many copies does not fill a task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


_TOP_SALTS = 64


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, spread_by: list[str], rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key with their rank.

    Up to 1000 Spark limits the groups before the shuffle by itself; beyond, a salted
    first round does.
    """
    if k > 1000:
        df = df.withColumn("_salt", _salt(spread_by, F.lit(_TOP_SALTS)))
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = df.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") <= k).drop("_rank", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
