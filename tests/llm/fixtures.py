"""Small tables with every awkward row, and helpers to run queries on them."""

from __future__ import annotations

import random

import duckdb
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that operators use inside; a table may have them too.
CLASHING = ["id", "row", "key", "part", "shard", "slice", "digest", "kept", "host", "path", "rule", "at", "size",
            "segment", "bucket", "token", "text_sha256", "score", "n_words", "good", "held_out", "train", "node", "root"]


def words(rng: random.Random, n: int, size: int = 400) -> str:
    return " ".join(f"w{int(size * rng.random() ** 2)}x" for _ in range(n))


def messy_texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    base = [words(rng, rng.randint(1, 120)) for _ in range(25)]
    long = words(rng, 6000)
    passage = words(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 5]) for i in range(12)]  # exact copies
    for i in range(10):  # near copies
        w = base[3 + i % 4].split()
        w[rng.randrange(len(w))] = "edited"
        rows.append((200 + i, " ".join(w)))
    rows += [(300 + i, f"{words(rng, 40)} {passage} {words(rng, 40)}") for i in range(8)]
    rows += [(400, long), (401, long + " end"), (402, ""), (403, None), (404, "   \n\t "), (405, "one two"),
             (406, "One TWO"), (407, "déjà vu ß 日本語 naïve"), (408, "!!! *** ###"), (409, "x"), (410, "x"),
             (None, "a text without id"), (None, None), (411, "same row"), (411, "same row")]
    return rows


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    if clashing:
        df = df.select("*", *(F.lit(None).cast("string").alias(c) for c in CLASHING))
    return df


def empty(spark: SparkSession, schema: str = "doc_id long, text string") -> DataFrame:
    return spark.createDataFrame([], schema)


def folder(spark: SparkSession, path: str, **tables: DataFrame) -> str:
    """Write the tables as <path>/<name>.parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return path


def in_duckdb(path: str, sql: str, *tables: str) -> list[tuple]:
    """Rows of the SQL over the tables of a folder, columns by name, sorted."""
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet/*.parquet')")
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return as_rows(names, out.fetchall())


def as_rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def collected(df: DataFrame) -> list[tuple]:
    return as_rows(df.columns, df.collect())
