"""URL filters: a sort-merge range join of urls with nested prefix rules.

A rule names a host and a path prefix.  Its key is the host with its labels
reversed, a separator and the path, so the urls it fits are one interval of
keys.  A url has one key for each host it belongs to (its own and all parent
domains).  Keys are dealt into buckets by sampled splitters; a rule goes to each
bucket its interval overlaps.  Each bucket is sorted and swept once with a
stack of the rules whose intervals are open, so memory is bounded by the
nesting depth, and a host with a third of all urls, even one url repeated, is split among buckets.

Defined cases: a null url or one without ``://`` has an empty host and path and
fits no rule; an empty host fits no rule; equal rules count once (block before
allow); of two fitting rules of one length the one with the longer host wins.
Other columns are not read.  Repeated rows are judged one by one.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genospark.llm import textarrays as T
from genospark.session import stored

#: Splitter sample: keys for each bucket.
SAMPLED_PER_BUCKET = 50
#: Ends the host in a key; sorts below every other character of a key.
END = "\x01"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, as the module says."""
    after = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_key(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(END), path)


def _buckets_of(splitters: Sequence[str], lo: pd.Series, hi: pd.Series) -> list[list[int]]:
    return [list(range(bisect.bisect_left(splitters, a), bisect.bisect_right(splitters, b) + 1))
            for a, b in zip(lo, hi, strict=True)]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (bucket, key, rule first) rows in; the deepest open rule of each url key out."""
    bucket, stack = None, []
    for batch in batches:
        found_row, found = [], []
        col = batch.to_pydict()
        for b, key, row, rule in zip(col["bucket"], col["key"], col["row"], col["rule"], strict=True):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if row is None:
                stack.append((key, rule))
            elif stack:
                found_row.append(row)
                found.append(stack[-1][1])
        yield pa.RecordBatch.from_arrays([pa.array(found_row, pa.int64()), pa.array(found, pa.string())],
                                         names=["row", "rule"])


def judge_urls(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", buckets: int | None = None) -> DataFrame:
    """The longest fitting rule of each url.

    ``rules`` has columns host, path, verdict.  Returns a row for each url row:
    its id, ``host``, ``path``, ``rule`` (host and path of the rule, else null)
    and ``verdict`` (the rule's, else ``default``).
    """
    T.bounded_batches(urls.sparkSession)
    spark = urls.sparkSession
    buckets = buckets or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col("__url"))
    parts = stored(urls.select(F.col(id_col).alias("id"), F.col(url_col).alias("__url"))
                   .select("id", host.alias("host"), path.alias("path"),
                           F.monotonically_increasing_id().alias("row")), "urls")

    rules = (rules.where("host <> '' AND path IS NOT NULL").groupBy("host", "path")
             .agg(F.max("verdict").alias("verdict"))  # block before allow
             .withColumn("key", reversed_key(F.col("host"), F.col("path"))))
    labels = F.split("host", r"\.")
    keys = (parts.where("host <> ''")
            .select("row", "path", F.posexplode(F.transform(
                labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))))
            .select("row", reversed_key(F.col("col"), F.col("path")).alias("key")))

    # balance only: any splitters give the same result
    n = keys.count()
    part = min(1.0, SAMPLED_PER_BUCKET * buckets / max(n, 1))
    sample = sorted(r[0] for r in keys.sample(part, 7).select("key").collect())
    splitters = [sample[i * len(sample) // buckets] for i in range(1, buckets)] if sample else []

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series, row: pd.Series) -> pd.Series:
        # a key that is several splitters has several buckets, dealt by row
        first = key.map(lambda k: bisect.bisect_left(splitters, k)).astype("int64")
        last = key.map(lambda k: bisect.bisect_right(splitters, k)).astype("int64")
        return (first + row % (last - first + 1)).astype("int32")

    @F.pandas_udf("array<int>")
    def overlapped(lo: pd.Series, hi: pd.Series) -> pd.Series:
        return pd.Series(_buckets_of(splitters, lo, hi), dtype=object)

    last = chr(0x10FFFF)
    opened = rules.select(
        F.explode(overlapped("key", F.concat("key", F.lit(last)))).alias("bucket"), "key",
        F.lit(None).cast("long").alias("row"),
        F.concat("verdict", F.lit(END), "host", "path").alias("rule"))
    met = keys.select(bucket_of("key", "row").alias("bucket"), "key", "row", F.lit(None).cast("string").alias("rule"))
    swept = (opened.unionByName(met)
             .repartition(buckets, "bucket").sortWithinPartitions("bucket", "key", F.col("row").isNotNull())
             .mapInArrow(_sweep, "row long, rule string"))
    # the hosts of one url are nested: the longest rule of all its keys
    rule = F.substring_index("rule", END, -1)
    best = (swept.groupBy("row").agg(F.max(F.struct(
        F.length(rule).alias("n"), F.length(F.substring_index(rule, "/", 1)).alias("h"), rule.alias("rule"),
        F.substring_index("rule", END, 1).alias("verdict"))).alias("b")))
    return (parts.join(best, "row", "left")
            .select(F.col("id").alias(id_col), "host", "path", F.col("b.rule").alias("rule"),
                    F.coalesce("b.verdict", F.lit(default)).alias("verdict")))


#: The rules of the registered query: host, path, verdict.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]

ORACLE_SQL = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(r, '^([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT page_id, host, path, h || p AS rule, v FROM parts LEFT JOIN rules
  ON (host = h OR host LIKE '%.' || h) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fits
"""
