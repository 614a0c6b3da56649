"""URL filter: a sort-merge range join of reversed-host keys with a sweep over nested rules."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host lower-cased in A-Z; both empty for a null or a text without ``://``."""
    has = F.coalesce(F.locate("://", url) > 0, F.lit(False))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def host_key(host: Column) -> Column:
    """Labels last to first, each closed by a dot: a host and its subdomains share this as a prefix."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))
    )


class _Node:
    """Rules of one host: path to (rule, verdict), and the lengths that occur, longest first."""

    def __init__(self, key: str) -> None:
        self.key, self.paths, self.lengths = key, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.paths or (rule, verdict) < self.paths[path]:
            self.paths[path] = (rule, verdict)
        if -len(path) not in self.lengths:
            bisect.insort(self.lengths, -len(path))

    def longest(self, path: str) -> tuple[str, str] | None:
        for n in self.lengths:
            if -n <= len(path) and (found := self.paths.get(path[:-n] if n else "")):
                return found
        return None


def _sweep(default: str, kinds: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Node] = []
        bucket = None
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in ("bucket", "is_url", "key", "path", "rule", "verdict")}
            keep, rules, verdicts = [], [], []
            for i, (b, is_url, key, path, rule, verdict) in enumerate(zip(*col.values(), strict=True)):
                if b != bucket:
                    bucket, stack = b, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].key != key:
                        stack.append(_Node(key))
                    stack[-1].add(path, rule, verdict)
                    continue
                found = None
                for node in reversed(stack):
                    if found := node.longest(path):
                        break
                keep.append(i)
                rules.append(found[0] if found else None)
                verdicts.append(found[1] if found else default)
            kept = batch.take(pa.array(keep, pa.int64()))
            arrays = [kept.column(n) for n in kinds]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], [*kinds, "rule", "verdict"])

    return run


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", rows_per_bucket: int = 1024, most_buckets: int = 8192) -> DataFrame:
    """Judge each page by the longest rule that fits its url.

    ``pages``: page_id, url; other columns are not read. ``rules``: host, path, verdict. Returns
    page_id, host, path, rule, verdict, one row per page.

    A rule fits its host and all subdomains, if the url's path starts with the rule's. Of several,
    the longest host wins, then the longest path. A reversed host ends each label with a dot, so all
    hosts of a rule are one interval of keys; intervals of rules nest or are apart. The keys are cut
    into buckets of about ``rows_per_bucket`` rows (beyond ``most_buckets`` of them, larger ones) at
    places taken from a bounded sample of keys, which only balances the work. A rule goes to each bucket that its interval meets. A key with
    more rows than a bucket holds gets several buckets, and its urls are dealt among them. Within a
    bucket the rows come sorted, a rule ahead of the keys it covers, and the sweep keeps a stack of
    the rules whose interval holds the present key.

    A null url or one without ``://`` has an empty host and path, no rule, and the default verdict.
    A null host, path or verdict of a rule makes it no rule; an empty host fits nothing. Repeated
    pages are judged one by one. Of equal rules with two verdicts, the smaller word holds.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    live = rules.select("host", "path", "verdict").dropna().filter(F.col("host") != "").distinct()
    rule_rows = live.select(
        host_key(F.translate("host", _UPPER, _LOWER)).alias("key"), F.col("path"),
        F.concat("host", "path").alias("rule"), "verdict",
    )

    # Cuts of the key range: every 8th of a sorted sample, which is bounded by ``most_buckets``.
    n = urls.count()
    count = min(most_buckets, -(-n // rows_per_bucket))
    sample = urls.select("key").sample(min(1.0, 8 * count / n), seed=7) if count > 1 else urls.select("key").limit(0)
    cuts = sorted(r["key"].encode() for r in sample.limit(16 * count).collect())[7::8]
    bucket_of = _buckets(cuts)
    kinds = ["page_id", "host", "path"]
    dealt_urls = urls.withColumn("span", bucket_of("key", F.lit(False))).select(
        (F.col("span.low") + F.pmod(F.xxhash64("page_id", "path"), F.col("span.high") - F.col("span.low") + 1)).alias("bucket"),
        F.lit(True).alias("is_url"), "key", "path", F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"), "page_id", "host",
    )
    dealt_rules = rule_rows.withColumn("span", bucket_of("key", F.lit(True))).select(
        F.explode(F.sequence("span.low", "span.high")).alias("bucket"), F.lit(False).alias("is_url"), "key", "path",
        "rule", "verdict", F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"), F.lit(None).cast("string").alias("host"),
    )
    parts = max(count, int(spark.conf.get("spark.sql.shuffle.partitions")))
    swept = dealt_urls.unionByName(dealt_rules).repartition(parts, "bucket").sortWithinPartitions("bucket", "key", "is_url")
    kind = swept.schema
    out = ", ".join([f"{c} {kind[c].dataType.simpleString()}" for c in kinds] + ["rule string", "verdict string"])
    return swept.mapInArrow(_sweep(default, kinds), out)


def _buckets(edges: list[bytes]):
    """key to the first and last bucket: of the keys equal to it, or with ``covers`` of all it is a prefix of.

    Keys are compared as UTF-8 bytes, as Spark sorts them.
    """
    def find(keys: pa.Array, covers: pa.Array) -> pa.Array:
        low, high = [], []
        for key, wide in zip(keys.to_pylist(), covers.to_pylist(), strict=True):
            k = key.encode()
            low.append(bisect.bisect_left(edges, k))
            high.append(bisect.bisect_right(edges, k + b"\xff" if wide else k))
        return pa.StructArray.from_arrays([pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["low", "high"])

    udf = F.arrow_udf(find, "low bigint, high bigint")
    return lambda key, covers: udf(F.col(key), covers)
