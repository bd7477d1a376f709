"""URL filters: host and path rules, and a block list in a sorted digest array.

The list holds hosts (blocked with all their subdomains) and addresses (host and path, blocked exactly). Its entries are
hashed to 64 bits and sorted into one file in the shared folder, which Spark hands to every executor; tasks map it into
memory, look up the digests of a URL's host, its parent domains and its address by one vectorised binary search, and
compare the stored string of every hit, so a collision never blocks. The driver gathers the list only up to
``MAX_ENTRIES`` entries and ``MAX_BYTES`` bytes; a longer list is joined instead, with the same result.

A missing URL, or one without "://", has an empty host and path; no rule fits it and it is not looked up. Rows that
repeat are judged each for itself. Missing and empty entries of the list are left out, repeated ones change nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideshift.llm.common import map_texts, utf8
from tideshift.session import scratch_path

MAX_ENTRIES = 10_000_000
MAX_BYTES = 256 << 20


def host_of(url: Column) -> Column:
    """What stands between the first "://" and the next of "/?#", with A-Z lower-cased; empty if there is none."""
    found = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to the next of "?#"; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of the rules that fit, else null. A rule is a domain, "/" and the start of a path."""
    chosen = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, start = rule.partition("/")
        inside = (host == domain) | F.endswith(host, F.lit("." + domain))
        chosen = F.when(inside & F.startswith(path, F.lit(slash + start)), F.lit(rule)).otherwise(chosen)
    return chosen


class DigestArray:
    """Sorted 64-bit digests with their strings, mapped from a file: count, digests, offsets, bytes."""

    def __init__(self, path: str):
        n = int(np.fromfile(path, "<u8", 1)[0])
        self.keys = np.memmap(path, "<u8", "r", 8, n) if n else np.zeros(0, np.uint64)
        self.offsets = np.memmap(path, "<u8", "r", 8 + 8 * n, n + 1)
        self.longest = int(np.diff(self.offsets).max()) if n else 0
        self.strings = np.memmap(path, np.uint8, "r", 16 + 16 * n) if int(self.offsets[-1]) else np.zeros(0, np.uint8)

    @staticmethod
    def pack(entries: Sequence[bytes]) -> list[bytes]:
        """The parts of the file."""
        digests = np.array([xxhash.xxh64_intdigest(e) for e in entries], "<u8")
        order = np.argsort(digests, kind="stable")
        data = [entries[i] for i in order.tolist()]
        offsets = np.concatenate([[0], np.cumsum([len(e) for e in data])]).astype("<u8")
        return [np.array([len(data)], "<u8").tobytes(), digests[order].tobytes(), offsets.tobytes(), b"".join(data)]

    def holds(self, values: Sequence[bytes], digests: np.ndarray | None = None) -> np.ndarray:
        """Which values stand in the array."""
        if digests is None:
            digests = np.array([xxhash.xxh64_intdigest(v) for v in values], np.uint64)
        at = np.searchsorted(self.keys, digests)
        out = np.zeros(len(digests), bool)
        hit = np.flatnonzero(at < len(self.keys))
        hit = hit[self.keys[at[hit]] == digests[hit]] if len(hit) else hit
        for i in hit.tolist():  # few, and each one is compared in full
            k = int(at[i])
            while not out[i] and k < len(self.keys) and self.keys[k] == digests[i]:
                out[i] = self.strings[int(self.offsets[k]) : int(self.offsets[k + 1])].tobytes() == values[i]
                k += 1
        return out


def candidates(host: str, path: str, longest: int) -> list[bytes]:
    """What of a URL may stand in a list: its host, the host's parent domains, and its address.

    Nothing longer than the longest entry can, which keeps this short for hosts of any length.
    """
    if not host:
        return []
    found = [host] if len(host) <= longest else []
    at = host.find(".", max(0, len(host) - longest - 1))
    while 0 <= at < len(host) - 1:
        found.append(host[at + 1 :])
        at = host.find(".", at + 1)
    if len(host) + len(path) <= longest:
        found.append(host + path)
    return [f.encode() for f in found]


def share_list(spark: SparkSession, entries: DataFrame, column: str = "entry") -> str | None:
    """Write the list for the executors and give the file's name, or None if it is too long to gather."""
    listed = entries.select(F.col(column).alias("e")).where("e is not null and e <> ''").distinct()
    size = listed.agg(F.count("e").alias("n"), F.coalesce(F.sum(F.octet_length("e")), F.lit(0)).alias("b")).collect()[0]
    if size["n"] > MAX_ENTRIES or size["b"] > MAX_BYTES:
        return None
    found = listed.toArrow().column("e").to_pylist()
    name = f"urls-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "lists"), name)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    for part in DigestArray.pack([e.encode() for e in found]):
        for start in range(0, len(part), 16 << 20):
            out.write(bytearray(part[start : start + (16 << 20)]))
    out.close()
    spark.sparkContext.addFile(path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString())
    return name


def listed_by_array(df: DataFrame, name: str) -> DataFrame:
    """``df`` with ``__listed``: whether something of ``__host`` and ``__path`` stands in the shared file."""
    schema = T.StructType([*df.schema.fields, T.StructField("__listed", T.BooleanType())])

    def work():
        stored = DigestArray(SparkFiles.get(name))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            hosts, paths = batch.column("__host").to_pylist(), batch.column("__path").to_pylist()
            values, row = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                made = candidates(host, path, stored.longest)
                values += made
                row += [i] * len(made)
            found = np.zeros(len(hosts), bool)
            if values:
                found[np.array(row)[stored.holds(values)]] = True
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=schema.names)

        return step

    return map_texts(df, work, schema, "__path")


def listed_by_join(df: DataFrame, entries: DataFrame, column: str = "entry") -> DataFrame:
    """As ``listed_by_array`` for lists of any length."""
    listed = entries.select(F.col(column).alias("e")).where("e is not null and e <> ''").distinct()
    longest = listed.agg(F.max(F.length("e"))).collect()[0][0] or 0
    # The end of the host that can hold an entry, cut at its dots: all that follows a dot is a parent domain.
    end = f"right(__host, {longest} + 1)"
    parents = F.expr(
        f"transform(filter(sequence(1, length({end})), i -> substr({end}, i, 1) = '.'), i -> substr({end}, i + 1))"
    )
    seen = df.select("__host", "__path").where("__host <> ''").distinct()
    parts = seen.withColumn("e", F.explode(F.concat(parents, F.array("__host", F.concat("__host", "__path")))))
    hits = parts.join(listed, "e", "left_semi").select("__host", "__path").distinct().withColumn("__listed", F.lit(True))
    return df.join(hits, ["__host", "__path"], "left").withColumn("__listed", F.coalesce("__listed", F.lit(False)))


def judge(
    df: DataFrame, rules: Sequence[tuple[str, str]], entries: DataFrame, url: str = "url", keep: Sequence[str] = ("page_id",),
    column: str = "entry",
) -> DataFrame:
    """The kept columns with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.

    ``rules`` are pairs of a rule and its verdict. Where none fits, listed URLs are blocked and others allowed.
    Kept columns of these names are replaced.
    """
    keep = [k for k in keep if k not in ("host", "path", "rule", "listed", "verdict")]
    parts = df.select(*keep, host_of(F.col(url)).alias("__host"), path_of(F.col(url)).alias("__path"))
    name = share_list(df.sparkSession, entries, column)
    found = listed_by_array(parts, name) if name else listed_by_join(parts, entries, column)
    ruled = found.withColumn("__rule", matching_rule(F.col("__host"), F.col("__path"), rules))
    verdict = F.lit(None).cast("string")
    for rule, what in rules:
        verdict = F.when(F.col("__rule") == rule, F.lit(what)).otherwise(verdict)
    fallback = F.when(F.col("__listed"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        *keep, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule").alias("rule"),
        F.col("__listed").alias("listed"), F.coalesce(verdict, fallback).alias("verdict"),
    )


def hosts_with_labels(df: DataFrame, labels: Sequence[str], url: str = "url") -> DataFrame:
    """A block list from the URLs themselves: ``entry``, every domain that starts with one of the labels."""
    pattern = r"(?:^|\.)((?:" + "|".join(labels) + r")\..+)$"
    entry = F.regexp_extract(host_of(F.col(url)), pattern, 1)
    return df.select(entry.alias("entry")).where("entry <> ''").distinct()
