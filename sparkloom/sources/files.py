"""Reading files: trees of sources, digests, JSON lines, manifests and transfers."""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import urllib.error
import urllib.request
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.strict_json import Number, Refused, canonical, parse
from sparkloom.operators.text import is_portable_path
from sparkloom.sources.sinks import sharded_manifest


def discover(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, sha256, bytes`` of each file under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def tree_scan(spark: SparkSession, root: str, glob: str = "*.py", depth: int = 64) -> DataFrame:
    """``relative_path, content, bytes, sha256, status`` of a source tree; unportable files are kept with their status, so skips can be counted. Spark passes over empty files itself."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    plain = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    relative = F.expr(f"substring_index(path, '{root.rstrip('/').replace(chr(39), '')}/', -1)") if root.startswith("/") else plain
    status = F.when(~is_portable_path(F.col("relative_path")) | (F.size(F.split("relative_path", "/")) > depth), "skipped_path").otherwise("admitted")
    out = files.withColumn("relative_path", relative)
    return out.select("relative_path", "content", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), status.alias("status"))


def inflate(raw: bytes, limit: int) -> bytes:
    """A gzip body of ``limit`` bytes at most; one byte more is refused before it is held."""
    with gzip.GzipFile(fileobj=io.BytesIO(raw)) as f:
        out = f.read(limit + 1)
    if len(out) > limit:
        raise ValueError("longer than declared")
    return out


def gunzip(limit: int = 256 << 20):
    """Inflated bodies; null where one is no gzip, or longer than ``limit``."""

    @F.pandas_udf(T.BinaryType())
    def run(raw: pd.Series) -> pd.Series:
        def one(x):
            try:
                return None if x is None else inflate(bytes(x), limit)
            except (OSError, EOFError, ValueError):
                return None

        return raw.map(one)

    return run


@F.pandas_udf(T.StructType().add("task_id", T.StringType()).add("canonical", T.StringType()))
def strict_lines(lines: pd.Series) -> pd.DataFrame:
    rows = []
    for line in lines:
        value = parse(line)
        if not isinstance(value, dict) or not isinstance(value.get("task_id"), str) or isinstance(value["task_id"], Number):
            raise Refused("a line without a string task_id")
        rows.append((value["task_id"], canonical(value)))
    return pd.DataFrame(rows, columns=["task_id", "canonical"])


def jsonl_scan(spark: SparkSession, path: str, sha256: str | None = None) -> DataFrame:
    """``task_id, canonical`` of JSON lines, plain or gzip, in order of task_id; a digest is checked first, and a line that isn't strict fails the read."""
    if sha256 and [r["sha256"] for r in discover(spark, path).collect()] != [sha256]:
        raise ValueError("the file's digest differs")
    lines = spark.read.text(path).where("value <> ''")
    return lines.select(strict_lines("value").alias("r")).select("r.*").orderBy("task_id")


def manifest_scan(spark: SparkSession, path: str, schema: T.StructType | str, sha256: str | None = None, limit: int = 64 << 20) -> DataFrame:
    """Rows of a closed JSON control file: bounded size, bound digest; a key that the schema lacks, at any depth, is refused."""
    found = discover(spark, path).collect()
    if not found or any(r["bytes"] > limit for r in found) or (sha256 and [r["sha256"] for r in found] != [sha256]):
        raise ValueError("the control file is absent, too long or another one")
    known = spark.createDataFrame([], schema).schema
    for row in spark.read.text(path, wholetext=True).toLocalIterator():
        value = json.loads(row["value"])
        if any(_beyond(v, known) for v in (value if isinstance(value, list) else [value])):
            raise ValueError("the control file has keys that its schema lacks")
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", "true").json(path)


def _beyond(value: object, kind: T.DataType) -> bool:
    """Whether a parsed value has a key that its type lacks."""
    if isinstance(kind, T.StructType) and isinstance(value, dict):
        return bool(value.keys() - set(kind.names)) or any(_beyond(value[f.name], f.dataType) for f in kind.fields if f.name in value)
    return isinstance(kind, T.ArrayType) and isinstance(value, list) and any(_beyond(v, kind.elementType) for v in value)


def sharded_manifest_scan(index: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of ``parts`` (part, ordinal, ...) in the order that ``index`` (part, rows) states; a missing, unknown or short part fails the read, and so does one whose lines have another digest where the index has ``sha256``."""
    held = parts.groupBy("part").agg(F.count(F.lit(1)).alias("held"))
    same = F.col("rows").eqNullSafe(F.col("held"))
    if "sha256" in index.columns:
        held = sharded_manifest(parts).select("part", F.col("rows").alias("held"), F.col("sha256").alias("found"))
        same = same & F.col("sha256").eqNullSafe(F.col("found"))
    wrong = index.join(held, "part", "full_outer").where(~same)
    if not wrong.isEmpty():
        raise ValueError("parts and index differ")
    return parts.orderBy("part", "ordinal")


def stable(spark: SparkSession, path: str, before: DataFrame) -> DataFrame:
    """Files of a folder whose digest isn't the one that ``before`` (:func:`discover`) found."""
    now = discover(spark, path).select("path", F.col("sha256").alias("now"))
    return before.join(now, "path", "full_outer").where(~F.col("sha256").eqNullSafe(F.col("now"))).select("path")


def url_allowed(url: str, loopback: bool = False) -> bool:
    """Whether a transfer may go to this address: https without credentials, or plain http to this machine in tests."""
    if not url.isascii() or len(url) > 4096 or any(c <= " " or c in "\\#\x7f" for c in url):
        return False
    part = urlsplit(url)
    if not part.hostname or "@" in part.netloc:
        return False
    return part.scheme == "https" or (loopback and part.scheme == "http" and part.hostname in ("127.0.0.1", "::1"))


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args):
        return None


def fetch(url: str, limit: int, hops: int = 5, loopback: bool = False, opener=None) -> tuple[bytes, str]:
    """Body and SHA-256 of an address. Each redirect is checked like the first address; a body over ``limit`` is refused."""
    opener = opener or urllib.request.build_opener(_Stay)
    for _ in range(hops + 1):
        if not url_allowed(url, loopback):
            raise ValueError("address not allowed")
        try:
            with opener.open(url, timeout=60) as answer:
                body = answer.read(limit + 1)
            if len(body) > limit:
                raise ValueError("longer than the limit")
            return body, hashlib.sha256(body).hexdigest()
        except urllib.error.HTTPError as e:
            if e.code not in (301, 302, 303, 307, 308) or not e.headers.get("Location"):
                raise
            url = urljoin(url, e.headers["Location"])
    raise ValueError("too many redirects")


def ranked(rows: DataFrame, group: str, order: str, size: int) -> DataFrame:
    """``part`` and ``ordinal`` of each row by global ``order``, found in two levels: counts of ``group`` (a coarser monotone key), then ranks within."""
    before = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    before = before.select(group, F.coalesce(F.sum("_n").over(Window.orderBy(group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    at = F.col("_before") + F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1
    return rows.join(before, group).withColumn("_at", at).withColumns({"part": F.floor(F.col("_at") / size), "ordinal": F.col("_at") % size}).drop("_at", "_before")
