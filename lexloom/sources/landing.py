"""Landed files: the approval gate, ordered skip reasons, manifests and their integrity, registration by content."""

from __future__ import annotations

import hashlib
import json
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.functions import ids


def gate(sources: DataFrame, system: str) -> DataFrame:
    """Sources of one connector, with approved as a boolean."""
    return sources.filter(F.col("connector") == system).withColumn("approved", F.coalesce(F.col("status") == "approved", F.lit(False)))


#: Rows that a register (sources, law names) may have to be sent to every task.
REGISTER = 100_000


def register(rows: DataFrame, what: str) -> DataFrame:
    """rows for a broadcast, once their number is checked."""
    if rows.limit(REGISTER + 1).count() > REGISTER:
        raise ValueError(f"the register of {what} has more than {REGISTER} rows")
    return F.broadcast(rows)


def longest_prefix(files: DataFrame, sources: DataFrame, path: str = "path", prefix: str = "repo_path") -> DataFrame:
    """Each file with the source of the longest prefix of its path, or NULLs; repeated files stay.

    A path is cut at each length that a prefix has, so files meet the register by equality, longest first.
    """
    named = sources.dropDuplicates([prefix])
    lengths = sorted((r[0] for r in register(sources.select(F.char_length(prefix).alias("n")).distinct(), "prefix lengths").collect() if r[0] is not None), reverse=True)
    cuts = F.array(*(F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in lengths)) if lengths else F.array().cast("array<string>")
    known = register(named.select(F.col(prefix).alias("_p")), "sources").agg(F.collect_set("_p").alias("_all"))
    found = F.get(F.filter(cuts, lambda c: c.isNotNull() & F.array_contains("_all", c)), F.lit(0))
    cut = files.join(F.broadcast(known)).withColumn("_cut", found).drop("_all")  # the register is one row
    return cut.join(register(named, "sources"), F.col("_cut") == F.col(prefix), "left").drop("_cut")


def skip_reason(path: Column, registered: Column, approved: Column, size: Column, known: Column, extensions: tuple[str, ...], max_bytes: int) -> Column:
    """The first reason that holds, or 'take'."""
    name = F.element_at(F.split(path, "/"), -1)
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    return (
        F.when(name.startswith(".") | (F.lower(name) == "readme.md"), "housekeeping")
        .when(~registered, "unregistered_path")
        .when(~F.coalesce(approved, F.lit(False)), "source_not_approved")
        .when(~suffix.isin(*extensions), "extension_not_allowed")
        .when(size > max_bytes, "too_large")
        .when(F.coalesce(known, F.lit(False)), "unchanged")
        .otherwise("take")
    )


def first_wins(rows: DataFrame, known: DataFrame, key: str, *order: Column) -> DataFrame:
    """rows with reason: 'loaded' for the first of each new key, else 'duplicate_content'."""
    old = known.select(F.col(key).alias("_known")).distinct()
    w = Window.partitionBy(key).orderBy(*order)
    both = rows.join(old, rows[key] == old["_known"], "left").withColumn("_rn", F.row_number().over(w))
    return both.withColumn("reason", F.when(F.col("_known").isNull() & (F.col("_rn") == 1), "loaded").otherwise("duplicate_content")).drop("_known", "_rn")


def landing_path(system: str, source_id: str, doc_id: str, file_name: str) -> str:
    """Where a file lies below the landing root."""
    return f"{system}/{source_id}/{doc_id[:12]}/{file_name}"


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A file on any file system that Spark reaches; an old one is replaced."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_batch(out: str, connector: str, load_id: str, files: list[dict], api_calls: list[dict] | None = None, skipped: dict | None = None, commit: str | None = None, spark: SparkSession | None = None) -> Path | str:
    """Files of a batch, and its manifest last: a batch without one doesn't count.  For the machine at the edge, or with a
    session for any file system that Spark reaches."""
    now = datetime.now(UTC)
    folder = f"{out.rstrip('/')}/incoming/{connector}/{now.strftime('%Y-%m-%d')}/{load_id}"
    if spark is None:
        Path(folder).mkdir(parents=True)
    put = (lambda name, content: Path(folder, name).write_bytes(content)) if spark is None else (lambda name, content: write_bytes(spark, f"{folder}/{name}", content))
    listed = []
    for f in files:
        put(f["file_name"], f["content"])
        listed.append({k: v for k, v in f.items() if k != "content"} | {"sha256": hashlib.sha256(f["content"]).hexdigest(), "size_bytes": len(f["content"])})
    body = {"manifest_version": 1, "load_id": load_id, "connector": connector, "fetched_at": now.isoformat(), "git_commit": commit, "files": listed, "skipped": skipped or {}, "api_calls": api_calls or []}
    put("_manifest.json", json.dumps(body, default=str).encode())
    return Path(folder) if spark is None else folder


MANIFEST = "manifest_version int, load_id string, connector string, fetched_at string, files array<struct<source_id:string,file_name:string,sha256:string,size_bytes:bigint,source_ref:string,source_url:string,source_version:string>>, api_calls array<struct<call_id:string,method:string,endpoint:string,status_code:int,attempt:int,latency_ms:int,response_bytes:bigint,rate_limit_remaining:int,error_type:string,called_at:string>>"


def pending(spark: SparkSession, root: str, connector: str, mark: str | None) -> DataFrame:
    """Manifests after the mark, with their folder, oldest first.

    Spark's readers pass over names that start with an underscore, so the driver reads these control files, one small
    file a batch, by Hadoop's file system; folders of days before the mark's aren't opened.
    """
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/incoming/{connector}/*/*/_manifest.json")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = []
    for status in fs.globStatus(p) or []:
        folder = status.getPath().getParent()
        if mark and folder.getParent().getName() < mark[:10]:
            continue
        stream = fs.open(status.getPath())
        rows.append((str(folder), bytes(stream.readAllBytes()).decode()))
        stream.close()
    df = spark.createDataFrame(rows, "folder string, body string").select("folder", F.from_json("body", MANIFEST).alias("m")).select("folder", "m.*")
    return (df.filter(F.col("fetched_at") > mark) if mark else df).orderBy("fetched_at")


def plain(path: Column) -> Column:
    """A path without its scheme."""
    return F.regexp_replace(path, "^[a-z][a-z0-9+.-]*:/+", "/")


def checked(listed: DataFrame, content: Column, declared: str = "sha256") -> DataFrame:
    """Listed files with the hash of what was found (doc_id, NULL if nothing was) and whether it is the declared one."""
    return listed.withColumn("doc_id", F.when(content.isNotNull(), ids.content_hash(content))).withColumn("intact", F.coalesce(F.col("doc_id") == F.col(declared), F.lit(False)))


def verified(spark: SparkSession, manifests: DataFrame, root: str, connector: str) -> DataFrame:
    """Files of the manifests, with their place in the manifest (position), content, hash and whether it is the declared one."""
    listed = manifests.select("load_id", "fetched_at", "folder", F.posexplode("files").alias("position", "f")).select("load_id", "fetched_at", "position", F.concat_ws("/", "folder", "f.file_name").alias("path"), "f.*")
    found = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").load(f"{root}/incoming/{connector}/*/*/*").select(F.col("path").alias("_path"), "content")
    both = listed.join(found, plain(F.col("path")) == plain(F.col("_path")), "left").drop("_path")
    return checked(both, F.col("content"))
