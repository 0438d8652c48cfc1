"""WARC archives with revisit resolution by payload digest.

``resolve`` deals record headers only (id, digest, length) by digest, names the original of every repeated payload, and joins
what it found to the pages by id and digest, in the one shuffle of payloads that also forms the files; ``write_archives``
writes the deduplicated archives with fresh headers: responses carry their payload, revisits refer to the original;
``read_archives`` parses each archive once, by content lengths, and joins the headers of revisits to those of their
responses.  A payload or a response that one page in HEAVY shares meets a bounded broadcast in both joins.

Archives are WARC/1.1 files of one gzip member a record, so that a record can be fetched by its offset alone; the first record of
a file is its warcinfo, and a revisit names its original's id, URI and date.  ``index`` lists every record's file, offset and
length.  Files are written by Spark's text writer, so any file system that Spark writes to will do, and a lost task is simply
run again: a member is a line without its last byte, and the line separator is that byte.  It is the highest byte of
the record's length and so 0; records of 16 MB and more get an empty member behind them, which ends in 0.
Files hold about ``FILE_BYTES`` of payloads, however large the table, since a file is read back as one value.

Defined results: a null payload is empty; payloads of fewer than ``MIN_BYTES`` bytes are always responses; of equal
payloads the one with the smallest id is the response, and rows that share that id and payload are all responses; a null id
counts as larger than any; a null URL is empty; other columns aren't archived; an empty table gives no archives and an
empty result.  Rows that repeat both id and payload come to one task.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.shared import heavy, lean, pieces, scratch, split_join, written

MIN_BYTES = 100
FILE_BYTES = 8 << 20
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
INFO = "software: lexloom\r\nformat: WARC File Format 1.1\r\n"


def _keyed(id_col: str, payload_col: str) -> list[Column]:
    """_id, _key (never null), _digest, _bytes and _body of a page."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    key = F.coalesce(F.concat(F.lit("i"), F.col(id_col).cast("string")), F.lit("n"))
    return [F.col(id_col).alias("_id"), key.alias("_key"), F.sha2(body.cast("binary"), 256).alias("_digest"), F.octet_length(body).cast("long").alias("_bytes"), body.alias("_body")]


def resolve(heads: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(_key, _digest, _original, _original_uri) of the pages that are revisits, from headers (_id, _key, _uri, _digest, _bytes)."""
    some = heads.filter(F.col("_bytes") >= min_bytes).select("_id", "_key", "_uri", "_digest")
    first = some.groupBy("_digest").agg(F.min("_id").alias("_original"), F.min(F.struct(F.col("_id").isNull(), "_id", "_uri"))["_uri"].alias("_original_uri"), F.count("*").alias("_n")).filter("_n > 1 and _original is not null").drop("_n")
    again = split_join(some.drop("_uri"), first, ["_digest"], heavy(some, "_digest"), "inner").filter("_id is null or _id > _original")
    return again.select("_key", "_digest", "_original", "_original_uri").distinct()


def _name(id_: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One column, value: a whole WARC record of each resolved page."""
    line = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[\\r\\n]", "%0A")
    revisit = F.col("_original").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("_body"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), _name(F.col("_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), line(F.col("_uri")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("_digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), _name(F.col("_original")), F.lit("\r\nWARC-Refers-To-Target-URI: "), line(F.col("_original_uri")), F.lit(f"\r\nWARC-Refers-To-Date: {DATE}\r\nWARC-Profile: {PROFILE}"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit(END),
    )
    return pages.select(F.concat(head, body, F.lit(END)).alias("value"))


def member(record: bytes) -> bytes:
    """A record as a gzip member that ends in a byte of 0 (behind a very long one, an empty member does)."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = pack.compress(record) + pack.flush()
    return out if out[-1] == 0 else out + member(b"")


def members(data: memoryview, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of every member of a file."""
    at = 0
    while at < len(data):
        end, one, parts = at, zlib.decompressobj(31), []
        while not one.eof:
            if end >= len(data):
                raise ValueError(f"the member at byte {at} is cut off")
            parts.append(one.decompress(data[end : end + step]))
            end += min(step, len(data) - end)
        end -= len(one.unused_data)
        yield at, end - at, b"".join(parts)
        at = end


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of one file -> its members, each without the last byte; a warcinfo record comes first."""
    info = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:page:info>\r\nWARC-Date: {DATE}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(INFO)}{END}{INFO}{END}".encode()
    first = True
    for batch in batches:
        for some in pieces(batch, 0):
            out = [member(v.as_buffer().to_pybytes())[:-1] for v in some.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([member(info)[:-1]] * first + out, pa.binary())], names=["value"])
            first = False


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> None:
    """The deduplicated archives of pages, as many files as FILE_BYTES asks for."""
    rows = pages.select(F.col(uri_col).cast("string").alias("_uri"), *_keyed(id_col, payload_col))
    base = scratch(pages.sparkSession, "warc-heads")
    heads = written(rows.select("_id", "_key", "_uri", "_digest", "_bytes"), f"{base}/heads")
    again = written(resolve(heads), f"{base}/revisits")
    files = max(1, -(-int(heads.agg(F.sum("_bytes") + 400 * F.count("*")).first()[0] or 0) // FILE_BYTES))
    both = rows.repartition(files, "_key", "_digest").join(again.repartition(files, "_key", "_digest"), ["_key", "_digest"], "left")
    packed = records(both).mapInArrow(lean(_members), "value binary")
    packed.select(F.col("value").cast("string")).write.option("lineSep", "\0").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-cased names) and block of every record of an uncompressed archive."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        stop = data.index(b"\r\n\r\n", at)
        head = dict(line.split(b":", 1) for line in data[at:stop].split(b"\r\n")[1:])
        fields = {k.decode().strip().lower(): v.decode().strip() for k, v in head.items()}
        end = stop + 4 + int(fields["content-length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"a record at byte {at} doesn't end where its length says")
        yield fields, data[stop + 4 : end]
        at = end + 4


def _parsed(payloads: bool):
    names = ["file", "offset", "length", "id", "type", "refers_to", "digest", "uri", "bytes", "sha256"] + ["payload"] * payloads
    types = [pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 5 + [pa.int64(), pa.string()] + [pa.binary()] * payloads
    schema = pa.schema(list(zip(names, types, strict=True)))
    urn = lambda x: x.removeprefix("<urn:page:").removesuffix(">") if x is not None else None

    def row(h: dict[str, str], body: bytes) -> tuple:
        return (urn(h["warc-record-id"]), h["warc-type"], urn(h.get("warc-refers-to")), h["warc-payload-digest"].split(":")[-1], h.get("warc-target-uri"), len(body), hashlib.sha256(body).hexdigest(), body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                found = ((file.as_py(), at, n, *row(h, body)) for at, n, data in members(memoryview(content.as_buffer())) for h, body in parse(data) if h["warc-type"] != "warcinfo")
                while rows := list(itertools.islice(found, 512)):
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], schema=schema)

    return run


def _read(spark: SparkSession, path: str, payloads: bool) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    kinds = "file string, offset long, length long, id string, type string, refers_to string, digest string, uri string, bytes long, sha256 string" + ", payload binary" * payloads
    return files.mapInArrow(_parsed(payloads), kinds)


def index(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, length, id, type, digest and uri of every record of the archives under path."""
    return _read(spark, path, False).select("file", "offset", "length", "id", "type", "digest", "uri")


def fetch(spark: SparkSession, file: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, of which alone the bytes are read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        stream.seek(offset)
        raw = bytes(stream.readNBytes(length))
    finally:
        stream.close()
    return next(parse(next(members(memoryview(raw)))[2]))


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all archives under path: id, type, refers_to, digest, uri, and of the payload (a revisit's is its original's)
    bytes and sha256, and payload itself if asked for."""
    more = ["bytes", "sha256"] + ["payload"] * payloads
    got = written(_read(spark, path, payloads).drop("file", "offset", "length"), f"{scratch(spark, 'warc-read')}/records")
    revisits = got.filter("type = 'revisit'").drop(*more)
    wanted = revisits.select("refers_to", "digest").distinct()
    mine = got.filter("type = 'response'").select(F.col("id").alias("refers_to"), "digest", *more)
    originals = mine.join(wanted, ["refers_to", "digest"], "left_semi").groupBy("refers_to", "digest").agg(*(F.first(c).alias(c) for c in more))
    found = split_join(revisits, originals, ["refers_to", "digest"], heavy(revisits, "refers_to", "digest"))
    return got.filter("type <> 'revisit'").unionByName(found).select("id", "type", "refers_to", "digest", "uri", *more)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark, 'warc')}/archives"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    got = read_archives(spark, path, payloads=False)
    return got.select(
        F.when(F.col("id") != "", F.col("id")).cast("long").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("sha256").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"),
    )


SQL = {
    "op6_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT payload_digest AS g, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN f ON payload_digest = g AND payload_bytes >= 100""",
}
QUERIES = {"op6_warc": op6_warc}
