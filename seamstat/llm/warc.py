"""Web archives: write records, normalise monolithic gzip files, read back.

``write_monolithic`` lands WARC records through Spark's text sink with gzip,
so a whole file is one gzip stream (nothing in it can be read without
inflating all that stands before). ``normalise`` inflates each file once, as a
stream, rewrites every record as a gzip member of its own and writes a sidecar
index of offsets. ``read_archives`` seeks to the members by that index.

A task holds one record at a time. Files are written under a temporary name
and renamed, so a task that is run again leaves the same files. Paths are
opened with ``pyarrow.fs`` by their URI.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import for_workers, free_name, landed, read_table, shared_path

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 20_000
LEVEL = 6
CHUNK = 1 << 20

# FIXED VALUES of the archive format.
VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

INDEX_SCHEMA = "archive string, index string, records long, bytes long"
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long, payload binary")


def with_revisits(pages: DataFrame, id: str = "page_id", payload: str = "html",
                  min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``pages`` with ``payload_bytes``, ``payload_digest``, ``record_type``
    and ``refers_to``.

    Of the records with equal payloads of at least ``min_bytes`` the smallest
    id is the response. The group sizes come from a partial aggregate over
    (digest, id) alone; the payload itself is only joined by id and digest,
    which spreads a page with very many copies evenly.
    """
    # Input columns with the names of the added ones go.
    names = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    keep = [c for c in pages.columns if c.lower() not in names]
    raw = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    df = pages.select(*[F.col(f"`{c}`") for c in keep], F.octet_length(raw).cast("long").alias("payload_bytes"),
                      F.sha2(raw, 256).alias("payload_digest"))
    key = F.struct(F.col(f"`{id}`").isNull().alias("n"), F.coalesce(F.col(f"`{id}`"), F.lit(0)).alias("i"))
    k_id = free_name(df.columns, "warc_key")
    df = df.withColumn(k_id, key)
    thin = df.where(F.col("payload_bytes") >= min_bytes).select(
        F.col(f"`{id}`").alias("r_id"), F.col(k_id).alias("r_key"), F.col("payload_digest").alias("r_digest"))
    first = (thin.groupBy("r_digest").agg(F.min("r_id").alias("r_first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(F.col("r_digest").alias("f_digest"), "r_first"))
    # Landed, so that Spark knows its real size: where it is small, the
    # payloads are joined where they lie and are not shuffled.
    revisits = landed(
        thin.join(first, F.col("r_digest") == F.col("f_digest"))
        .where((F.col("r_id") > F.col("r_first")) | F.col("r_id").isNull() & F.col("r_first").isNotNull())
        .select("r_key", "r_digest", "r_first").distinct(), "revisits")
    names = {x: free_name(df.columns, x) for x in revisits.columns}
    revisits = revisits.withColumnsRenamed(names)
    return (df.join(revisits, (F.col(k_id) == F.col(names["r_key"])) & (F.col("payload_digest") == F.col(names["r_digest"])), "left")
            .withColumn("record_type", F.when(F.col(names["r_first"]).isNull(), "response").otherwise("revisit"))
            .withColumnRenamed(names["r_first"], "refers_to").drop(k_id, names["r_key"], names["r_digest"]))


def record_text(id: str = "page_id", url: str = "url", payload: str = "html") -> F.Column:
    """One whole record as a string, from the columns of ``with_revisits``."""
    def urn(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    # Control characters and spaces cannot stand in a header line.
    target = F.regexp_replace(F.col(f"`{url}`"), r"[\x00-\x20\x7F]", "%20")
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col(f"`{id}`")),
        F.lit(f"\r\nWARC-Date: {DATE}"),
        F.when(F.col(f"`{url}`").isNull(), "").otherwise(F.concat(F.lit("\r\nWARC-Target-URI: "), target)),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
                                 urn(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        length.cast("string"), F.lit(END), http,
        F.when(revisit, "").otherwise(body), F.lit(END))


def write_monolithic(pages: DataFrame, path: str, id: str = "page_id", url: str = "url",
                     payload: str = "html", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write one record per page; each file is a single gzip stream."""
    record = record_text(id, url, payload)
    # The sink ends each value with the line feed that ends the record.
    line = with_revisits(pages, id, payload).select(record.alias("r")).select(
        F.expr("substring(r, 1, char_length(r) - 1)").alias("value"))
    (line.write.mode("error").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path))


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path) if ":" in path else f"file://{path}")


def inflated(stream):
    """The bytes of a gzip stream (of one or more members), chunk by chunk."""
    import zlib

    z, pending = zlib.decompressobj(31), b""
    while True:
        data = pending or stream.read(CHUNK)
        if not data:
            if not z.eof:
                raise ValueError("the gzip stream is cut off")
            return
        if z.eof:
            z = zlib.decompressobj(31)
        out = z.decompress(data, 4 * CHUNK)
        pending = z.unused_data if z.eof else z.unconsumed_tail
        if out:
            yield bytes(out)


def split_records(chunks):
    """Whole records (head, block and end mark) of inflated chunks."""
    buf, it = bytearray(), iter(chunks)

    def more() -> bool:
        nxt = next(it, None)
        if nxt is not None:
            buf.extend(nxt)
        return nxt is not None

    while True:
        seen = 0
        while (head := buf.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buf)
            if not more():
                if buf:
                    raise ValueError("a record head is cut off")
                return
        size = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", buf[:head].replace(b"\r", b""))
        if not buf.startswith(b"WARC/") or not size:
            raise ValueError("this is not a record head")
        whole = head + 4 + int(size[1]) + 4
        while len(buf) < whole:
            if not more():
                raise ValueError("a record is cut off")
        if buf[whole - 4:whole] != b"\r\n\r\n":
            raise ValueError("a record does not end with its end mark")
        yield bytes(buf[:whole])
        del buf[:whole]


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, rest[:-4]


def normalise(spark: SparkSession, source: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrite every gzip file below ``source`` as one member per record in
    ``target``, each with a sidecar index (``offset length record-id`` lines).
    Returns one row per file; the work is done when the result is computed."""
    for_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    slices = max(1, spark.sparkContext.defaultParallelism)

    def rewrite(batches):
        import uuid
        import zlib

        import pyarrow as pa

        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs_in, p_in = _open(path)
                fs_out, root = _open(target)
                fs_out.create_dir(root)
                name = re.sub(r"(\.txt)?\.gz$", "", p_in.rsplit("/", 1)[-1])
                archive, index = f"{root}/{name}.warc.gz", f"{root}/{name}.idx"
                tmp, n, at = f"{root}/_{uuid.uuid4().hex}", 0, 0
                with fs_in.open_input_stream(p_in, compression=None) as src, \
                        fs_out.open_output_stream(f"{tmp}.a", compression=None) as out, \
                        fs_out.open_output_stream(f"{tmp}.i", compression=None) as idx:
                    for record in split_records(inflated(src)):
                        z = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = z.compress(record) + z.flush()
                        out.write(member)
                        rid = re.search(rb"(?im)^warc-record-id:\s*(\S+)", record[:4096])
                        idx.write(b"%d %d %s\n" % (at, len(member), rid[1] if rid else b"-"))
                        n, at = n + 1, at + len(member)
                fs_out.move(f"{tmp}.a", archive)
                fs_out.move(f"{tmp}.i", index)
                yield pa.RecordBatch.from_pydict({"archive": [archive], "index": [index], "records": [n], "bytes": [at]})

    return files.repartition(slices * 4, "path").mapInArrow(rewrite, INDEX_SCHEMA)


def read_archives(spark: SparkSession, target: str, with_payload: bool = True) -> DataFrame:
    """Records of normalised archives, by their sidecar indexes.

    A response's digest and size are computed from its payload and held
    against its header; a revisit has those of the full payload in its
    headers. A damaged record raises an error.
    """
    for_workers(spark)
    lines = (spark.read.option("pathGlobFilter", "*.idx").text(target)
             .select(F.col("_metadata.file_path").alias("index"), "value"))

    def records(batches):
        import hashlib
        import zlib

        import pyarrow as pa

        names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        now, f = None, None
        for batch in batches:
            rows, held = [], 0
            for index, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if index != now:
                    if f:
                        f.close()
                    fs, p = _open(index)
                    f, now = fs.open_input_file(p[:-len("idx")] + "warc.gz"), index
                offset, length = map(int, line.split(" ")[:2])
                f.seek(offset)
                head, block = parse_record(zlib.decompress(f.read(length), 31))
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                if head["warc-type"] == "response" and (
                        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"{index}: the record at {offset} is damaged")
                ids = [re.fullmatch(r"<urn:page:(null|-?\d+)>", x) for x in (head["warc-record-id"], head.get("warc-refers-to", ""))]
                page, refers = (int(m[1]) if m and m[1] != "null" else None for m in ids)
                rows.append((page, head.get("warc-target-uri"), size, digest, head["warc-type"], refers,
                             payload if with_payload and head["warc-type"] == "response" else None))
                held += len(payload)
                if held > 16 * CHUNK or len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
        if f:
            f.close()

    return lines.mapInArrow(records, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write, normalise and read back; returns the records.

    A null payload is an empty one, a null url has no target header, a null
    id is the record ``null``. Repeated rows are repeated records; rows with
    the smallest id of a payload are all responses. Extra columns are not
    archived. An empty table gives no records.
    """
    spark = pages.sparkSession
    raw, target = shared_path(spark, "warc-raw"), shared_path(spark, "warc")
    write_monolithic(pages.select(*[F.col(f"`{c}`") for c in (id, url, payload)]), raw, id, url, payload)
    files = normalise(spark, raw, target)
    if files.agg(F.sum("records")).first()[0] is None:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return read_archives(spark, target)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    records = archive_pages(read_table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM r
"""
