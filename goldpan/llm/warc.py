"""WARC archives: monolithic gzip files in, one gzip member per record and a sidecar offset index out.

A writer that compresses a file as one stream gives archives that can only be read from their start. The normaliser inflates such a stream once, record by
record, compresses every record as a member of its own and notes where each begins.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import checked, shared_path, stored

#: Smallest payload that is stored once for all records that share it.
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes to an archive file, about.
ARCHIVE_BYTES = 8 << 20
#: Archive bytes to a task that reads them back, about, and most such tasks.
READ_BYTES, READ_TASKS = 16 << 20, 50_000
_CHUNK = 1 << 16


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """One text column ``value``: a record per page, complete but for the blank lines that end it.

    Null payloads are empty and null addresses are left out. Among equal payloads of at least ``least`` bytes, the record with the largest id is the response, as are
    rows that repeat that id; the others revisit it. Records without an id revisit a response that has one, and are responses if none has.
    """
    page = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    page = page.withColumns({"sha": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    # digests only: the copies of a payload meet as one row per task
    large = page.where(F.col("size") >= least).groupBy("sha").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    large = checked(stored(large, "payloads"))
    page = page.join(large, "sha", "left").withColumn("revisit", F.coalesce(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))
    address = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    clean = F.regexp_replace("url", r"[\r\n]+", " ")
    size = F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    value = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", address(F.col("id"))), line("WARC-Target-URI", clean), F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha"))), F.when(F.col("revisit"), f"WARC-Profile: {PROFILE}\r\n").otherwise(""),
        F.when(F.col("revisit"), line("WARC-Refers-To", address(F.col("first")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"), http,
        F.when(F.col("revisit"), "").otherwise(F.col("html")),
    )
    return page.select(value.alias("value"))


def write_monolithic(found: DataFrame, path: str, records_per_file: int) -> None:
    """Write records as archives of so many at most, each compressed as one stream. Every task writes what it reads, so no page is shuffled."""
    found.write.option("compression", "gzip").option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records_per_file).text(path)


def split_stream(data) -> "list[tuple[bytes, dict[str, str]]]":
    """Records of a gzip stream (bytes or an open file), one after the other, with their headers. Reads and inflates once, chunk by chunk."""
    inflate, buffer, rest = zlib.decompressobj(31), bytearray(), b""
    read = data.read if hasattr(data, "read") else io.BytesIO(data).read

    def more() -> bool:
        nonlocal inflate, rest
        chunk = rest or read(_CHUNK)
        if not chunk:
            return False
        if inflate.eof:  # a further member
            inflate = zlib.decompressobj(31)
        buffer.extend(inflate.decompress(chunk))
        rest = inflate.unused_data
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if buffer.strip():
                raise ValueError("the archive ends inside the header of a record")
            return
        lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = end + 4 + int(headers["content-length"]) + 4
        while len(buffer) < size and more():
            pass
        if len(buffer) < size - 4:
            raise ValueError("the archive ends inside a record")
        yield bytes(buffer[:size]), headers
        del buffer[:size]


def normalise(spark: SparkSession, source: str, target: str, level: int = 4) -> DataFrame:
    """Rewrite every archive in the folder ``source`` into ``target``, one member per record; the index is (archive, at, length, record_type).

    Spark lists the archives; their tasks read them as streams, so an archive may be of any size, and a task holds one record. Each task writes a file under another name and then renames it, so a task that runs again leaves one whole file. Archives
    are named after their sources. The file systems are those that ``source`` and ``target`` name. An empty folder gives an empty index; repeated
    records stay as they are.
    """

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for path in batch.column(0):
                file = path.as_py().rsplit("/", 1)[-1]
                name = file.removesuffix(".gz").removesuffix(".txt") + ".warc.gz"
                store, root = fs.FileSystem.from_uri(target)
                store.create_dir(root, recursive=True)
                at, rows, draft = 0, [], f"{root}/_{name}.{uuid.uuid4().hex}"
                own, folder = fs.FileSystem.from_uri(source)
                with store.open_output_stream(draft, compression=None) as out, own.open_input_stream(f"{folder}/{file}", compression=None) as content:
                    for record, headers in split_stream(content):
                        member = gzip.compress(record, level, mtime=0)
                        out.write(member)
                        rows.append((at, len(member), headers.get("warc-type")))
                        at += len(member)
                store.move(draft, f"{root}/{name}")
                places, lengths, kinds = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(rows), pa.string()), pa.array(places, pa.int64()), pa.array(lengths, pa.int64()), pa.array(kinds, pa.string())],
                    ["archive", "at", "length", "record_type"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    return files.mapInArrow(run, "archive string, at long, length long, record_type string")


def read_members(folder: str, index: DataFrame) -> DataFrame:
    """Records of normalised archives by their places in the index, each read and inflated alone: headers (map of lower-case names) and block.

    The index is small, so the number of tasks follows from the bytes that it points to. An empty index gives no rows; a place that it holds twice is read twice.
    """
    archives, size = index.agg(F.count_distinct("archive"), F.coalesce(F.sum("length"), F.lit(0))).first()
    wanted = max(index.sparkSession.sparkContext.defaultParallelism, size // READ_BYTES)
    places = index.repartition(max(1, min(archives, wanted, READ_TASKS)), "archive").groupBy("archive").agg(F.sort_array(F.collect_list(F.struct("at", "length"))).alias("places"))

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for archive, found in zip(batch.column(0), batch.column(1)):
                heads, blocks, held = [], [], 0
                with store.open_input_file(f"{root}/{archive.as_py()}") as file:
                    for place in found.as_py():
                        record = zlib.decompress(file.read_at(place["length"], place["at"]), 31)
                        head, _, block = record.partition(b"\r\n\r\n")
                        lines = head.decode("utf-8", "replace").split("\r\n")[1:]
                        heads.append([(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines)])
                        blocks.append(block[:-4])
                        held += len(block)
                        if held > 16 << 20:
                            yield members(heads, blocks)
                            heads, blocks, held = [], [], 0
                yield members(heads, blocks)

    def members(heads: list, blocks: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary())], ["headers", "block"])

    return places.mapInArrow(run, "headers map<string,string>, block binary")


def digests(found: DataFrame, id_type: str = "long") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of read records.

    The size and digest of a response are those of its payload as read; a revisit has them in its headers.
    """
    header = lambda name: F.try_element_at("headers", F.lit(name))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(.*)>$", 1).cast(id_type)
    kind: Column = header("warc-type")
    start = F.instr(F.col("block").cast("string"), "\r\n\r\n")
    http = F.substring(F.col("block"), F.lit(1), start + 3).cast("string")
    told = F.regexp_extract(http, r"(?i)content-length: *(\d+)", 1).cast("long")
    # the head of a block is plain ASCII, so its characters count as bytes
    payload = F.substring(F.col("block"), start + 4, F.greatest(F.octet_length("block") - start - 3, F.lit(0)))
    revisit = kind == "revisit"
    return found.select(
        F.when(header("warc-record-id").isNotNull(), number(header("warc-record-id"))).alias("page_id"),
        F.when(revisit, told).otherwise(F.octet_length(payload).cast("long")).alias("payload_bytes"),
        F.when(revisit, F.substring_index(header("warc-payload-digest"), ":", -1)).otherwise(F.sha1(payload)).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(revisit, number(header("warc-refers-to"))).alias("refers_to"),
    )


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write pages as monolithic archives, normalise those, and read all records back through the index."""
    spark = pages.sparkSession
    raw, target, sidecar = (shared_path(spark, f"warc-{x}") for x in ("raw", "members", "index"))
    mean = pages.agg(F.avg(F.octet_length(payload_col))).first()[0] or 0
    write_monolithic(records(pages, id_col, url_col, payload_col), raw, max(1, int(ARCHIVE_BYTES / max(mean, 1))))
    normalise(spark, raw, target).write.parquet(sidecar)
    index = spark.read.schema("archive string, at long, length long, record_type string").parquet(sidecar)
    return digests(read_members(target, index), pages.schema[id_col].dataType.simpleString())
