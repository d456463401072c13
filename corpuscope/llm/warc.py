"""WARC archives: an index at writing, coalesced byte ranges at reading.

``write`` puts each task's records into one file in a folder all executors share, each
record a gzip member of its own, and returns the index: file, offset, length, URL and
digest per record. The index is stored before it is used, and names only the files of
tasks that ended well: a task that runs again writes a file of its own name. ``read``
takes any rows of an index, sorts them by place and reads neighbours that are at most GAP
bytes apart in one go, RANGE bytes or one record at most.

Of records with equal payloads the one with the smallest page id is a response, the others
are revisits of it; their block keeps the HTTP head, with the length of the payload.

Cases: null html is the empty payload; a null URL is written as the page's own name; a
null page id comes after all others, a null URL before; of rows that repeat page id, URL and
payload one is the response, the others revisit it; a record is compressed in one piece,
however long; an empty table gives no files and no rows; columns besides page id, URL and
html are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpuscope.llm.common import NULL_ID, id_back, id_key, stored
from corpuscope.session import materialize_for_join, scratch_path

GAP = 64 << 10
RANGE = 8 << 20
#: Bytes of archives that a reading task fetches, about.
TASK = 32 << 20
BROADCAST_ROWS = 500_000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, page long, url string, digest string, type string"
#: Not to be written as they are in a header line.
UNSAFE = re.compile(r"[\x00-\x20\x7f<>]")


def name_of(page: int) -> str:
    return f"<urn:page:{page}>"


def target(url: str | None, page: int) -> str:
    if url is None:
        return name_of(page)[1:-1]
    return UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)


def record(page: int, url: str | None, payload: bytes, refers: int | None, refers_url) -> bytes:
    """One record, not compressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: {name_of(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target(url, page)}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers is None:
        block += payload
    else:
        head += [
            f"WARC-Refers-To: {name_of(refers)}",
            f"WARC-Refers-To-Target-URI: {target(refers_url, refers)}",
            f"WARC-Profile: {PROFILE}",
        ]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of a record, headers of its HTTP block, payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields['WARC-Record-ID']} does not end where it should")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def write(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """The stored index (INDEX) of archives written to ``folder``."""
    rows = pages.select(
        id_key("page_id").alias("page"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    key = [F.sha1("payload").alias("sha"), F.octet_length("payload").alias("octets")]
    first = F.struct((F.col("page") == NULL_ID).alias("missing"), "page", "url")
    groups = (
        rows.select("page", "url", *key)
        .where(F.col("octets") >= least_bytes)
        .groupBy("sha", "octets", "page", "url")
        .agg(F.count("*").alias("n"))
        .groupBy("sha", "octets")
        .agg(F.min(first).alias("first"), F.min_by("n", first).alias("same"), F.sum("n").alias("n"))
        .where("n > 1")
    )
    groups = materialize_for_join(groups.drop("n"), BROADCAST_ROWS)
    joined = rows.select("*", *key).join(groups, ["sha", "octets"], "left")
    is_first = F.coalesce(
        (F.col("page") == F.col("first.page")) & F.col("url").eqNullSafe(F.col("first.url")),
        F.lit(False),
    )
    several = is_first & (F.col("same") > 1)

    def settled(df: DataFrame, refers: Column) -> DataFrame:
        return df.select(
            "page", "url", "payload", refers.alias("refers"), F.col("first.url").alias("refers_url")
        )

    decided = settled(joined.where(~several), F.when(~is_first, F.col("first.page")))
    if not groups.where("same > 1").isEmpty():
        # Equal rows: one of them is taken, and written as often as it was there.
        once = joined.where(several).dropDuplicates(["sha", "octets", "page", "url"])
        copies = once.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "same")))
        decided = decided.union(
            settled(copies, F.when(F.col("copy") > 1, F.col("first.page")))
        )

    def run(batches):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            index = []
            for r in batch.to_pylist():
                if out is None:
                    system.create_dir(path)
                    out = system.open_output_stream(f"{path}/{name}", compression=None)
                data = gzip.compress(
                    record(r["page"], r["url"], r["payload"], r["refers"], r["refers_url"]), mtime=0
                )
                out.write(data)
                digest = base64.b32encode(hashlib.sha1(r["payload"]).digest()).decode()
                kind = "response" if r["refers"] is None else "revisit"
                index.append((name, at, len(data), r["page"], r["url"], digest, kind))
                at += len(data)
            if index:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), *(pa.string(),) * 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*index), kinds)],
                    names=["file", "offset", "length", "page", "url", "digest", "type"],
                )
        if out is not None:
            out.close()

    return stored(decided.mapInArrow(run, INDEX), "warc-index")


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Per selected record: page, payload_bytes, payload_digest, record_type, refers, payload."""
    inside = Window.partitionBy("file").orderBy("offset")
    before = F.lag(F.col("offset") + F.col("length")).over(inside)
    starts = before.isNull() | (F.col("offset") - before > GAP)
    far = F.floor(F.col("offset") / RANGE) != F.floor(F.lag("offset").over(inside) / RANGE)
    ranges = (
        index.select("file", "offset", "length")
        .withColumn("new", (starts | F.coalesce(far, F.lit(True))).cast("int"))
        .withColumn("range", F.sum("new").over(inside))
        .groupBy("file", "range")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records"))
    )
    # Ranges are dealt out by the bytes they stand for, not by the size of their own rows.
    total = index.agg(F.sum("length")).first()[0] or 0
    cores = index.sparkSession.sparkContext.defaultParallelism
    ranges = ranges.repartition(max(cores, -(-total // TASK)), "file", "range")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page", "payload_bytes", "payload_digest", "record_type", "refers", "payload"]

    def one(data: bytes) -> tuple:
        fields, http, payload = parsed(zlib.decompress(data, 31))
        page = lambda name: int(fields[name][len("<urn:page:") : -1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        response = fields["WARC-Type"] == "response"
        if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        return (
            page("WARC-Record-ID"),
            int(http["Content-Length"]),
            digest,
            fields["WARC-Type"],
            None if response else page("WARC-Refers-To"),
            payload if response and payloads else None,
        )

    def run(batches):
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                first = records[0]["offset"]
                with system.open_input_file(f"{path}/{name}") as file:
                    data = file.read_at(records[-1]["offset"] + records[-1]["length"] - first, first)
                view = memoryview(data)
                for at in range(0, len(records), 500):
                    rows = [
                        one(view[r["offset"] - first : r["offset"] - first + r["length"]])
                        for r in records[at : at + 500]
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                    )

    return ranges.select("file", "records").mapInArrow(
        run,
        "page long, payload_bytes long, payload_digest string, record_type string, refers long,"
        " payload binary",
    )


def report(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    folder = scratch_path(pages.sparkSession, "warc")
    index = write(pages, folder, least_bytes)
    return read(index, folder, payloads=False).select(
        id_back("page", "page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        id_back("refers", "refers_to"),
    )
