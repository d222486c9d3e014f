"""WARC archives with an index written first.

Each task appends its records (one gzip member each) to archive files of its
own in shared storage and returns an index row per record: file, offset, length,
URL and digest.  A reader selects rows of the index, sorts them by place,
joins ranges that lie close together into one read, and cuts the records out.

A file's name holds the task attempt, and the index is written through Spark's
committer, so it names only files of attempts that succeeded: a lost executor or
a second attempt leaves a file that nothing points to.

Equal payloads are stored once: the record with the smallest page_id is the
response and the others are revisit records that refer to it.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.common import written
from meterwise.session import scratch_path

#: Payloads shorter than this are never revisits.
LEAST_BYTES = 100
#: A new archive file begins after so many bytes.
FILE_BYTES = 1 << 30
#: Ranges with at most this gap are read together, up to so many bytes.
GAP_BYTES, READ_BYTES = 1 << 16, 1 << 22
#: Archive bytes that a reading task gets: index rows are spread over tasks by stretches of a quarter of that.
TASK_BYTES = 1 << 24

INDEX = "file string, offset long, length long, url string, digest string, page_id string, record_type string"
RECORD = ("page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, "
          "payload binary")


def _line(value: str) -> str:
    """A value that fits a header line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record(page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One record, compressed; a revisit keeps the digest and length of its payload but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{_line(page_id)}>",
            f"WARC-Date: {date}", f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[5:5] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{_line(refers_to)}>"]
    return gzip.compress("\r\n".join([*head, "", ""]).encode() + block + b"\r\n\r\n", 6, mtime=0)


def parse(raw: bytes) -> tuple:
    """The fields of RECORD; fails if a response's payload doesn't have its digest."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: payload and digest differ")

    def page(value: str | None) -> str | None:
        return _unline(value.removeprefix("<urn:page:").removesuffix(">")) if value else None

    return (page(fields["WARC-Record-ID"]) or None, _unline(fields["WARC-Target-URI"]), kind, page(fields.get("WARC-Refers-To")),
            size, digest, payload if kind == "response" else None)


def write_archives(pages: DataFrame, folder: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html",
                   least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row under ``folder`` (shared storage; default: the scratch folder) and return the index.

    A null html or url is empty.  Rows that repeat the smallest page_id of their
    payload are all responses; a row without a page_id is a revisit if another
    row with its payload has one, else a response.  The list of repeated
    payloads is joined by its measured size, so that pages are shuffled only if
    it is too large to broadcast.
    """
    from pyarrow.fs import FileSystem

    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    system, root = FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    rows = pages.select(F.col(page_id).alias("_id"), F.coalesce(F.col(url), F.lit("")).alias("_url"),
                        F.coalesce(F.col(html), F.lit("")).alias("_html")).withColumn("_digest", F.sha2("_html", 256))
    firsts = written(rows.where(F.octet_length("_html") >= least_bytes).groupBy("_digest")
                     .agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null")
                     .select("_digest", "_first"), "repeated")
    decided = (rows.join(firsts, "_digest", "left")
               .select(F.coalesce(F.col("_id").cast("string"), F.lit("")).alias("_id"), "_url", "_html", "_digest",
                       F.when(~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first").cast("string")).alias("_refers")))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = FileSystem.from_uri(folder)
        task = TaskContext.get()
        stem = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        out, name, at, number = None, "", 0, 0
        for batch in batches:
            index = []
            for key, link, text, digest, refers in batch.itertuples(index=False):
                raw = record(key, link, text.encode("utf-8", "surrogatepass"), digest, None if pd.isna(refers) else refers, date)
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at, number = f"{stem}-{number:04d}.warc.gz", 0, number + 1
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                out.write(raw)
                index.append((f"{folder}/{name}", at, len(raw), link, digest, key, "response" if pd.isna(refers) else "revisit"))
                at += len(raw)
            yield pd.DataFrame(index, columns=[c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()

    return written(decided.mapInPandas(write, INDEX), "warc_index")


def read_ranges(wanted: Iterator[pd.DataFrame], with_payload: bool, gap: int = GAP_BYTES, most: int = READ_BYTES) -> Iterator[pd.DataFrame]:
    """Records at index rows sorted by file and offset; ranges that lie close together are read at once."""
    from pyarrow.fs import FileSystem

    opened: tuple[str, object] = ("", None)
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in wanted:
        offset, end = batch["offset"].to_numpy(), (batch["offset"] + batch["length"]).to_numpy()
        file = batch["file"].to_numpy()
        i = 0
        while i < len(batch):
            j, last = i + 1, end[i]
            while j < len(batch) and file[j] == file[i] and offset[j] - last <= gap and end[j] - offset[i] <= most:
                last = max(last, end[j])
                j += 1
            if opened[0] != file[i]:
                if opened[1] is not None:
                    opened[1].close()
                store, path = FileSystem.from_uri(file[i])
                opened = (file[i], store.open_input_file(path))
            opened[1].seek(int(offset[i]))
            data = opened[1].read(int(last - offset[i]))
            found = [parse(data[offset[k] - offset[i]:end[k] - offset[i]]) for k in range(i, j)]
            yield pd.DataFrame([f if with_payload else (*f[:-1], None) for f in found], columns=names)
            i = j
    if opened[1] is not None:
        opened[1].close()


def read_records(index: DataFrame, with_payload: bool = True, gap: int = GAP_BYTES, most: int = READ_BYTES,
                 task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records that ``index`` (all rows or a selection) points to; see RECORD for the columns.

    Tasks are as many as the bytes to be read ask for (the index itself is small
    and says nothing of them).  A stretch of a file is one task's, read in order of
    offset; the payload of a revisit is null (join with the response it refers to).
    An empty selection gives no rows; a row that repeats is read again.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    places = (index.select("file", "offset", "length")
              .repartition(1 + size // task_bytes, "file", F.floor(F.col("offset") / F.lit(task_bytes // 4)))
              .sortWithinPartitions("file", "offset"))
    found = places.mapInPandas(lambda batches: read_ranges(batches, with_payload, gap, most), RECORD)
    return found.withColumn("page_id", F.nullif("page_id", F.lit("")))
