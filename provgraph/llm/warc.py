"""WARC archives: written with an index, read back by coalesced byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, ship
from provgraph.plans.publish import work_root

#: Bytes that an archive holds at most before the next one is opened, but for its last record.
ARCHIVE_BYTES = 256 << 20
#: Ranges closer than this are read at once, up to so many bytes.
GAP, SPAN = 64 << 10, 8 << 20

_INDEX = "archive string, offset long, length long, id string, url string, digest string, record_type string"


def record_id(page_id: int | None) -> str:
    """A record's id is made of the page's; a null one has none."""
    return "" if page_id is None else f"<urn:uuid:{uuid.UUID(int=page_id & (2**64 - 1))}>"


def page_of(value: str | None) -> int | None:
    if not value:
        return None
    n = uuid.UUID(value.strip("<>")[len("urn:uuid:") :]).int
    return n - 2**64 if n >= 2**63 else n


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _escaped(value: str) -> str:
    """A header value on one line."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unescaped(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def to_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One gzip member with a WARC/1.1 record; a revisit has the payload's digest and length, but no payload."""
    body = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
        *([("WARC-Target-URI", _escaped(url))] if url is not None else []),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"), ("WARC-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode() + body + b"\r\n\r\n", 6, mtime=0)


def from_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, payload) of one gzip member."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(x.split(": ", 1) for x in lines)
    body = rest[: int(fields["Content-Length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its content")
    return fields, body


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record per row into archives below ``folder``; return their index.

    The index (archive, offset, length, id, url, digest, record_type) is a
    table in the shared work folder with one row per record; its rows name
    only archives that their task completed, under names of their own, so
    that a repeated task leaves no record twice in the index.

    Of records with equal payloads the one with the largest id is a response,
    the others are revisits that refer to it; rows that repeat that id and
    payload are all responses, and so are those of a group of null ids only.
    Null payloads are empty, and empty payloads equal each other; null URLs
    have no URI field; nulls in the id give a record without an id.  Extra
    columns are not read; an empty table gives an empty index.

    Equal payloads are found by SHA-1 of the payload, grouped with map-side
    combination, so a payload with a third of all rows is one narrow row per
    task; only the largest id returns to the rows (split by the skew join).
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    folder = folder or f"{work_root(spark)}/warc-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url"), payload.alias("_payload"), F.sha1(payload).alias("_sha"))
    keepers = scratch.save(rows.groupBy("_sha").agg(F.max("_id").alias("_keeper"), F.count("*").alias("_n")))
    shared = keepers.where("_n > 1").select("_sha", "_keeper")
    dealt = rows.join(shared, "_sha", "left")
    revisit = F.col("_keeper").isNotNull() & ~F.col("_id").eqNullSafe(F.col("_keeper"))
    dealt = dealt.select("_id", "_url", "_payload", "_keeper", revisit.alias("_revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for b in batches:
            rows: list[tuple] = []
            for i, url, body, keeper, again in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                record = to_record(i, url, body, keeper, again)
                out.write(record)
                rows.append((name, at, len(record), record_id(i), url, digest_of(body), "revisit" if again else "response"))
                at += len(record)
            cols = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in _INDEX.split(", ")])
        if out is not None:
            out.close()

    index = scratch.save(dealt.mapInArrow(run, _INDEX))
    scratch.drop(keepers)
    return index.withColumn("archive", F.concat(F.lit(folder + "/"), "archive"))


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def ranges(rows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted (offset, length) pairs, neighbours within ``GAP`` joined while a range stays within ``SPAN``."""
    out: list[tuple[int, int]] = []
    for at, n in rows:
        if out and at - (out[-1][0] + out[-1][1]) <= GAP and at + n - out[-1][0] <= SPAN:
            out[-1] = (out[-1][0], max(out[-1][1], at + n - out[-1][0]))
        else:
            out.append((at, n))
    return out


_READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(selected: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of the index rows given.

    The rows are dealt by ranges of archive and offset; each task sorts its
    own, joins neighbouring ones to byte ranges and reads these.  Payloads
    are checked against their digest and length; a revisit has none (null)
    and states those of the record it refers to.
    """
    ship(selected.sparkSession)
    n = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = selected.select("archive", "offset", "length").repartitionByRange(n, "archive", "offset").sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(*(b.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True))
            by: dict[str, list[tuple[int, int]]] = {}
            for archive, at, size in rows:
                by.setdefault(archive, []).append((at, size))
            for archive, records in by.items():
                fs, path = _filesystem(archive)
                with fs.open_input_file(path) as f:
                    k = 0
                    for start, size in ranges(records):
                        data = f.read_at(size, start)
                        out = []
                        while k < len(records) and records[k][0] < start + size:
                            at, n_ = records[k]
                            out.append(_parsed(data[at - start : at - start + n_]))
                            k += 1
                        yield _batch(out)

    return sorted_.mapInArrow(run, _READ)


def _parsed(member: bytes) -> tuple:
    fields, body = from_record(member)
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["WARC-Payload-Length"])
    again = fields["WARC-Type"] == "revisit"
    if not again and (digest_of(body) != digest or len(body) != size):
        raise ValueError("a payload does not fit its digest")
    url = fields.get("WARC-Target-URI")
    return (
        page_of(fields["WARC-Record-ID"]), None if url is None else _unescaped(url), None if again else body, size, digest,
        fields["WARC-Type"], page_of(fields.get("WARC-Refers-To")),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in _READ.split(", ")])
