"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing: payloads are named by SHA-1. Of the records with equal payloads of at
least ``min_bytes`` the one with the largest id is a response, the others are
revisits that refer to it and carry headers only; smaller payloads are all
responses. Every task writes archives of its own (gzip, one member per record)
under a name that no other attempt uses, and returns the index rows: archive,
offset, length, URL and digest per record. The index lists only what finished
tasks wrote, so a lost executor leaves at most files that nothing refers to.

Reading: the index rows wanted are sorted by archive and offset, neighbouring
ranges are joined into one read, and each record is unpacked and parsed.

Archives are read and written by Arrow's file systems under the shared folder.
Null html is an empty payload, a null URL gives no target header. Rows with
equal ids and payloads are the same page and get the same record type; a null
id ranks below all others and is the record of no page (id null when read
back). Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import text as tx
from strata.llm.store import written
from strata.session import scratch_path

INDEX = "archive string, offset long, length long, url string, digest string, page_id long, record_type string"
_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                    ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()),
                    ("record_type", pa.string())])
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload string")
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                     ("payload", pa.string())])
_URN = "urn:page:"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header_value(s: str) -> str:
    return s.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _plain_value(s: str) -> str:
    return s.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
                 refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header of the full payload and no body."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{_URN}{'' if refers_to is None else refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(value: str) -> int | None:
    number = value.strip("<>").removeprefix(_URN)
    return int(number) if number else None


def parse_record(raw: bytes) -> dict:
    """Fields of one record; a response's size and digest are taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    out = {"page_id": _urn(fields["WARC-Record-ID"]), "record_type": fields["WARC-Type"],
           "url": _plain_value(fields["WARC-Target-URI"]) if "WARC-Target-URI" in fields else None,
           "refers_to": None, "payload": None}
    if out["record_type"] == "revisit":
        size = next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))
        return out | {"payload_bytes": int(size.split(": ")[1]), "refers_to": _urn(fields["WARC-Refers-To"]),
                      "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:")}
    return out | {"payload_bytes": len(payload), "payload": payload.decode(),
                  "payload_digest": base32_sha1(hashlib.sha1(payload).digest())}


def _write(root: str, archive_bytes: int, buffer_bytes: int = 4 << 20):
    def run(batches):
        store, base = fs.FileSystem.from_uri(root)
        out, at, name, held = None, 0, "", []
        for b in batches:
            index: dict[str, list] = {f.name: [] for f in _INDEX}
            for page_id, url, html, sha, size, keeper, revisit in zip(*(b.column(i) for i in range(7))):
                page_id, url, revisit = page_id.as_py(), url.as_py(), revisit.as_py()
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, at = store.open_output_stream(f"{base}/{name}", compression=None), 0
                digest = base32_sha1(sha.as_py())
                payload = b"" if revisit or not html.is_valid else html.as_buffer().to_pybytes()
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                raw = packer.compress(record_bytes(page_id, url, payload, size.as_py(), digest,
                                                   keeper.as_py(), revisit)) + packer.flush()
                held.append(raw)
                for k, v in zip(index, (f"{root}/{name}", at, len(raw), url, digest, page_id,
                                        "revisit" if revisit else "response")):
                    index[k].append(v)
                at += len(raw)
                if at >= archive_bytes or sum(map(len, held)) >= buffer_bytes:
                    out.write(b"".join(held))
                    held = []
                if at >= archive_bytes:
                    out.close()
                    out = None
            yield tx.batch(_INDEX, **index)
        if out is not None:
            out.write(b"".join(held))
            out.close()

    return run


def write_archives(pages: DataFrame, root: str, *, min_bytes: int = 0,
                   archive_bytes: int = 64 << 20) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html) under ``root``; the index, as a written table.

    ``root`` is an existing folder of a store that all executors share.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.unhex(F.sha1(body)).alias("sha"), F.octet_length(body).cast("long").alias("size"))
    keepers = base.groupBy("sha").agg(F.max("page_id").alias("keeper"))
    typed = base.join(keepers, "sha").select(
        "page_id", "url", "html", "sha", "size", "keeper",
        ((F.col("size") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit"))
    typed = typed.withColumn("html", F.when(~F.col("revisit"), F.col("html")))
    return written(typed.mapInArrow(_write(root, archive_bytes), INDEX), "warc-index")


def _ranges(offset: np.ndarray, length: np.ndarray, gap: int, most: int):
    """Index runs whose byte ranges are read at once."""
    i = 0
    while i < len(offset):
        j = i + 1
        while (j < len(offset) and offset[j] - offset[j - 1] - length[j - 1] <= gap
               and offset[j] + length[j] - offset[i] <= most):
            j += 1
        yield i, j
        i = j


def _read(payloads: bool, gap: int, most: int):
    def run(batches):
        stores: dict[str, fs.FileSystem] = {}
        for b in batches:
            if not b.num_rows:
                continue
            archive = b.column(0).to_pylist()
            offset, length = b.column(1).to_numpy(), b.column(2).to_numpy()
            lo = 0
            while lo < len(archive):
                hi = lo + 1
                while hi < len(archive) and archive[hi] == archive[lo]:
                    hi += 1
                folder, _, name = archive[lo].rpartition("/")
                if folder not in stores:
                    stores[folder] = fs.FileSystem.from_uri(folder)
                store, base = stores[folder]
                with store.open_input_file(f"{base}/{name}") as f:
                    for i, j in _ranges(offset[lo:hi], length[lo:hi], gap, most):
                        start = int(offset[lo + i])
                        stop = int(offset[lo + j - 1] + length[lo + j - 1])
                        block = f.read_at(stop - start, start)
                        out = []
                        for o, n in zip(offset[lo + i:lo + j].tolist(), length[lo + i:lo + j].tolist()):
                            r = parse_record(zlib.decompress(block[o - start:o - start + n], 31))
                            if not payloads:
                                r["payload"] = None
                            out.append(r)
                        yield tx.batch(_RECORD, **{c.name: [r[c.name] for r in out] for c in _RECORD})
                lo = hi

    return run


def read_records(index: DataFrame, *, payloads: bool = True, gap: int = 64 << 10,
                 most: int = 4 << 20, task_bytes: int = 4 << 20) -> DataFrame:
    """Records of the index rows given, in sorted reads of at most ``most`` bytes (or one record).

    Index rows are few bytes however many the records have, so the number of tasks follows
    the records: one for about every ``task_bytes`` of them (compressed), each a range of
    neighbouring records.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = min(100_000, max(1, -(-int(total) // task_bytes)))
    return (index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
            .sortWithinPartitions("archive", "offset").mapInArrow(_read(payloads, gap, most), RECORD))


def new_archive_folder(spark, name: str = "warc") -> str:
    """A fresh folder for archives under the shared folder."""
    root = scratch_path(spark, name)
    root = root if "://" in root else f"file://{root.removeprefix('file:')}"
    store, base = fs.FileSystem.from_uri(root)
    store.create_dir(base, recursive=True)
    return root
