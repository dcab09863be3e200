"""WARC archives: writing, normalising of monolithic gzip files, and reading back by a sidecar index.

A monolithic archive is one gzip stream over all its records, which cannot be
entered in the middle. The normaliser inflates it once, in pieces of bounded
size, rewrites every record as a gzip member of its own and writes a sidecar
index with the offset and length of each member.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgraph.llm.common import new_path, table, written

#: Equal payloads of at least so many bytes are stored once.
LEAST_REVISIT = 100
#: A monolithic archive is closed after so many bytes of records.
ARCHIVE_BYTES = 128 << 20
CHUNK = 1 << 20
GZIP = 31  # zlib's window bits for gzip members
LEVEL = 4
DATE = "2024-01-01T00:00:00Z"


def _fs(path: str):
    return pafs.FileSystem.from_uri(path if "://" in path else "file://" + re.sub(r"^file:", "", path))


def record_bytes(page_id: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One WARC record. A revisit has the HTTP head only, with the length of the payload it stands for."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + payload if kind == "response" else head
    name = "null" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=';/?:@&=+$,#%[]!*()~')}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflated(stream) -> Iterator[bytes]:
    """The bytes of a gzip stream of one or more members, in pieces of bounded size."""
    inflate = zlib.decompressobj(GZIP)
    while data := stream.read(CHUNK):
        while data:
            if inflate.eof:
                inflate = zlib.decompressobj(GZIP)
            if piece := inflate.decompress(data, CHUNK):
                yield piece
            data = inflate.unconsumed_tail or inflate.unused_data
    if not inflate.eof:
        raise ValueError("the gzip stream ends early")


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Splits a stream of WARC bytes into whole records."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 or held.startswith(b"\r\n"):
            if held.startswith(b"\r\n"):  # more blank lines between records than there should be
                del held[:2]
            elif not more():
                if held.strip():
                    raise ValueError("the archive ends inside a record")
                return
        size = fields(bytes(held[: end + 4]))[0].get("content-length", "")
        if not size.isdigit():
            raise ValueError("a record has no content length")
        whole = end + 4 + int(size) + 4
        while len(held) < whole:
            if not more():
                raise ValueError("the archive ends inside a record")
        yield bytes(held[:whole])
        del held[:whole]


def fields(record: bytes) -> tuple[dict[str, str], bytes]:
    """The headers (lower-case names; folded lines joined, the first of a name counts) and the block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named: dict[str, str] = {}
    for line in re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            named.setdefault(name.strip().lower().decode("utf-8", "replace"), value.strip().decode("utf-8", "replace"))
    size = named.get("content-length", "")
    return named, rest[: int(size)] if size.isdigit() else rest


def digest_fits(stated: str | None, payload: bytes) -> bool:
    """Whether a digest header (sha256 in hex or sha1 in base 32; others can't be checked) is that of the payload."""
    kind, _, value = (stated or "").partition(":")
    if kind.lower() == "sha256" and len(value) == 64:
        return hashlib.sha256(payload).hexdigest() == value.lower()
    if kind.lower() == "sha1" and len(value) == 32:
        return base64.b32encode(hashlib.sha1(payload).digest()).decode() == value.upper()
    return True


def normalise(source: str, target: str, index: str) -> int:
    """Rewrites the archive ``source`` with a gzip member per record; returns the number of records.

    Records of any kind and origin are kept as they are; the index has the id,
    type and payload digest that a record states, null for those it doesn't.
    An archive that ends inside a record or whose record has no length is an error.
    """
    fs, path = _fs(source)
    out, name = _fs(target)
    offset = n = 0
    with fs.open_input_stream(path, compression=None) as stream, out.open_output_stream(name, compression=None) as members, out.open_output_stream(_fs(index)[1], compression=None) as side:
        for record in records(inflated(stream)):
            deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
            member = deflate.compress(record) + deflate.flush()
            members.write(member)
            named, _ = fields(record)
            side.write((json.dumps({"offset": offset, "length": len(member), "id": named.get("warc-record-id"), "type": named.get("warc-type"), "digest": named.get("warc-payload-digest")}) + "\n").encode())
            offset += len(member)
            n += 1
    return n


def _write_archives(folder: str):
    schema = pa.schema([("archive", pa.string()), ("n", pa.int64())])

    def write(batches):
        state = None  # path, stream, deflater, bytes, records

        def close():
            path, stream, deflate, _, n = state
            stream.write(deflate.flush())
            stream.close()
            return pa.RecordBatch.from_pylist([{"archive": path, "n": n}], schema=schema)

        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to, revisit = (c[i].as_py() for c in cols)
                if state is None:
                    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"  # a name of its own for each attempt
                    fs, name = _fs(path)
                    fs.create_dir(name.rpartition("/")[0], recursive=True)
                    state = [path, fs.open_output_stream(name, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0, 0]
                record = record_bytes(page_id, url, "revisit" if revisit else "response", refers_to, digest, payload.encode())
                if piece := state[2].compress(record):
                    state[1].write(piece)
                state[3] += len(record)
                state[4] += 1
                if state[3] >= ARCHIVE_BYTES:
                    yield close()
                    state = None
        if state is not None:
            yield close()

    return write


def _normalise_archives(batches):
    schema = pa.schema([("archive", pa.string()), ("index", pa.string()), ("n", pa.int64())])
    for batch in batches:
        for source in batch.column("archive").to_pylist():
            attempt = uuid.uuid4().hex
            target, index = f"{source[: -len('.warc.gz')]}-{attempt}.members.warc.gz", f"{source[: -len('.warc.gz')]}-{attempt}.index.jsonl"
            yield pa.RecordBatch.from_pylist([{"archive": target, "index": index, "n": normalise(source, target, index)}], schema=schema)


def _read_archives(batches):
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def number(x: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", x or "")
        return int(found[1]) if found else None

    def read_one(data: bytes, entry: dict) -> dict | None:
        named, block = fields(zlib.decompress(data, GZIP))
        kind = named.get("warc-type")
        if named.get("warc-record-id") != entry["id"]:
            raise ValueError(f"record {entry['id']} is not where the index has it")
        if kind not in ("response", "revisit"):
            return None
        head, _, payload = block.partition(b"\r\n\r\n")
        length, stated = re.search(rb"(?im)^content-length:\s*(\d+)", head), named.get("warc-payload-digest")
        size = int(length[1]) if length else len(payload)
        if kind == "response" and (len(payload) != size or not digest_fits(stated, payload)):
            raise ValueError(f"record {entry['id']} does not hold what its headers say")
        digest = hashlib.sha256(payload).hexdigest() if kind == "response" else (stated or "").rpartition(":")[2]
        return {"page_id": number(entry["id"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(named.get("warc-refers-to"))}

    for batch in batches:
        for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist()):
            fs, name = _fs(archive)
            with fs.open_input_file(name) as members, fs.open_input_stream(_fs(index)[1], compression=None) as side:
                rest, rows = b"", []
                while True:
                    data = side.read(CHUNK)
                    *lines, rest = (rest + data).split(b"\n")
                    for entry in map(json.loads, lines):
                        members.seek(entry["offset"])
                        if (row := read_one(members.read(entry["length"]), entry)) is not None:
                            rows.append(row)
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows = []
                    if not data:
                        break
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, digest, refers_to, revisit: which records are stored in full.

    The smallest page_id of equal payloads of ``least`` bytes or more is stored,
    the others refer to it. Only digests that occur more than once are joined.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256)).withColumn("large", F.octet_length("payload") >= least)
    digests = rows.filter("large").groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("k")).filter("k > 1").select(F.col("digest").alias("__digest"), "refers_to")
    # Written, so that the join shuffles both sides itself and can split the pages of a very common payload.
    digests = written(digests, "digests")
    out = rows.join(digests, (F.col("digest") == F.col("__digest")) & F.col("large"), "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return out.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit"))


def archived(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in the shared folder: archive, index, n per normalised archive."""
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    made = written(planned(pages).mapInArrow(_write_archives(folder), "archive string, n long"), "warc-made")
    return written(made.repartition(max(1, made.count()), "archive").mapInArrow(_normalise_archives, "archive string, index string, n long"), "warc-members")


def read_back(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every response and revisit, checked against its digest.

    Records of other kinds, and the page ids of foreign records (null), are passed over.
    """
    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(_read_archives, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes, normalises and reads back ``pages``.

    Null html: an empty payload. Null url: an empty target. A null page_id is
    read back as null and never is what others refer to, unless no equal payload
    has an id: then all are responses. Rows that repeat the smallest page_id with
    its payload are all responses. An empty table gives no rows; columns besides
    page_id, url and html are ignored.
    """
    return read_back(archived(pages))


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


OP7_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS least FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to FROM m
"""
