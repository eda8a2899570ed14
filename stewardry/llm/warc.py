"""WARC archives: writing captures, and assembling transactions from their records."""

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from stewardry.functions.scale import fits
from stewardry.llm.common import BROADCAST_KEYS, bound_batches, shuffle_tasks, slices
from stewardry.llm.files import new_file, reader, writer
from stewardry.session import materialize, scratch_dir

# Payloads below this length are always stored whole.
REVISIT_BYTES = 1_000
# An archive is closed once it holds this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
# The level of the archives' members.
LEVEL = 6
# Read at a time, which is also the payload bytes of one Arrow batch; and given to a decompressor, which copies what it leaves.
CHUNK, FED = 4 << 20, 1 << 14
# Fixed values of the format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(kind, page_id, url, digest):
    h = hashlib.md5(f"{kind}|{page_id}|{url}|{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _labelled(digest):
    """A hexadecimal SHA-1 as archives label it."""
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _record(fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _clean(value):
    """A header value on one line."""
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def _capture(page_id, url, payload, digest, refers_id, refers_url):
    """The three records of one capture; a revisit has no payload and names the record that has."""
    uri = _clean(url)
    response = _record_id("response", page_id, url, digest)
    common = [("WARC-Target-URI", uri), ("WARC-Date", "1970-01-01T00:00:00Z")]
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if refers_id is None:
        block = head + payload
        kind = [("WARC-Type", "response"), ("WARC-Record-ID", response)]
    else:
        block = head
        kind = [
            ("WARC-Type", "revisit"),
            ("WARC-Record-ID", response),
            ("WARC-Refers-To", _record_id("response", refers_id, refers_url, digest)),
            ("WARC-Profile", REVISIT_PROFILE),
        ]
    yield _record([*kind, *common, ("WARC-Payload-Digest", _labelled(digest)), ("Content-Type", "application/http; msgtype=response")], block)
    for name, kind_of, block in (
        ("request", "application/http; msgtype=request", f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode()),
        ("metadata", "application/warc-fields", f"page-id: {'' if page_id is None else page_id}\r\n".encode()),
    ):
        own = _record_id(name, page_id, url, digest)
        fields = [("WARC-Type", name), ("WARC-Record-ID", own), ("WARC-Concurrent-To", response), *common, ("Content-Type", kind_of)]
        yield _record(fields, block)


def mark_revisits(pages, page_id="page_id", url="url", html="html"):
    """(page_id, url, payload, digest, refers_id, refers_url): which captures repeat an earlier stored payload.

    Of equal payloads of at least ``REVISIT_BYTES`` bytes (equal SHA-1 and length) the one with the
    largest page_id is stored, the others refer to it. Only payloads that occur twice are
    joined, after a map-side maximum per digest; a digest with a third of all pages is
    split by the adaptive skew join. A null html is an empty payload; a null page_id is always stored.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    seen = rows.where(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n")
    best = F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url")))
    repeated = seen.agg(best.alias("best"), F.count("*").alias("times")).where("times > 1").drop("times")
    repeated = materialize(repeated, "warc-repeated")
    # payloads stay where they are as long as the repeated digests are few enough to send
    marked = rows.join(F.broadcast(repeated) if fits(repeated, BROADCAST_KEYS) else repeated, ["digest", "n"], "left")
    refers = F.when(F.col("page_id") < F.col("best.page_id"), F.col("best"))
    marked = marked.withColumn("refers", refers)
    return marked.select("page_id", "url", "payload", "digest", F.col("refers.page_id").alias("refers_id"), F.col("refers.url").alias("refers_url"))


def write_archives(pages, folder, archive_bytes=ARCHIVE_BYTES):
    """Three records per page in gzip members; returns the manifest (path, records) of the archives.

    A task streams its rows into files that are closed at ``archive_bytes``.
    """

    bound_batches(pages.sparkSession)

    def write(batches):
        out, path, size, records = None, None, 0, 0
        done = []
        for batch in slices(batches, 2):
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if out is None:
                    path = new_file(folder, "capture")
                    out, size, records = writer(path), 0, 0
                for record in _capture(*row):
                    data = zlib.compress(record, LEVEL, 31)
                    out.write(data)
                    size += len(data)
                    records += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in done]), pa.array([n for _, n in done], pa.int64())], names=["path", "records"]
            )

    return materialize(mark_revisits(pages).mapInArrow(write, "path string, records long"), "warc-manifest")


def _members(file):
    """The decompressed gzip members of an archive, read in chunks."""
    unzip, parts = zlib.decompressobj(31), []
    while data := file.read(CHUNK):
        data, at = memoryview(data), 0
        while at < len(data):
            fed = data[at : at + FED]
            parts.append(unzip.decompress(fed))
            at += len(fed)
            if unzip.eof:
                at -= len(unzip.unused_data)
                yield b"".join(parts)
                unzip, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("an archive ends inside a record")


def parse_record(record):
    """Headers in lower case, and the block of ``Content-Length`` bytes."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


RECORDS = (
    "type string, record_id string, concurrent_to string, refers_to string, uri string, payload binary, "
    "payload_bytes long, payload_digest string, page_id long"
)


def read_records(manifest, payloads=True):
    """One row per record of the archives. A stored payload's digest is computed again and must agree with its header."""
    names = [x.split()[0] for x in RECORDS.split(", ")]
    kinds = [pa.binary() if n == "payload" else pa.int64() if n in ("payload_bytes", "page_id") else pa.string() for n in names]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def read(batches):
        rows, held = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                with reader(path) as file:
                    for record in _members(file):
                        fields, block = parse_record(record)
                        kind = fields["warc-type"]
                        payload = digest = size = page = None
                        if kind in ("response", "revisit"):
                            digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if kind == "response":
                            payload = block.partition(b"\r\n\r\n")[2]
                            size = len(payload)
                            if hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"{path} holds a payload that does not match its digest")
                        if kind == "metadata":
                            page = block.partition(b"page-id:")[2].split(b"\r\n")[0].strip()
                            page = int(page) if page else None
                        ids = (fields.get(x) for x in ("warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri"))
                        rows.append((kind, *ids, payload if payloads else None, size, digest, page))
                        held += len(record) + 200
                        if held >= CHUNK:
                            yield batch_of(rows)
                            rows, held = [], 0
        if rows:
            yield batch_of(rows)

    files = manifest.select("path").repartition(shuffle_tasks(manifest.sparkSession), "path")
    return files.mapInArrow(read, RECORDS)


def assemble(records, ids=None):
    """One nested row per capture: ``response``, ``request``, ``metadata``, and the page and length a revisit refers to.

    Requests and metadata are joined to their response or revisit through concurrent-to, and revisits to the
    page and length of the record they name (null where there is none): on ids alone, so that a payload moves
    once, to what belongs to it (``ids``: the records without payloads, where they are at hand). Records with one record id are copies: one row whose ``copies`` counts them; of several requests or metadata records of one capture
    the least record id is kept beside their number, by a map-side minimum, so a capture
    that many records name stays one row. Captures without request or metadata keep nulls there.
    """
    narrow = records if ids is None else ids
    sides = narrow.where(F.col("type").isin("request", "metadata")).groupBy(F.col("concurrent_to").alias("record_id"))
    side = lambda kind: F.min(F.when(F.col("type") == kind, F.struct("record_id", "uri", "page_id")))
    sides = sides.agg(
        side("request").alias("request"), side("metadata").alias("metadata"), F.count("*").alias("concurrent_records")
    )
    known = narrow.where(F.col("type").isin("response", "revisit"))
    known = known.groupBy("record_id").agg(F.first("type").alias("kind"), F.first("refers_to").alias("_target"), F.first("payload_bytes").alias("n"))
    whole = materialize(known.join(sides, "record_id", "left"), "warc-sides")
    # a target with a third of all revisits is split by the adaptive skew join
    targets = whole.where("kind = 'response'").select(
        F.col("record_id").alias("_target"), F.col("metadata.page_id").alias("refers_to"), F.col("n").alias("refers_bytes")
    )
    named = whole.where("_target is not null").join(targets, "_target", "left")
    named = named.select("record_id", F.struct("refers_to", "refers_bytes").alias("refers"))
    whole = whole.join(named, "record_id", "left").drop("kind", "n", "_target")
    fields = ("type", "uri", "payload", "payload_bytes", "payload_digest", "refers_to")
    stored = records.where(F.col("type").isin("response", "revisit")).groupBy("record_id").agg(F.first(F.struct(*fields)).alias("r"), F.count("*").alias("copies"))
    response = F.struct("record_id", "r.type", "r.uri", "r.payload", "r.payload_bytes", "r.payload_digest", "r.refers_to")
    return stored.join(whole, "record_id").select(
        "record_id",
        response.alias("response"),
        "request",
        "metadata",
        F.coalesce("concurrent_records", F.lit(0)).alias("concurrent_records"),
        "copies",
        F.col("refers.refers_to").alias("refers_to"),
        F.col("refers.refers_bytes").alias("refers_bytes"),
    )


def archive_pages(pages, payloads=True):
    """Write the pages as archives in the shared folder, read them back and assemble their captures.

    Repeated identical rows are one capture, whose ``copies`` counts the records written for them. Null urls leave out the target; see
    ``mark_revisits`` for null html and ids. An empty table writes no archive.
    """
    manifest = write_archives(pages, scratch_dir(pages.sparkSession, "warc"))
    # written once: captures and their side records are both taken from it
    # ids are read first and written; payloads are read where they are joined, and kept nowhere in between
    path = scratch_dir(pages.sparkSession, "warc-ids")
    ids = read_records(manifest, payloads=False).drop("payload")
    ids.write.option("compression", "zstd").parquet(path)
    return assemble(read_records(manifest, payloads), pages.sparkSession.read.schema(ids.schema).parquet(path))
