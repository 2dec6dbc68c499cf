"""Deterministic sharded WARC writer and reader (operator 1).

Writer: records are range-partitioned into shards by id and sorted in them;
each shard is written as files of gzip members (one per record), rolled when
the next member would take the compressed size beyond ``ROLL_BYTES``.  All
headers are regenerated: block and payload digests, lengths, record ids (from
id and digest) and a fixed date, so that the same rows give the same bytes
whatever the partitioning of the input.

Shard borders are cut from a hash sample of the ids (about ``CUT_SAMPLE``
rows, chosen by the hash of the id alone): a bounded sample that decides where
files end, never what they hold.

Commit: a task writes below ``_temporary`` under a name of its own and renames
finished files to their final names; a repeated task replaces a file by the
same bytes.  The manifest (a Parquet table: file, records, bytes, sha256,
first and last id) is written last; readers take only files it names, and
check their digests.

Equal payloads of ``MIN_REVISIT`` bytes or more: the record with the smallest
id is the response, the others are revisits that refer to it.  Only ids and
digests are shuffled to find them; the payloads are shuffled once, into
shards, where a shard's roles come first under each id and are met by its
pages in one sorted stream.

Files are written and read through ``pyarrow.fs``, so the folder can be any
file system that it knows; on a cluster it must be shared.

Defined results: a null payload is an empty one; a null id sorts first and
never is a response to others unless all are null; repeated rows: the first is
the response, the others revisit it; an empty table gives no files; columns
other than id, url and payload are ignored.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.llm.common import shared_path, stash

MIN_REVISIT = 100
ROLL_BYTES = 64 << 20
SHARD_BYTES = 32 << 20      # of payload a shard holds about
READ_TASKS = 100_000
CUT_SAMPLE = 200_000        # ids from which shard borders are cut
DATE = "2000-01-01T00:00:00Z"  # fixed, so that files are reproducible
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, URL
_GZIP = 31  # zlib window bits with a gzip header, whose time is 0

MANIFEST = ("file string, shard int, records bigint, bytes bigint, sha256 string, "
            "first_id string, last_id string")
READ = T.StructType([T.StructField("record_id", T.StringType()), T.StructField("payload_bytes", T.LongType()),
                     T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
                     T.StructField("refers_to", T.StringType()), T.StructField("url", T.StringType()),
                     T.StructField("payload", T.BinaryType())])


def _filesystem(path: str):
    """(file system, path in it) of a URI or a plain path."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def member(data: bytes) -> bytes:
    """One gzip member, the same bytes for the same data."""
    c = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return c.compress(data) + c.flush()


def _id_text(key) -> str:
    return "" if key is None else str(key)


def _urn(key, digest: str, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{_id_text(key)}:{digest}:{nth}')}>"


def _header(version: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(
        f"{k}: {_clean(v)}\r\n".encode() for k, v in version) + b"\r\n"


def _clean(value: str) -> str:
    """Header values hold no line ends; percent-encode them (and %)."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unclean(value: str) -> str:
    return value.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def record(key, url: str | None, payload: bytes, digest: str, refers_to, nth: int = 0) -> bytes:
    """The bytes of a response record, or of a revisit of ``refers_to``
    (a one-item tuple with the id of the response; None for a response)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    fields = [("WARC-Type", "revisit" if refers_to else "response"), ("WARC-Record-ID", _urn(key, digest, nth)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("Content-Type", "application/http;msgtype=response"), ("X-Payload-Length", str(len(payload)))]
    if key is not None:
        fields.append(("X-Key", str(key)))
    if url is not None:
        fields.append(("WARC-Target-URI", url))
    if refers_to:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _urn(refers_to[0], digest, 0))]
        if refers_to[0] is not None:
            fields.append(("X-Refers-To-Key", str(refers_to[0])))
    fields.append(("Content-Length", str(len(block))))
    return _header(fields) + block + b"\r\n\r\n"


class _Roller:
    """Files of one shard: temporary names, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, attempt: str, roll: int):
        self.fs, self.folder = _filesystem(folder)
        self.shard, self.attempt, self.roll, self.number = shard, attempt, roll, 0
        self.out, self.done = None, []

    def _open(self):
        self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
        self.temp = posixpath.join(self.folder, "_temporary", f"{self.attempt}-{self.name}")
        self.out, self.size, self.records, self.sha = self.fs.open_output_stream(
            self.temp, compression=None), 0, 0, hashlib.sha256()
        info = b"software: corpus archive writer\r\nformat: WARC File Format 1.1\r\n"
        self._put(member(_header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn(self.name, "", 0)),
                                  ("WARC-Date", DATE), ("WARC-Filename", self.name),
                                  ("Content-Type", "application/warc-fields"),
                                  ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"))
        self.first = None

    def _put(self, data: bytes):
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def add(self, key, data: bytes):
        packed = member(data)
        if self.out and self.records and self.size + len(packed) > self.roll:
            self.close()
        if not self.out:
            self._open()
        if not self.records:
            self.first = _id_text(key)
        self.last = _id_text(key)
        self._put(packed)
        self.records += 1

    def close(self):
        if self.out:
            self.out.close()
            self.fs.move(self.temp, posixpath.join(self.folder, self.name))
            self.done.append((self.name, self.shard, self.records, self.size, self.sha.hexdigest(),
                              self.first, self.last))
            self.out, self.number = None, self.number + 1


def _cuts(rows: DataFrame, n: int, total: int) -> list:
    """Ids at which shards begin, from the sample of ids with a small hash."""
    shards = max(1, -(-total // SHARD_BYTES))
    share = min(1.0, CUT_SAMPLE / max(1, n))
    bound = int((1 << 62) * share)
    sample = (rows.where("key is not null").where(F.shiftrightunsigned(F.xxhash64("key"), 2) < bound)
              .groupBy("key").agg(F.sum("payload_bytes").alias("b")).orderBy("key").collect())  # about CUT_SAMPLE
    if not sample or shards == 1:
        return []
    ends = np.cumsum([r["b"] + 1 for r in sample])
    at = np.searchsorted(ends, ends[-1] * np.arange(1, shards) / shards, "left")
    return sorted({sample[i + 1]["key"] for i in at if i + 1 < len(sample)})


def _position(edges, n: int, key):
    """How many of the n sorted ``edges`` are <= ``key``, by halving."""
    def halve(s, _):
        mid = F.shiftright(s["lo"] + s["hi"], 1)
        right = (s["lo"] < s["hi"]) & (F.get(edges, mid) <= key)
        return F.struct(F.when(right, mid + 1).otherwise(s["lo"]).alias("lo"),
                        F.when(right | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), start, halve, lambda s: s["lo"])


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
          roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` as WARC files into ``folder`` (shared); the manifest."""
    spark = pages.sparkSession
    fs, path = _filesystem(folder)
    fs.create_dir(posixpath.join(path, "_temporary"))
    kind = pages.schema[key].dataType
    src = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                       F.coalesce(F.encode(F.col(payload).cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    src = src.withColumn("digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.length("payload").cast("long"))
    brief = stash(src.select("key", F.unhex("digest").alias("digest"), "payload_bytes"), "digests")
    # null ids last when the response is chosen
    groups = brief.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("digest").agg(
        F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1")
    roles = brief.join(groups, "digest").select("key", F.hex("digest").alias("digest"), "first").distinct()

    n, total = brief.agg(F.count("*"), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    cuts = _cuts(brief, n, total)
    shard = F.lit(0) if not cuts else F.when(F.col("key").isNull(), 0).otherwise(
        _position(F.split(F.lit("\0".join(map(str, cuts))), "\0").cast(T.ArrayType(kind)), len(cuts), F.col("key")))
    pages_in = src.select(shard.cast("int").alias("shard"), "key", F.lit(1).alias("kind"), "digest", "url", "payload",
                          F.lit(None).cast(kind).alias("first"))
    roles_in = roles.select(shard.cast("int").alias("shard"), "key", F.lit(0).alias("kind"),
                            F.lower("digest").alias("digest"), F.lit(None).cast("string").alias("url"),
                            F.lit(None).cast("binary").alias("payload"), "first")
    laid = pages_in.unionByName(roles_in).repartition("shard").sortWithinPartitions(
        "shard", "key", "kind", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, roller, at, seen, role = uuid.uuid4().hex, None, object(), {}, {}
        done: list[tuple] = []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for shard, key, kind, digest, url, payload, first in zip(*columns):
                if roller is None or roller.shard != shard:
                    if roller:
                        roller.close()
                        done += roller.done
                    roller, at = _Roller(folder, shard, attempt, roll_bytes), object()
                if key != at or type(key) is not type(at):
                    at, seen, role = key, {}, {}
                if kind == 0:
                    role[digest] = first
                    continue
                nth = seen[digest] = seen.get(digest, -1) + 1
                refers = None
                if digest in role and (role[digest] != key or nth):
                    refers = (role[digest],)
                roller.add(key, record(key, url, payload, digest, refers, nth))
        if roller:
            roller.close()
            done += roller.done
        if done:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("file", "shard", "records", "bytes", "sha256", "first_id", "last_id"), d)) for d in done],
                schema=pa.schema([("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()),
                                  ("bytes", pa.int64()), ("sha256", pa.string()), ("first_id", pa.string()),
                                  ("last_id", pa.string())]))

    manifest = f"{folder}/_manifest"
    laid.mapInArrow(run, MANIFEST).write.parquet(manifest)
    fs.delete_dir(posixpath.join(path, "_temporary"))
    return spark.read.schema(MANIFEST).parquet(manifest)


def _members(stream, check) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    z, parts = zlib.decompressobj(_GZIP), []
    while block := stream.read(1 << 20):
        check.update(block)
        while block:
            parts.append(z.decompress(block))
            block = b""
            if z.eof:
                yield b"".join(parts)
                block, z, parts = z.unused_data, zlib.decompressobj(_GZIP), []
    if parts and any(parts):
        raise ValueError("an archive ends within a record")


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = {}
    for line in lines[1:]:
        k, _, v = line.partition(": ")
        fields[k] = _unclean(v)
    block = rest[:int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, block


def read(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of the manifest's files: record_id and refers_to (ids as
    text), payload_bytes, payload_digest, record_type, url, and, if asked for,
    payload.  Digests of files, blocks and payloads are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        names, arrow = READ.names, pa.schema(
            [(f.name, {"bigint": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString(), pa.string()))
             for f in READ.fields])
        held, size = [], 0
        for batch in batches:
            for name, sha in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                check = hashlib.sha256()
                with fs.open_input_stream(posixpath.join(path, name), compression=None) as stream:
                    for raw in _members(stream, check):
                        fields, block = parse(raw)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        if hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha256:"):
                            raise ValueError(f"{name}: a block's digest is wrong")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        length, body = int(fields["X-Payload-Length"]), None
                        if kind == "response":
                            body = block.partition(b"\r\n\r\n")[2]
                            length, digest = len(body), hashlib.sha256(body).hexdigest()
                            if digest != fields["WARC-Payload-Digest"].removeprefix("sha256:"):
                                raise ValueError(f"{name}: a payload's digest is wrong")
                        held.append((fields.get("X-Key"), length, digest, kind, fields.get("X-Refers-To-Key"),
                                     fields.get("WARC-Target-URI"), body if payloads else None))
                        size += length if payloads else 100
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema=arrow)
                            held, size = [], 0
                if check.hexdigest() != sha:
                    raise ValueError(f"{name} differs from its manifest")
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(names, h)) for h in held], schema=arrow)

    # a task per file up to READ_TASKS; the number is given, since a manifest's
    # few bytes would be merged into one task otherwise
    files = manifest.select("file", "sha256").repartition(max(1, min(manifest.count(), READ_TASKS)), "file")
    return files.mapInArrow(run, READ)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write ``pages`` to the shared folder and read the archives back."""
    folder = shared_path(pages.sparkSession, "warc")
    manifest = write(pages, folder, key, url, payload)
    kind = pages.schema[key].dataType
    return read(manifest, folder).withColumn("record_id", F.col("record_id").cast(kind)).withColumn(
        "refers_to", F.col("refers_to").cast(kind))
