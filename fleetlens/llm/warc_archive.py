"""Pages as a WARC archive: a deterministic sharded writer, and its reader.

The same pages give the same files byte for byte, whatever the cluster, the partitions of the
input and the attempts of its tasks.

* *Digests*: SHA-1 and length of every payload (the html in UTF-8), in a narrow table that is
  written once. Of records with equal payloads of ``REVISIT_BYTES`` or more the one with the
  smallest page_id is the response; the others become revisits, found by a join on the digest.
* *Shards*: ranges of page_id of about ``SHARD_BYTES`` of payload (more, if that made more than
  ``MAX_SHARDS``). They come from exact byte counts of equal cells of the id range; heavy cells are
  cut into cells again, so crowded ids get narrow ranges, and one id heavier than a shard is
  divided by digest. Nothing is sampled, so the ranges are the same in every run.
* *Records*: headers and digests are made anew and every record is a gzip member of its own, in
  the map stage; one shuffle takes the members to their shards, where they are sorted. What is to
  become a revisit is told by a marker row that sorts just before it, so no payload meets a join.
* *Files*: a shard's records go to files in order, a new one where the next record would take the
  compressed size over ``ROLL_BYTES``; each begins with a warcinfo record.
* *Commit*: tasks write under names of their own in ``_temporary`` and report what they wrote;
  reports of successful attempts only are the manifest. Then the files get their final names, the
  manifest its own, and ``MANIFEST.json`` last. A reader takes the files of the manifest and
  nothing else; what a lost attempt left behind is never seen and is removed.

Files are written and read by the tasks through ``pyarrow.fs``, so ``dest`` has to be shared: a
path or a URI of a store that pyarrow knows (file, hdfs, s3, gs, abfs).

Defined cases: a null html is an empty payload; a null url leaves out the target URI; a null
page_id sorts last, is named nowhere and refers to null; of rows repeated with one id and one
payload the first is the response, if any of them is; other columns are ignored; an empty table
makes an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import batch_slices, materialise, table
from fleetlens.session import remove_at_exit, shared_dir

REVISIT_BYTES = 0
SHARD_BYTES = 16_000_000  # of payload
MAX_SHARDS = 8_192
RECORD_BYTES = 500  # what a record weighs besides its payload
CELLS = 256  # a range is divided into, at a time
ROLL_BYTES = 256_000_000  # of a file
READ_BYTES = 1_000_000
SLICE_BYTES = 4_000_000
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's namespace of URLs


# ---- places -------------------------------------------------------------------------------


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of ``path`` and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if path.startswith("s3a:"):
        path = "s3:" + path[len("s3a:") :]
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


# ---- records ------------------------------------------------------------------------------


def digest_text(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode("ascii")


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member: the same bytes for the same record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + head.encode("ascii") + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


def _fields(kind: str, name: str) -> list[tuple[str, str]]:
    return [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(_NAMES, f'{kind} {name}')}>"),
        ("WARC-Date", DATE),
    ]


def _page_fields(
    kind: str, page_id: int | None, url: str | None, sha1: bytes, copy: int, block: bytes
) -> list[tuple[str, str]]:
    digest = digest_text(sha1)
    out = _fields(kind, f"{page_id} {digest} {copy}")
    if url is not None:
        out.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        out.append(("X-Page-ID", str(page_id)))
    out.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    out.append(("WARC-Block-Digest", f"sha1:{digest_text(hashlib.sha1(block).digest())}"))
    out.append(("Content-Type", "application/http; msgtype=response"))
    return out


def _http(n_bytes: int) -> bytes:
    return (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {n_bytes}\r\n\r\n"
    ).encode("ascii")


def response(page_id: int | None, url: str | None, payload: bytes, sha1: bytes, copy: int = 0) -> bytes:
    block = _http(len(payload)) + payload
    return _member(_page_fields("response", page_id, url, sha1, copy, block), block)


def revisit(
    page_id: int | None, url: str | None, n_bytes: int, sha1: bytes, first: int | None, copy: int
) -> bytes:
    """A record that stands for the equal payload of page ``first``."""
    block = _http(n_bytes)
    fields = _page_fields("revisit", page_id, url, sha1, copy, block)
    name = uuid.uuid5(_NAMES, f"response {first} {digest_text(sha1)} 0")
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:uuid:{name}>")]
    if first is not None:
        fields.append(("X-Refers-To-Page-ID", str(first)))
    return _member(fields, block)


def warcinfo(name: str) -> bytes:
    fields = [*_fields("warcinfo", name), ("WARC-Filename", name)]
    fields.append(("Content-Type", "application/warc-fields"))
    return _member(fields, b"software: fleetlens\r\nformat: WARC File Format 1.1\r\n")


# ---- shards -------------------------------------------------------------------------------


@dataclass
class Shards:
    """Ranges of page_id: their starts, first shard numbers, and shards by digest in each."""

    start: np.ndarray
    base: np.ndarray
    parts: np.ndarray
    null_base: int
    null_parts: int

    @property
    def n(self) -> int:
        return self.null_base + self.null_parts

    def of(self, page_id: pa.Array, sha1: pa.Array) -> np.ndarray:
        null = page_id.is_null().to_numpy(zero_copy_only=False)
        ids = page_id.fill_null(0).to_numpy()
        at = np.maximum(np.searchsorted(self.start, ids, side="right") - 1, 0)
        base = np.where(null, self.null_base, self.base[at])
        parts = np.where(null, self.null_parts, self.parts[at])
        head = [int.from_bytes(s[:4], "big") for s in sha1.to_pylist()]
        return base + (np.array(head, dtype=np.int64) * parts >> 32)


def _cells(narrow: DataFrame, ranges: list[tuple[int, int]]) -> dict[tuple[int, int], int]:
    """Bytes by (range, cell): a row per cell of the given ranges at most."""
    low = np.array([a for a, _ in ranges], dtype=np.int64)
    high = np.array([b for _, b in ranges], dtype=np.int64)
    width = np.array([_width(a, b) for a, b in ranges], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ranges) * CELLS, dtype=np.int64)
        for b in batches:
            ids = b["page_id"].to_numpy(zero_copy_only=False)
            size = b["n_bytes"].to_numpy(zero_copy_only=False)
            at = np.searchsorted(low, ids, side="right") - 1
            inside = (at >= 0) & (ids <= high[at])
            at, ids, size = at[inside], ids[inside], size[inside]
            # differences of 64-bit numbers, as unsigned ones
            cell = ((ids.view(np.uint64) - low[at].view(np.uint64)) // width[at]).astype(np.int64)
            np.add.at(total, at * CELLS + cell, size + RECORD_BYTES)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some // CELLS), pa.array(some % CELLS), pa.array(total[some])],
            names=["range", "cell", "n"],
        )

    rows = narrow.filter("page_id IS NOT NULL").select("page_id", "n_bytes")
    counted = rows.mapInArrow(run, "range long, cell long, n long").groupBy("range", "cell")
    return {(r["range"], r["cell"]): r["n"] for r in counted.agg(F.sum("n").alias("n")).collect()}


def _width(low: int, high: int) -> int:
    return -(-(high - low + 1) // CELLS)


def plan_shards(narrow: DataFrame, shard_bytes: int = SHARD_BYTES) -> Shards:
    """Shards of ``narrow (page_id, n_bytes, ...)``, from exact counts only."""
    weight = F.col("n_bytes") + RECORD_BYTES
    r = narrow.agg(
        F.min("page_id").alias("low"),
        F.max("page_id").alias("high"),
        F.coalesce(F.sum(weight), F.lit(0)).alias("all"),
        F.coalesce(F.sum(F.when(F.col("page_id").isNull(), weight)), F.lit(0)).alias("null"),
    ).first()
    target = max(shard_bytes, -(-r["all"] // MAX_SHARDS))
    done: list[tuple[int, int, int]] = []  # (low, high, bytes)
    heavy = [] if r["low"] is None else [(r["low"], r["high"])]
    while heavy:
        found, heavy_next = _cells(narrow, heavy), []
        for (k, cell), n in found.items():
            low, high = heavy[k]
            width = _width(low, high)
            own = (low + cell * width, min(high, low + (cell + 1) * width - 1))
            if n > target and own[0] < own[1]:
                heavy_next.append(own)
            else:
                done.append((*own, n))
        heavy = sorted(heavy_next)
    start, base, parts, number, held = [], [], [], 0, 0
    for low, _, n in sorted(done):
        split = -(-n // target)
        if not start or held + n > target:
            number += parts[-1] if parts else 0
            start, base, parts, held = [*start, low], [*base, number], [*parts, split], n
        else:
            held += n
    after = base[-1] + parts[-1] if base else 0
    return Shards(
        np.array(start or [0], dtype=np.int64),
        np.array(base or [0], dtype=np.int64),
        np.array(parts or [1], dtype=np.int64),
        after,
        -(-r["null"] // target),
    )


# ---- writing ------------------------------------------------------------------------------

ROW = "shard long, page_id long, sha1 binary, kind int, url string, n_bytes long, first long, member binary"
_ROW_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
_ROW_NAMES = [c.split()[0] for c in ROW.split(", ")]
MARKER, RECORD = 0, 1

MANIFEST = "name string, temporary string, records long, bytes long, sha1 string, first_page long, last_page long"
_MANIFEST_TYPES = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_MANIFEST_NAMES = [c.split()[0] for c in MANIFEST.split(", ")]


def _digests(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.unhex(F.sha1(payload)).alias("sha1"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    )


def _markers(narrow: DataFrame, revisit_bytes: int) -> DataFrame:
    """``page_id, sha1, first`` of the payloads that an earlier page has as well."""
    rows = narrow.filter(F.col("n_bytes") >= revisit_bytes).select("page_id", "sha1").distinct()
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    return rows.join(first, "sha1").filter(~F.col("page_id").eqNullSafe(F.col("first")))


def _members(pages: DataFrame, shards: Shards) -> DataFrame:
    """Every page as a response, packed, with its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch_slices(batch, "html", SLICE_BYTES):
                payloads = [(t or "").encode("utf-8") for t in b["html"].to_pylist()]
                sha1 = [hashlib.sha1(p).digest() for p in payloads]
                ids, urls = b["page_id"].to_pylist(), b["url"].to_pylist()
                members = list(map(response, ids, urls, payloads, sha1))
                n = b.num_rows
                columns = [
                    pa.array(shards.of(b["page_id"], pa.array(sha1, type=pa.binary()))),
                    b["page_id"],
                    sha1,
                    [RECORD] * n,
                    b["url"],
                    [len(p) for p in payloads],
                    [None] * n,
                    members,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, t in zip(columns, _ROW_TYPES, strict=True)],
                    names=_ROW_NAMES,
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(run, ROW)


def _marker_rows(markers: DataFrame, shards: Shards) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            columns = [
                pa.array(shards.of(b["page_id"], b["sha1"])),
                b["page_id"],
                b["sha1"],
                [MARKER] * n,
                [None] * n,
                [None] * n,
                b["first"],
                [None] * n,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, _ROW_TYPES, strict=True)],
                names=_ROW_NAMES,
            )

    return markers.select("page_id", "sha1", "first").mapInArrow(run, ROW)


class _Roll:
    """The files of one shard, one after the other, under temporary names."""

    def __init__(self, dest: str, shard: int, roll_bytes: int):
        self.fs, self.path = store_of(dest)
        self.shard, self.roll_bytes = shard, roll_bytes
        self.number, self.out = 0, None

    def add(self, page_id: int | None, member: bytes) -> Iterator[tuple]:
        if self.out and self.bytes + len(member) > self.roll_bytes:
            yield self.close()
        if not self.out:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.sha1, self.bytes, self.records, self.first = hashlib.sha1(), 0, 0, page_id
            self._put(warcinfo(self.name))
        self._put(member)
        self.records += 1
        self.last = page_id

    def _put(self, member: bytes) -> None:
        self.out.write(member)
        self.sha1.update(member)
        self.bytes += len(member)

    def close(self) -> tuple:
        self.out.close()
        self.out = None
        self.number += 1
        return (
            self.name,
            self.temporary,
            self.records,
            self.bytes,
            self.sha1.hexdigest(),
            self.first,
            self.last,
        )


def _write_files(rows: DataFrame, dest: str, revisit_bytes: int, roll_bytes: int) -> DataFrame:
    """Write sorted rows of whole shards; a manifest row per file."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        roll = marker = last = None
        copy = 0
        for b in batches:
            columns = [b[c].to_pylist() for c in _ROW_NAMES]
            for shard, page_id, sha1, kind, url, n_bytes, first, member in zip(*columns, strict=True):
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        yield roll.close()
                    roll, marker, last = _Roll(dest, shard, roll_bytes), None, None
                key = (page_id, sha1)
                if kind == MARKER:
                    marker = (key, first)
                    continue
                copy = copy + 1 if key == last else 0
                last = key
                if marker and marker[0] == key:
                    member = revisit(page_id, url, n_bytes, sha1, marker[1], copy)
                elif copy and n_bytes >= revisit_bytes:
                    member = revisit(page_id, url, n_bytes, sha1, page_id, copy)
                elif copy:  # a response like the one before, under an id of its own
                    _, block = parse_record(zlib.decompress(member, 31))
                    member = response(page_id, url, block.partition(b"\r\n\r\n")[2], sha1, copy)
                yield from roll.add(page_id, member)
        if roll is not None:
            yield roll.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in files(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], type=t) for x, t in zip(row, _MANIFEST_TYPES, strict=True)],
                names=_MANIFEST_NAMES,
            )

    return rows.mapInArrow(run, MANIFEST)


def _commit(manifest: DataFrame, dest: str) -> None:
    """Final names for the files, then for the manifest, then ``MANIFEST.json``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store_of(dest)
        for b in batches:
            for name, temporary in zip(b["name"].to_pylist(), b["temporary"].to_pylist(), strict=True):
                # a task that is run again finds the files already moved
                if fs.get_file_info(f"{path}/{temporary}").type == pafs.FileType.File:
                    fs.move(f"{path}/{temporary}", f"{path}/{name}")
                elif fs.get_file_info(f"{path}/{name}").type != pafs.FileType.File:
                    raise FileNotFoundError(f"{dest}: {temporary} is gone and {name} is not there")
            yield b.select(["records", "bytes"])

    moved = manifest.mapInArrow(run, "records long, bytes long").agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )
    totals = moved.first().asDict()
    fs, path = store_of(dest)
    manifest.drop("temporary").write.parquet(f"{dest.rstrip('/')}/_temporary/manifest")
    fs.move(f"{path}/_temporary/manifest", f"{path}/manifest")
    with fs.open_output_stream(f"{path}/_temporary/MANIFEST.json", compression=None) as out:
        out.write(json.dumps(totals, sort_keys=True).encode())
    fs.move(f"{path}/_temporary/MANIFEST.json", f"{path}/MANIFEST.json")
    fs.delete_dir(f"{path}/_temporary")


def write_archive(
    pages: DataFrame,
    dest: str,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Write ``pages (page_id, url, html)`` as an archive in the shared folder ``dest``."""
    fs, path = store_of(dest)
    if fs.get_file_info(f"{path}/MANIFEST.json").type == pafs.FileType.File:
        raise FileExistsError(f"{dest} holds an archive")
    fs.create_dir(f"{path}/_temporary", recursive=True)
    narrow = materialise(_digests(pages), "warc-digests")
    shards = plan_shards(narrow, shard_bytes)
    rows = _members(pages, shards).union(_marker_rows(_markers(narrow, revisit_bytes), shards))
    dealt = rows.repartition("shard").sortWithinPartitions(
        "shard", F.col("page_id").asc_nulls_last(), "sha1", "kind", "url"
    )
    manifest = materialise(_write_files(dealt, dest, revisit_bytes, roll_bytes), "warc-manifest")
    _commit(manifest, dest)


# ---- reading ------------------------------------------------------------------------------


def members(read, size: int = READ_BYTES) -> Iterator[bytes]:
    """The records of a file, one gzip member after the other; ``read(n)`` gives its bytes."""
    data = read(size)
    while data:
        unpack = zlib.decompressobj(31)
        out = []
        while not unpack.eof:
            if not data:
                raise ValueError("the file ends inside a record")
            out.append(unpack.decompress(data))
            data = unpack.unused_data if unpack.eof else read(size)
        yield b"".join(out)
        data = data or read(size)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields in lower case and the block; its length and digest are checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version + b"\r\n" != VERSION:
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {}
    for line in lines:
        k, _, v = line.decode("utf-8").partition(":")
        fields[k.strip().lower()] = v.strip()
    n = int(fields["content-length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"{fields.get('warc-record-id')}: the block has another length")
    given = fields.get("warc-block-digest")
    if given and given != f"sha1:{digest_text(hashlib.sha1(block).digest())}":
        raise ValueError(f"{fields.get('warc-record-id')}: the block has another digest")
    return fields, block


READ = (
    "file string, page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, payload binary"
)
_READ_TYPES = [
    pa.string(),
    pa.int64(),
    pa.string(),
    pa.int64(),
    pa.string(),
    pa.string(),
    pa.int64(),
    pa.binary(),
]


def _page(name: str, record: bytes, with_payload: bool) -> tuple | None:
    fields, block = parse_record(record)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    head, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(v) for k, v in (x.split(b":", 1) for x in head.split(b"\r\n")[1:]) if k.lower() == b"content-length"
    )
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (
        len(payload) != length or digest_text(hashlib.sha1(payload).digest()) != digest
    ):
        raise ValueError(f"{fields['warc-record-id']}: the payload has another length or digest")
    page_id, first = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    return (
        name,
        None if page_id is None else int(page_id),
        fields.get("warc-target-uri"),
        length,
        digest,
        kind,
        None if first is None else int(first),
        payload if with_payload and kind == "response" else None,
    )


def read_archive(spark: SparkSession, dest: str, payload: bool = False) -> DataFrame:
    """The pages' records from the files of the manifest; every digest is checked.

    With ``payload`` responses carry theirs; a revisit's is that of page ``refers_to``.
    """
    fs, path = store_of(dest)
    with fs.open_input_stream(f"{path}/MANIFEST.json", compression=None) as f:
        n_files = json.loads(f.read())["files"]
    names = [c for c in _MANIFEST_NAMES if c != "temporary"]
    schema = ", ".join(c for c in MANIFEST.split(", ") if c.split()[0] in names)
    manifest = spark.read.schema(schema).parquet(f"{dest.rstrip('/')}/manifest")

    def rows(name: str, n_bytes: int, sha1: str) -> Iterator[tuple]:
        fs, path = store_of(dest)
        seen = hashlib.sha1()
        size = 0
        with fs.open_input_stream(f"{path}/{name}", compression=None) as f:

            def read(n: int) -> bytes:
                nonlocal size
                data = f.read(n)
                size += len(data)
                seen.update(data)
                return data

            for record in members(read):
                if found := _page(name, record, payload):
                    yield found
        if size != n_bytes or seen.hexdigest() != sha1:
            raise ValueError(f"{dest}/{name} is not the file of the manifest")

    def batch(part: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*part, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, _READ_TYPES, strict=True)],
            names=[c.split()[0] for c in READ.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, n_bytes, sha1 in zip(
                *(b[c].to_pylist() for c in ("name", "bytes", "sha1")), strict=True
            ):
                part, held = [], 0
                for row in rows(name, n_bytes, sha1):
                    part.append(row)
                    held += len(row[-1] or b"") + 200
                    if held >= SLICE_BYTES:
                        yield batch(part)
                        part, held = [], 0
                if part:
                    yield batch(part)

    # a task per file, as far as the number of tasks is sensible
    files = manifest.select("name", "bytes", "sha1").repartition(max(1, min(n_files, MAX_SHARDS)))
    return files.mapInArrow(run, READ)


def archive(pages: DataFrame, **options: int) -> DataFrame:
    """Write ``pages`` to a new archive in the shared folder, for as long as the driver's Python
    runs, and read it back."""
    dest = shared_dir(pages.sparkSession, "warc")
    remove_at_exit(pages.sparkSession, dest)
    write_archive(pages, dest, **options)
    return read_archive(pages.sparkSession, dest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: every page's record, as read back from the archive."""
    return archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


# SHA-1 in base32: five hexadecimal digits are four of its letters.
ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1
              AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q"""
