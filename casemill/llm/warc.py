"""WARC archives as a Spark data source, with deduplicated records.

Files hold WARC records, plain (``*.warc``) or each in a gzip member of its own (``*.warc.gz``).  Those
that are written here carry the ``sl`` extra field (skip length: bytes of the member, bytes of the
record) in each member's header.  A reader goes through a file with a buffer of bounded size; it
parses a record's headers first, and, where they don't meet the predicates or the payload isn't
wanted, passes over the rest: it jumps to the next member or record, or, in members without ``sl``,
inflates on without keeping anything.

``spark.read.format("warc")`` plans partitions of whole files up to ``split_bytes``.  Filters on
``record_type``, ``page_id``, ``payload_digest``, ``payload_bytes`` and ``refers_to`` are pushed down to
the headers; the option ``payload`` = ``false`` leaves payloads undecoded (and null).  The path is a
folder or a file.

Writers give each task attempt files of its own names; only the commit's manifest makes them part
of the archive, so failed or repeated attempts leave nothing that a reader sees.  A second write to a
folder adds to its manifest, or replaces it with mode ``overwrite``.  A folder without a manifest is
read file by file, whoever wrote it.

Records of other writers: page_id and refers_to are null unless record ids are of the form used
here; payload_bytes is that of the headers (X-Payload-Length, or Content-Length where the block isn't
an HTTP message), else null; payloads are given for records of type response and resource, an HTTP
message without its headers.  A record without a header block, or cut off before its end, is an error.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage

from casemill.llm.common import fresh_path, hot_join, maybe_among, open_fs, qualified, written

SCHEMA = "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint, payload binary"
HEAD, MOST_HEAD, BLOCK = 2048, 1 << 20, 1 << 16  # bytes inflated at first, of all headers of a record, read at once
MANIFEST = "_archive.json"
CRLF, GZIP = b"\r\n", b"\x1f\x8b"
URN = "urn:page:"


def register(spark) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member with the skip-length field."""
    c = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = c.compress(record) + c.flush()
    size = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, size & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def _one_line(value: str | None) -> str:
    return " ".join((value or "").split())


def record_bytes(row) -> bytes:
    payload = row.payload or b""
    ident = "none" if row.page_id is None else str(row.page_id)
    head = [
        "WARC/1.1", f"WARC-Type: {row.record_type}", f"WARC-Record-ID: <{URN}{ident}>",
        f"WARC-Target-URI: {_one_line(row.url)}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{row.payload_digest}", f"X-Payload-Length: {row.payload_bytes}",
    ]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if row.record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{URN}{row.refers_to}>"]
        block = http
    else:
        block = http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def parse_head(data: bytes) -> tuple[dict[str, str], int] | None:
    """The headers of a record and where its block starts; None if they aren't complete."""
    end = data.find(CRLF + CRLF)
    if end < 0:
        return None
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, end + 4


def row_of(head: dict[str, str]) -> dict:
    def number(urn: str | None):
        tail = (urn or "").strip("<>")
        tail = tail.removeprefix(URN) if tail.startswith(URN) else ""
        return int(tail) if tail.removeprefix("-").isdecimal() else None

    size = head.get("x-payload-length") or ("" if head.get("content-type", "").startswith("application/http") else head.get("content-length"))
    return {
        "page_id": number(head.get("warc-record-id")), "url": head.get("warc-target-uri") or None, "record_type": head.get("warc-type"),
        "payload_digest": (head.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "payload_bytes": int(size) if size and size.isdecimal() else None, "refers_to": number(head.get("warc-refers-to")), "payload": None,
    }


class Window:
    """A file that is read forward through a buffer; ``read_bytes`` counts what came from the file."""

    def __init__(self, file, block: int = BLOCK):
        self.file, self.block, self.at, self.held, self.read_bytes = file, block, 0, b"", 0
        self.size = file.size()

    def peek(self, n: int) -> bytes:
        """The next ``n`` bytes, or what is left of the file."""
        if len(self.held) < n:
            self.file.seek(self.at + len(self.held))
            more = self.file.read(max(n - len(self.held), self.block))
            self.read_bytes += len(more)
            self.held += more
        return self.held[:n]

    def skip(self, n: int) -> None:
        self.at += n
        self.held = self.held[n:]

    def back(self, data: bytes) -> None:
        """``data``, the last that was skipped, comes next again."""
        self.at -= len(data)
        self.held = data + self.held

    @property
    def left(self) -> int:
        return self.size - self.at


class Member:
    """The content of one gzip member, or of the rest of a plain file, read forward."""

    def __init__(self, window: Window):
        self.window, self.inflate, self.size, self.begin = window, None, 0, window.at
        first = window.peek(12)
        if first[:2] == GZIP:
            self.inflate = zlib.decompressobj(31)
            if len(first) == 12 and first[3] & 4:
                extra = window.peek(12 + struct.unpack_from("<H", first, 10)[0])[12:]
                while len(extra) >= 4:
                    name, n = extra[:2], struct.unpack_from("<H", extra, 2)[0]
                    if name == b"sl" and n == 8:
                        self.size = struct.unpack_from("<I", extra, 4)[0]
                    extra = extra[4 + n :]

    def read(self, most: int) -> bytes:
        """Up to ``most`` bytes more; empty at the end."""
        window = self.window
        if self.inflate is None:
            out = window.peek(most)
            window.skip(len(out))
            return out
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail
            if not data:
                data = window.peek(min(window.block, self.begin + self.size - window.at) if self.size else window.block)
                window.skip(len(data))
            out = self.inflate.decompress(data, most)
            if out:
                return out
            if not data and not self.inflate.eof:
                raise ValueError("a gzip member that is cut off")
        return b""

    def close(self) -> None:
        """Goes to the next member."""
        if self.inflate is None:
            return
        if self.size:
            window = self.window
            if self.begin + self.size > window.size:
                raise ValueError("a gzip member that is cut off")
            window.skip(self.begin + self.size - window.at)
            return
        while self.read(BLOCK):
            pass
        self.window.back(self.inflate.unused_data)

    def pass_over(self, held: bytes, n: int) -> bytes:
        """What follows the first ``n`` bytes of ``held`` and the bytes to come."""
        if self.inflate is None and n > len(held):
            if n - len(held) > self.window.left:
                raise ValueError("a record that is cut off")
            self.window.skip(n - len(held))
            return b""
        while len(held) < n:
            n -= len(held)
            held = self.read(BLOCK)
            if not held:
                raise ValueError("a record that is cut off")
        return held[n:]


def records(file, wanted=lambda row: True, payload: bool = True, stats: dict | None = None):
    """The rows of an archive file that meet ``wanted``."""
    window = Window(file)
    while window.left > 0:
        if window.peek(1) in (b"\r", b"\n"):  # between the records of a plain file
            window.skip(1)
            continue
        part, held = Member(window), b""
        while True:  # a member may hold several records
            while (parsed := parse_head(held)) is None and len(held) < MOST_HEAD and (more := part.read(HEAD)):
                held = (held + more).lstrip(CRLF) if not held else held + more
            if parsed is None:
                if held:
                    raise ValueError("a record without headers")
                break
            head, start = parsed
            row, length = row_of(head), int(head.get("content-length") or 0)
            held = held[start:]
            wants = wanted(row)
            if wants and payload and row["record_type"] in ("response", "resource"):
                blocks, missing = [held], length - len(held)
                while missing > 0 and (more := part.read(min(missing, BLOCK))):
                    blocks.append(more)
                    missing -= len(more)
                if missing > 0:
                    raise ValueError("a record that is cut off")
                held = b"".join(blocks)
                block, held = held[:length], held[length:]
                http = head.get("content-type", "").startswith("application/http") and CRLF + CRLF in block
                row["payload"] = block[block.index(CRLF + CRLF) + 4 :] if http else block
                if stats is not None:
                    stats["decoded"] = stats.get("decoded", 0) + 1
            elif part.size:  # one record in the member, whose end is known
                held = None
            else:
                held = part.pass_over(held, length)
            if wants:
                yield row
            if held is None:
                break
            held = held.lstrip(CRLF)
            if part.inflate is None:  # what was read of the next record goes back
                window.back(held)
                break
        part.close()
    if stats is not None:
        stats["read_bytes"] = stats.get("read_bytes", 0) + window.read_bytes


class FilePart(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


class Written(WriterCommitMessage):
    def __init__(self, files: list[list]):
        self.files = files


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payload = options["path"].rstrip("/"), options.get("payload", "true") != "false"
        self.split, self.tests = int(options.get("split_bytes", 32 << 20)), []

    def pushFilters(self, filters):
        for f in filters:
            name = f.child.attribute[0] if hasattr(f, "child") else getattr(f, "attribute", [""])[0]
            test = None
            if name in ("record_type", "page_id", "payload_digest", "payload_bytes", "refers_to") and len(f.attribute) == 1:
                test = {EqualTo: "eq", EqualNullSafe: "same", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le", IsNotNull: "some", IsNull: "none"}.get(type(f))
            if test:
                self.tests.append((name, test, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        fs, path = open_fs(self.path)
        files = manifest(fs, path)
        if files is None:
            files = archives(fs, path)
        parts, size = [[]], 0
        for name, length in sorted(files):
            if parts[-1] and size + length > self.split:
                parts.append([])
                size = 0
            parts[-1].append(name)
            size += length
        return [FilePart(x) for x in parts]

    def wanted(self, row: dict) -> bool:
        for name, test, value in self.tests:
            x = row[name]
            if test == "none":
                ok = x is None
            elif test == "same":
                ok = x == value
            elif x is None:
                ok = False
            else:
                ok = {"some": lambda: True, "eq": lambda: x == value, "in": lambda: x in value, "gt": lambda: x > value, "ge": lambda: x >= value, "lt": lambda: x < value, "le": lambda: x <= value}[test]()
            if not ok:
                return False
        return True

    def read(self, partition):
        fs, path = open_fs(self.path)
        for name in partition.files:
            with fs.open_input_file(f"{path}/{name}" if name else path) as f:
                for row in records(f, self.wanted, self.payload):
                    yield tuple(row.values())


def manifest(fs, path: str) -> list[list] | None:
    """[name, bytes] of the files that commits made part of an archive; None without a manifest."""
    if fs.get_file_info(f"{path}/{MANIFEST}").type.name != "File":
        return None
    with fs.open_input_stream(f"{path}/{MANIFEST}") as f:
        return json.loads(f.read())


def archives(fs, path: str) -> list[list]:
    """[name, bytes] of the archive files below a folder, or of the one file."""
    from pyarrow import fs as pfs

    info = fs.get_file_info(path)
    if info.type == pfs.FileType.File:
        return [["", info.size]]
    if info.type == pfs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = fs.get_file_info(pfs.FileSelector(path, recursive=True))
    return sorted([x.path.removeprefix(path).lstrip("/"), x.size] for x in found if x.type == pfs.FileType.File and x.base_name.endswith((".warc", ".warc.gz")))


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool = False):
        self.path, self.level, self.overwrite = options["path"].rstrip("/"), int(options.get("level", 6)), overwrite
        self.most = int(options.get("file_bytes", 32 << 20))

    def write(self, iterator):
        fs, path = open_fs(self.path)
        fs.create_dir(path, recursive=True)
        files, out, size = [], None, 0
        for row in iterator:
            if out is None:
                name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                out = fs.open_output_stream(f"{path}/{name}", compression=None)
            data = member(record_bytes(row), self.level)
            out.write(data)
            size += len(data)
            if size >= self.most:
                out.close()
                files.append([name, size])
                out = None
        if out is not None:
            out.close()
            files.append([name, size])
        return Written(files)

    def commit(self, messages):
        """The files of this write become part of the archive at once, by a manifest put in place of the last."""
        fs, path = open_fs(self.path)
        fs.create_dir(path, recursive=True)
        before = manifest(fs, path)
        if before is None and not self.overwrite and (others := [x for x, _ in archives(fs, path) if not x.startswith("part-")]):
            raise ValueError(f"{path} holds archives of another writer, such as {others[0]}")
        files = [x for m in messages if m for x in m.files]
        aside = f"{path}/{MANIFEST}.{uuid.uuid4().hex}"
        with fs.open_output_stream(aside, compression=None) as f:
            f.write(json.dumps(files if self.overwrite else (before or []) + files).encode())
        try:
            fs.move(aside, f"{path}/{MANIFEST}")
        except OSError:  # a file system that doesn't rename onto a file
            fs.delete_file(f"{path}/{MANIFEST}")
            fs.move(aside, f"{path}/{MANIFEST}")
        for name, _ in before or () if self.overwrite else ():
            fs.delete_file(f"{path}/{name}")

    def abort(self, messages):
        pass


def base32_of_hex(digest):
    """RFC 4648 base32 of 40 hex digits, with DataFrame functions: 5 digits make 4 letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for i in range(8):
        n = F.conv(F.substring(digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(letters), F.shiftright(n, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*out)


def typed_records(pages: DataFrame, *, min_revisit_bytes: int = 0) -> DataFrame:
    """The records of a table of pages, in the columns of the data source.

    Of the rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the
    largest page_id is the response and the others revisit it; smaller payloads are responses.

    Edge cases: a null html is an empty payload; repeated rows of the largest page_id are all
    responses; a null page_id is smaller than any other, and a group of only such rows is all
    responses; other columns of the input are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("_sha", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    large = rows.where(F.col("payload_bytes") >= min_revisit_bytes).select("_sha", "payload_bytes", "page_id")
    groups = large.groupBy("_sha", "payload_bytes").agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    groups = written(groups, "payloads")
    # Only pages whose payload may be there more than once are shuffled with it.
    key = F.xxhash64("_sha", "payload_bytes")
    shared = maybe_among(groups, key, key)
    both = hot_join(rows.where(shared), groups, ["_sha", "payload_bytes"], ["page_id", "url"])
    both = both.unionByName(rows.where(~shared).withColumn("_last", F.lit(None).cast("long")))
    revisit = F.col("_last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_last"))
    return both.select(
        "page_id", "url", F.when(revisit, "revisit").otherwise("response").alias("record_type"), base32_of_hex(F.col("_sha")).alias("payload_digest"),
        "payload_bytes", F.when(revisit, F.col("_last")).alias("refers_to"), F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_warc(pages: DataFrame, path: str | None = None, *, min_revisit_bytes: int = 0, level: int = 6, mode: str = "append") -> str:
    """Writes the archive of a table of pages, or adds to the one at ``path``; returns its folder.

    Revisits refer to records of the same write.
    """
    spark = pages.sparkSession
    register(spark)
    path = qualified(spark, path or fresh_path(spark, "warc"))
    typed_records(pages, min_revisit_bytes=min_revisit_bytes).write.format("warc").mode(mode).option("level", level).save(path)
    return path


def read_warc(spark, path: str, *, payload: bool = True) -> DataFrame:
    """The records of an archive: a folder or a file.

    Spark keeps the filters that one query pushed into a Python data source for the next query on the
    same DataFrame if that has none of its own; the test for a type, which all records have, makes
    sure that each has some.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, path)).where("record_type is not null")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()
