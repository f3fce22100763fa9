"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames: frames of little-endian unsigned 32-bit ids, each
of whole documents; one frame with the directory (for each document its key and number of ids);
and, in a skippable frame, the seek table of the zstandard seekable format, with the sizes and the
low 32 bits of the XXH64 of each frame's content.  A reader takes the table from the end of the
file, then the directory, and then only the frames of the documents that are asked for; each frame
is checked against its checksum.

The ids of all documents follow one another in ascending order of doc_id (null first, equal ids by
the hash of their texts; rows that are equal in both follow in any order, which shows nowhere).  Rows
are dealt by ranges of doc_id, hash and the partition they come from, so that a repeated id, or many
nulls, go to many tasks.  Each task writes files of bounded size under names of its own, and the
manifest, written last, makes the files of the successful attempts the data set; it holds the least
and greatest doc_id of each, so that a reader opens only the files that may hold what is asked for.

Edge cases: a null or empty text is the end id alone; repeated rows each get their place; a text
of any length stays in one frame; an empty table gives a data set without files; other columns of
the input are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import uuid
from array import array
from itertools import islice
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.llm.common import Held, fresh_path, map_batches, open_fs, qualified

MAGIC_SKIPPABLE, MAGIC_SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # Fixed values: the format's magic numbers.
FRAME_BYTES, FILE_BYTES, FILE_DOCS = 1 << 18, 1 << 28, 500_000  # of ids, before compression
MANIFEST = "_tokens.json"
WORDS_KEPT, PARTS_KEPT, IDLE_KEPT = 300_000, 100_000, 150_000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself if it shows, else one past 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Kept(dict):
    """Values by key, made when they are first asked for; at ``most`` of them, the last tenth goes.

    What came first is what comes often, so most of it stays from task to task.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.most:
            self.cut(self.most - max(1, self.most // 10))
        self[key] = value
        return value

    def cut(self, most: int) -> None:
        for key in list(islice(reversed(self), max(0, len(self) - most))):
            del self[key]


token_id = attrgetter("id")
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"


class Encoder:
    """Ids of whole texts, as bytes, by a tokenizers file.

    These vocabularies cut a text into parts before they merge, and merge each part by itself.  So the
    ids of a text are those of its words, which are kept, and a new word costs a call of the
    library's model for each part that is new as well.  The cutting is that of the file's own
    pre-tokenizer, written out for ASCII and Latin letters.  Texts with other characters, or with a
    special token, are encoded whole, as all texts are with a file that differs in its normaliser,
    pre-tokenizer or kind of model.
    """

    ODD = re.compile(f"[^\x20-\x7e\t\n\r{LETTERS}]")
    RUNS = ("  ", " \n", "\n ", "\t", "\r")  # a text with none of these has single blanks only
    # The two pre-tokenizers, for the characters that are not odd.
    BYTE_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
    WORD_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
    STOPS = (".", ",")
    WORD_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    # The normaliser, the pre-tokenizer and the model that a file must state in full.
    MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
    SHAPES = {
        "byte": (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}),
        "word": (
            {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
            {"type": "Sequence", "pretokenizers": [{"type": "Split", "pattern": {"Regex": WORD_CUT}, "behavior": "Removed", "invert": True}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
        ),
    }

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.special = [x.content for x in self.model.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.merge = self.model.model.tokenize
        self.words, self.parts = Kept(self._word, WORDS_KEPT), Kept(self._merged, PARTS_KEPT)
        shape = spec["normalizer"], spec["pre_tokenizer"]
        sure = all(spec["model"].get(k) == v for k, v in self.MODEL.items())
        self.kind = next((k for k, x in self.SHAPES.items() if shape == x and sure), None)
        # What encode_all cuts texts before, and the pieces that it leaves to encode: by the kind, odd
        # characters, special tokens, and blanks that follow one another or end a text.
        self.blank, self.alone = np.zeros(256, bool), None
        self.blank[[*map(ord, " \n\t\r" if self.kind == "word" else " \n")]] = True
        if self.kind and not any(re.search(r"\s", x) for x in self.special):
            self.alone = "|".join([self.ODD.pattern, *([r"[\t\r]", r"\A[ \n]\z"] if self.kind == "byte" else []), *map(re.escape, self.special)])

    @classmethod
    def of(cls, path: str) -> Encoder:
        return Held.of((cls, path), lambda: cls(path))

    def rest(self) -> None:
        """Gives back half of the kept words, and Arrow's free memory: at the end of a task, since the worker may idle after it."""
        self.words.cut(IDLE_KEPT)
        pa.default_memory_pool().release_unused()

    def whole(self, text: str) -> bytes:
        ids = self.model.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if self.kind is None or self.ODD.search(text) or any(x in text for x in self.special):
            return self.whole(text)
        if self.kind == "word":
            return b"".join(map(self.words.__getitem__, text.split()))
        if any(x in text for x in self.RUNS):
            return self._parts(text)
        head, *rest = text.split(" ")  # single blanks: each begins the part after it
        return self._parts(head) + b"".join(map(self.words.__getitem__, rest))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of an Arrow array of strings; none for null.

        The texts are cut before each blank, and each piece that differs is looked up once.  The pieces
        share the array's bytes.  A text with a piece that can't stand by itself is encoded alone.
        """
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1] if pa.types.is_string(texts.type) and len(texts) else np.zeros(1, np.int32)
        low, high = int(offsets[0]), int(offsets[-1])
        if self.alone is None or low == high or texts.null_count and (offsets[1:] > offsets[:-1])[~texts.is_valid().to_numpy(zero_copy_only=False)].any():
            return [self.encode(x or "") for x in texts.to_pylist()]
        cut = self.blank[np.frombuffer(texts.buffers()[2], np.uint8)[low:high]]
        cut[offsets[:-1][offsets[1:] > offsets[:-1]] - low] = True
        starts = np.flatnonzero(cut).astype(np.int32) + np.int32(low)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, np.int32(high))), texts.buffers()[2]).dictionary_encode()
        own = pieces.dictionary
        alone = pc.match_substring_regex(own, self.alone).to_numpy(zero_copy_only=False)
        after = (np.frombuffer(own.buffers()[2], np.uint8)[np.frombuffer(own.buffers()[1], np.int32)[: len(own)]] == 32) & ~alone  # a blank
        rest = ~after & ~alone
        joined = own.filter(pa.array(after))  # of words with one blank before each
        known = joined.buffers()[2].to_pybytes()[: np.frombuffer(joined.buffers()[1], np.int32)[len(joined)]].decode().split(" ")[1:] if len(joined) else []
        ids = [*map(self.words.__getitem__, known), *map(self._first, own.filter(pa.array(rest)).to_pylist()), b""]
        rank = np.full(len(own), len(ids) - 1, np.int32)
        rank[after], rank[rest] = np.arange(len(known), dtype=np.int32), np.arange(len(known), len(ids) - 1, dtype=np.int32)
        which = rank[pieces.indices.to_numpy()]
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        n = sizes[which]
        upto = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        at = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[which] - upto[:-1], n)
        at += np.arange(upto[-1], dtype=np.int32)
        data = np.frombuffer(b"".join(ids), np.int32)[at].tobytes()
        first = np.searchsorted(starts, offsets)  # of each text, its first piece
        bounds = (4 * upto[first].astype(np.int64)).tolist()
        out = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        if alone.any():
            for i in np.unique(np.searchsorted(offsets, starts[which == len(ids) - 1], "right") - 1).tolist():
                out[i] = self.encode(texts[i].as_py())
        return out

    def _first(self, piece: str) -> bytes:
        """The ids of a piece that doesn't begin with a blank."""
        return self.words[piece.strip()] if self.kind == "word" else self._parts(piece)

    def _word(self, word: str) -> bytes:
        """The ids of a word, with the blank before it where that counts."""
        if word.isalpha():  # most words, and so without further calls
            if self.kind == "byte":
                return self._ids("\u0120" + word if word.isascii() else (" " + word).encode().decode("latin-1").translate(self.letters))
            low = word.lower()
            return self._merged(low) if low == word else self.words[low]
        if word[-1:] in self.STOPS and word[:-1].isalpha():
            return self.words[word[:-1]] + self.parts[word[-1]]
        if self.kind == "byte":
            return self._parts(" " + word)
        return b"".join([self.words[x] if x.isalpha() else self.parts[x] for x in self.WORD_PARTS.findall(word.lower())])

    def _parts(self, piece: str) -> bytes:
        return b"".join([self.words[x[1:]] if x[0] == " " and x[1:].isalpha() else self.parts[x] for x in self.BYTE_PARTS.findall(piece)])

    def _merged(self, part: str) -> bytes:
        """The ids of a part, by the library's model."""
        plain = part.replace(" ", "\u0120") if part.isascii() and part.replace(" ", "").isalnum() else part.encode().decode("latin-1").translate(self.letters)
        return self._ids(plain)

    def _ids(self, plain: str) -> bytes:
        ids = array("I", map(token_id, self.merge(plain)))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()


def checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    def __init__(self, sink, level: int):
        import zstandard

        self.sink, self.z = sink, zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.table, self.directory, self.buffer, self.size, self.total = [], [], [], 0, 0

    def frame(self, data: bytes) -> None:
        packed = self.z.compress(data)
        self.sink.write(packed)
        self.table.append((len(packed), len(data), checksum(data)))

    def add(self, key: int | None, ids: bytes) -> None:
        self.directory.append((key is not None, key or 0, len(ids) // 4, len(self.table)))
        self.buffer.append(ids)
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.buffer:
            self.frame(b"".join(self.buffer))
            self.buffer, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.frame(b"".join(struct.pack("<?qQI", *x) for x in self.directory))
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        self.sink.write(struct.pack("<II", MAGIC_SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0x80, MAGIC_SEEKABLE))
        self.sink.close()


class FileReader:
    """Documents of a file, by key or all; ``opened`` counts the frames that were decompressed."""

    def __init__(self, source):
        import zstandard

        self.f, self.z, self.opened = source, zstandard.ZstdDecompressor(), 0
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self.span(size - 9, 9))
        if magic != MAGIC_SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        start = size - 9 - 12 * n
        self.table = list(struct.iter_unpack("<III", self.span(start, 12 * n)))
        if struct.unpack("<II", self.span(start - 8, 8)) != (MAGIC_SKIPPABLE, 12 * n + 9):
            raise ValueError("a broken seek table")
        self.at = [0]
        for packed, _, _ in self.table:
            self.at.append(self.at[-1] + packed)
        self.directory = list(struct.iter_unpack("<?qQI", self.frame(n - 1)))

    def span(self, start: int, size: int) -> bytes:
        self.f.seek(start)
        return self.f.read(size)

    def frame(self, k: int) -> bytes:
        packed, plain, check = self.table[k]
        data = self.z.decompress(self.span(self.at[k], packed), max_output_size=plain) if plain else b""
        if len(data) != plain or checksum(data) != check:
            raise ValueError(f"frame {k} doesn't meet its checksum")
        self.opened += 1
        return data

    def documents(self, keys: set | None = None):
        """(key, number of ids before it in this file, ids as bytes)."""
        before = inside = 0
        last, data = -1, b""
        for some, key, n, k in self.directory:
            if k != last:
                inside, last, data = 0, k, None
            if keys is None or some and key in keys:
                data = self.frame(k) if data is None else data
                yield key if some else None, before, data[inside : inside + 4 * n]
            inside += 4 * n
            before += n


def write_tokens(docs: DataFrame, path: str | None = None, *, tokenizer: str, end_id: int = 1, level: int = 3, file_bytes: int = FILE_BYTES, file_docs: int = FILE_DOCS) -> str:
    """Writes the ids of all documents; returns the folder of the data set."""
    spark = docs.sparkSession
    path = qualified(spark, path or fresh_path(spark, "tokens"))
    end = struct.pack("<I", end_id)
    fields = [("part", pa.int32()), ("place", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("nulls", pa.bool_()), ("least", pa.int64()), ("most", pa.int64())]

    def run(batches):
        from pyspark import TaskContext

        encoder, fs, root = Encoder.of(tokenizer), *open_fs(path)
        out, writer, name = [], None, ""

        def done():
            writer.close()
            keys = [x[1] for x in writer.directory if x[0]]
            out.append((TaskContext.get().partitionId(), len(out), name, len(writer.directory), writer.total // 4, len(keys) < len(writer.directory), min(keys, default=None), max(keys, default=None)))

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.zst"
                    writer = FileWriter(fs.open_output_stream(f"{root}/{name}", compression=None), level)
                writer.add(key, ids + end)
                if writer.total >= file_bytes or len(writer.directory) >= file_docs:
                    done()
                    writer = None
        encoder.rest()
        if writer is not None:
            done()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, (_, t) in enumerate(fields)], schema=pa.schema(fields))

    thin = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").withColumns({"_h": F.xxhash64("text"), "_from": F.spark_partition_id()})
    ordered = thin.repartitionByRange("doc_id", "_h", "_from").sortWithinPartitions("doc_id", "_h").select("doc_id", "text")
    files = map_batches(ordered, run, "part int, place int, file string, docs long, tokens long, nulls boolean, least long, most long").collect()  # a row for each file
    manifest, start = [], 0
    for r in sorted(files, key=lambda r: (r["part"], r["place"])):
        manifest.append({k: r[k] for k in ("file", "docs", "tokens", "nulls", "least", "most")} | {"start": start})
        start += r["tokens"]
    fs, root = open_fs(path)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/{MANIFEST}", compression=None) as f:
        f.write(json.dumps(manifest).encode())
    return path


def read_tokens(spark: SparkSession, path: str, *, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (bytes), read from the files.

    With ``doc_ids`` only files whose range holds one are opened, and only the frames that hold these
    documents are read and decompressed.
    """
    path = qualified(spark, path)
    fs, root = open_fs(path)
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        manifest = json.loads(f.read())
    wanted = None if doc_ids is None else set(doc_ids)
    held = lambda x: wanted is None or x["least"] is not None and any(x["least"] <= i <= x["most"] for i in wanted)
    rows = [(x["file"], x["start"]) for x in manifest if held(x)]
    files = spark.range(0, len(rows), 1, max(1, len(rows)))  # a task for each file
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        fs, root = open_fs(path)
        for batch in batches:
            for name, start in map(rows.__getitem__, batch.column(0).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    out, size = [], 0
                    for key, before, ids in FileReader(f).documents(wanted):
                        out.append((key, start + before, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                            out, size = [], 0
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

    return map_batches(files, run, schema)
