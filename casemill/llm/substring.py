"""Substring deduplication with suffix automata of reference shards.

A passage of ``window`` or more words that a document with a smaller doc_id holds as well is removed:
each word inside a ``window``-word sequence that starts in such a document.  All is judged on the
input.

The corpus is its own reference, so it is neither broadcast nor searched shard by shard by every
document; instead its passages and the documents' meet in shards by content:

1. The documents are written once to the shared folder; a task works on a file of these, a
   bounded chunk of words at a time.
2. Each window has an anchor, the ``gram``-word sequence of least hash in it.  The consecutive
   windows of one anchor form a passage (at most ``2 * window - gram`` words).  Equal windows have
   equal anchors, so a shard by anchor sees all copies of its windows.  A chunk sends each
   distinct passage once, with its least and largest doc_id, packed by shard.
3. A shard drops anchors that only one document holds.  For each other anchor it goes through the
   distinct passages in the order of their least doc_id, and streams each through the suffix
   automaton of those before; where the matching statistic reaches ``window``, the state's first
   doc_id is the least document of that window.  What is new is added to the automaton.
4. For each passage the least doc_id of each window goes back to the chunk it came from, whose task
   marks the windows of smaller documents, and removes maximal spans.

Anchors that a sample of the documents shows to be very common are split: their windows are sent
one by one, dealt by their own hash.  The list (at most ``HOT`` anchors) only balances shards; any
list gives the same result.

Edge cases: a null or empty text has no words; a document of fewer words than ``window`` loses none;
repeated rows of one doc_id don't count against each other; rows with a null doc_id are no
reference and lose nothing; an empty table gives none; other columns of the input are ignored.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemill.llm.common import Held, fresh_path, map_batches, open_fs

WINDOW, GRAM = 13, 4
CHUNK_WORDS = 400_000
SHARD_BYTES = 4 << 20  # of the corpus as written
SHARD_TASKS = 16_384
HOT, HOT_SAMPLE, HOT_LEAST = 4096, 0.01, 16
MULT = np.uint64(0x9E3779B97F4A7C15)


class SuffixAutomaton:
    """Of sequences that are added in the order of their owners; a state knows its first owner."""

    def __init__(self):
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [None]

    def _state(self, length: int, moves: dict, link: int, first) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q], self.first[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence, owner) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            new = self._state(self.length[last] + 1, {}, 0, owner)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def first_owners(self, sequence, window: int) -> list:
        """For each window of the sequence the first owner that has it, or None."""
        out, at, met = [], 0, 0
        moves, link, length, first = self.next, self.link, self.length, self.first
        for i, c in enumerate(sequence):
            while at and c not in moves[at]:
                at = link[at]
                met = length[at]
            q = moves[at].get(c)
            if q is not None:
                at, met = q, met + 1
                while length[link[at]] >= window:
                    at = link[at]
                    met = length[at]
            if i >= window - 1:
                out.append(first[at] if met >= window else None)
        return out


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of an odd base and of its inverse, modulo 2**64."""

    base = int(MULT)
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            for name, x in (("up", cls.base), ("down", pow(cls.base, -1, 1 << 64))):
                steps = np.full(size, x, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up[:n], cls.down[:n]


def span_hashes(line: np.ndarray):
    """A function of (starts, ends) that hashes these spans of the bytes, alike for equal bytes."""
    up, down = Powers.to(len(line) + 1)
    total = np.zeros(len(line) + 1, np.uint64)
    np.cumsum((line.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return lambda a, b: mix((total[b] - total[a]) * down[a])


def window_minima(x: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` values the place of the (first) least."""
    at, width = np.arange(len(x)), 1
    least = x
    while width < span:
        step = min(width, span - width)
        left, right = least[: len(least) - step], least[step:]
        less = right < left
        at = np.where(less, at[step:], at[: len(at) - step])
        least = np.where(less, right, left)
        width += step
    return at


class Chunk:
    """Some documents: their words, passages, and what a shard needs of each distinct passage."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lines: list[bytes] = []
        self.n_words: list[int] = []
        self.total = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        parts = (text or "").encode("utf-8", "replace").split()
        self.ids.append(doc_id)
        self.lines.append(b" ".join(parts))
        self.n_words.append(len(parts))
        self.total += len(parts)

    def solve(self, hot: np.ndarray, window: int, gram: int, shards: int = 1) -> Chunk:
        """Finds the passages.

        ``first``, ``count`` and ``owner`` tell each one's first window, its windows and its document;
        ``number`` which of the distinct ones it is; of these ``keys``, ``low``, ``high``, ``windows`` and
        the span of bytes (``a`` to ``b``) are kept.
        """
        self.shards = shards
        some = [x for x in self.lines if x]
        self.text = b" ".join(some)
        n = np.array(self.n_words, np.int64)
        self.begin = np.cumsum(n) - n  # the first word of each document
        line = np.frombuffer(self.text, np.uint8)
        blanks = np.flatnonzero(line == 32)
        self.starts, self.ends = (np.r_[0, blanks + 1], np.r_[blanks, len(line)]) if len(line) else (np.zeros(0, np.int64),) * 2
        hashed = span_hashes(line)
        # Documents with an id and the length of a window; all windows of these, in order.
        able = np.flatnonzero((n >= window) & np.array([x is not None for x in self.ids], bool)) if len(n) else np.zeros(0, np.int64)
        m = n[able] - window + 1
        doc = np.repeat(able, m)
        places = np.arange(len(doc)) - np.repeat(np.cumsum(m) - m, m) + self.begin[doc]
        empty = np.zeros(0, np.int64)
        self.first = self.count = self.owner = self.number = self.low = self.high = self.windows = self.a = self.b = empty
        self.keys = np.zeros(0, np.uint64)
        if not len(places):
            return self
        grams = hashed(self.starts[: len(self.starts) - gram + 1], self.ends[gram - 1 :])
        anchor = window_minima(grams, window - gram + 1)[places]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        first, owner, keys, count = places[new], doc[new], grams[anchor[new]], np.diff(np.r_[new, len(places)])
        if len(hot):
            common = hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys
            alone = np.repeat(np.flatnonzero(common), count[common])
            single = first[alone] + np.arange(len(alone)) - np.repeat(np.cumsum(count[common]) - count[common], count[common])
            own = hashed(self.starts[single], self.ends[single + window - 1]) | np.uint64(1)
            keys, owner = np.r_[keys[~common], own], np.r_[owner[~common], owner[alone]]
            first, count = np.r_[first[~common], single], np.r_[count[~common], np.ones(len(single), np.int64)]
        a, b = self.starts[first], self.ends[first + count + window - 2]
        _, chosen, number = np.unique(hashed(a, b), return_index=True, return_inverse=True)
        # Equal hashes are compared in full; the odd one out is a passage of its own.
        other = np.flatnonzero(chosen[number] != np.arange(len(a)))
        text, like = self.text, chosen[number[other]]
        odd = [k for k, w, x, y, z in zip(other.tolist(), a[other].tolist(), b[other].tolist(), a[like].tolist(), b[like].tolist(), strict=True) if text[w:x] != text[y:z]]
        if odd:
            number[odd] = len(chosen) + np.arange(len(odd))
            chosen = np.r_[chosen, odd]
        # In the order of shards, so that a shard's passages are numbered one after another.
        order = np.lexsort((a[chosen], keys[chosen] % np.uint64(shards)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        chosen, number = chosen[order], rank[number]
        ids = np.array([0 if x is None else x for x in self.ids], np.int64)[owner]
        self.low, self.high = np.full(len(chosen), np.iinfo(np.int64).max), np.full(len(chosen), np.iinfo(np.int64).min)
        np.minimum.at(self.low, number, ids)
        np.maximum.at(self.high, number, ids)
        self.first, self.count, self.owner, self.number = first, count, owner, number
        self.keys, self.windows, self.a, self.b = keys[chosen], count[chosen], a[chosen], b[chosen]
        return self

    def packed(self):
        """(shard, bytes) with the passages for each shard.

        Of a key 32 bits are enough: a shard compares the passages of a key in full.
        """
        if not len(self.keys):
            return
        import zstandard

        z, text = zstandard.ZstdCompressor(level=3), self.text
        shard = (self.keys % np.uint64(self.shards)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, np.diff(shard) != 0, True]).tolist()
        columns = [v.astype(t) for v, t in zip((self.keys >> np.uint64(32), self.low, self.high - self.low, self.windows, self.b - self.a), KINDS, strict=True)]
        spans = [text[i:j] for i, j in zip(self.a.tolist(), self.b.tolist(), strict=True)]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(shard[x]), z.compress(struct.pack("<II", y - x, x) + b"".join(v[x:y].tobytes() for v in columns) + b"".join(spans[x:y]))

    def kept(self, numbers: np.ndarray, sizes: np.ndarray, least: np.ndarray, window: int):
        """(doc_id, n_words, removed spans, kept text) of each document.

        ``least`` has, one after another, the least doc_ids of the windows of the passages ``numbers``.
        """
        gone = np.zeros(self.total + 1, np.int32)
        if len(numbers):
            place = np.full(len(self.keys), -1, np.int64)
            place[numbers] = np.cumsum(sizes) - sizes
            told = np.flatnonzero(place[self.number] >= 0)
            count = self.count[told]
            each = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            ids = np.array([0 if x is None else x for x in self.ids], np.int64)[self.owner[told]]
            less = least[np.repeat(place[self.number[told]], count) + each] < np.repeat(ids, count)
            at = (np.repeat(self.first[told], count) + each)[less]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
        lost = np.cumsum(gone[:-1]) > 0
        for doc_id, line, n, a in zip(self.ids, self.lines, self.n_words, self.begin.tolist(), strict=True):
            own = lost[a : a + n]
            if not own.any():
                yield doc_id, n, [], line.decode()
                continue
            edges = np.flatnonzero(np.diff(np.r_[False, own, False])).tolist()
            words, out, at = line.split(b" "), [], 0
            for x, y in zip(edges[::2], edges[1::2], strict=True):
                out += words[at:x]
                at = y
            yield doc_id, n, [{"start": x, "end": y} for x, y in zip(edges[::2], edges[1::2], strict=True)], b" ".join(out + words[at:]).decode()


KINDS = (np.uint32, np.int64, np.int64, np.int32, np.int32)


def unpacked(data: bytes) -> tuple:
    """(first number, keys, low, high, lengths, their places, the bytes) of a chunk's part of a shard."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(data)
    (n, first), at, out = struct.unpack_from("<II", data), 8, []
    for kind in KINDS:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    key, low, more, _, size = out
    return first, key, low, low + more, size, np.cumsum(size, dtype=np.int64) - size + at, data


def solve_shard(parts: list, window: int) -> list[list[tuple[int, list[int]]]]:
    """For each chunk's part of a shard: (passage, least doc_id of each of its windows), where it matters."""
    out: list[list[tuple[int, list[int]]]] = [[] for _ in parts]
    key, low, high = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
    owner = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
    place = np.concatenate([np.arange(len(p[1])) for p in parts])
    order = np.argsort(key, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    shared = np.minimum.reduceat(low[order], cuts) < np.maximum.reduceat(high[order], cuts)
    ends = np.r_[cuts[1:], len(order)]
    for a, b in zip(cuts[shared].tolist(), ends[shared].tolist(), strict=True):
        texts: dict[bytes, int] = {}
        members: list[tuple[bytes, int, int, int]] = []
        for e in order[a:b].tolist():
            k, i = int(owner[e]), int(place[e])
            p = parts[k]
            start = int(p[5][i])
            text = p[6][start : start + int(p[4][i])]
            members.append((text, k, i, int(high[e])))
            least = int(low[e])
            if least < texts.get(text, least + 1):
                texts[text] = least
        found: dict[bytes, list[int]] = {}
        automaton = SuffixAutomaton()
        for text, least in sorted(texts.items(), key=lambda x: x[1]):
            words = text.split(b" ")
            seen = automaton.first_owners(words, window)
            if None in seen and len(texts) > 1:
                automaton.add(words, least)
            found[text] = [least if x is None or x > least else x for x in seen]
        for text, k, i, most in members:
            if min(found[text]) < most:
                out[k].append((parts[k][0] + i, found[text]))
    return out


def _files(path: str) -> list[tuple[str, int]]:
    from pyarrow import fs as pfs

    fs, root = open_fs(path)
    found = fs.get_file_info(pfs.FileSelector(root))
    return sorted((x.path, x.size) for x in found if x.base_name.endswith(".parquet") and x.size)


def _chunks(fs, name: str, hot: np.ndarray, window: int, gram: int, shards: int, most: int):
    """The chunks of a file, the same each time."""
    import pyarrow.parquet as pq

    Held.drop()
    chunk = Chunk()
    with fs.open_input_file(name) as f:
        for batch in pq.ParquetFile(f).iter_batches(256, columns=["doc_id", "text"]):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                chunk.add(doc_id, text)
                if chunk.total >= most:
                    yield chunk.solve(hot, window, gram, shards)
                    chunk = Chunk()
    if chunk.ids:
        yield chunk.solve(hot, window, gram, shards)


def common_anchors(docs: DataFrame, window: int, gram: int) -> np.ndarray:
    """Anchors that many documents of a sample hold, at most HOT of them."""

    def run(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunk = Chunk()
                chunk.add(0, text)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(chunk.solve(np.zeros(0, np.uint64), window, gram).keys).view(np.int64))], names=["anchor"])

    found = map_batches(docs.sample(False, HOT_SAMPLE, 7).select("text"), run, "anchor long")
    top = found.groupBy("anchor").count().where(F.col("count") >= HOT_LEAST).orderBy(F.desc("count"), "anchor").limit(HOT).collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, chunk_words: int = CHUNK_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, n_words, removed (spans of words: start, end) and kept_text (its words, one blank between)."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")
    work, answers = fresh_path(spark, "passages"), fresh_path(spark, "passage-owners")
    docs.write.option("compression", "zstd").parquet(work)
    files = _files(work)
    hot = common_anchors(spark.read.schema(docs.schema).parquet(work), window, gram)
    shards = max(1, -(-sum(n for _, n in files) // shard_bytes))
    tasks = spark.range(0, len(files), 1, max(1, len(files)))  # one for each file

    def send(batches):
        fs, _ = open_fs(work)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                for c, chunk in enumerate(_chunks(fs, files[k][0], hot, window, gram, shards, chunk_words)):
                    rows = list(chunk.packed())
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(rows), pa.int32()), pa.array([c] * len(rows), pa.int32()), pa.array([s for s, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], names=["file", "chunk", "shard", "data"])

    def match(batches):
        import zstandard

        def solved(rows):
            parts = [unpacked(x) for _, _, x in rows]
            for (k, c, _), found in zip(rows, solve_shard(parts, window), strict=True):
                if found:
                    data = struct.pack("<I", len(found)) + np.array([x for x, _ in found], np.uint32).tobytes() + np.array([len(x) for _, x in found], np.int32).tobytes() + np.array([y for _, x in found for y in x], np.int64).tobytes()
                    yield k, c, zstandard.ZstdCompressor(level=3).compress(data)

        def groups():
            now, rows = None, []
            for batch in batches:
                for k, c, s, x in zip(*[col.to_pylist() for col in batch.columns], strict=True):
                    if s != now and rows:
                        yield rows
                        rows = []
                    now = s
                    rows.append((k, c, x))
            if rows:
                yield rows

        for rows in groups():
            out = list(solved(rows))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], names=["file", "chunk", "data"])

    sent = map_batches(tasks, send, "file int, chunk int, shard int, data binary")
    # Up to SHARD_TASKS shards a task for each, and of more each takes several in turn; then one for each file.
    if shards <= SHARD_TASKS:
        dealt = sent.repartitionById(shards, "shard")
    else:
        dealt = sent.repartitionById(SHARD_TASKS, F.col("shard") % SHARD_TASKS).sortWithinPartitions("shard")
    met = map_batches(dealt, match, "file int, chunk int, data binary")
    met.repartitionById(max(1, len(files)), "file").write.partitionBy("file").option("compression", "none").parquet(answers)

    def cut(batches):
        import pyarrow.parquet as pq
        import zstandard

        fs, _ = open_fs(work)
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_text", pa.string())])
        for batch in batches:
            for k in batch.column(0).to_pylist():
                told: dict[int, list[bytes]] = {}
                for name, _ in _answer_files(answers, k):
                    with fs.open_input_file(name) as f:
                        for part in pq.ParquetFile(f).iter_batches(columns=["chunk", "data"]):
                            for c, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                                told.setdefault(c, []).append(x)
                for c, chunk in enumerate(_chunks(fs, files[k][0], hot, window, gram, shards, chunk_words)):
                    answers_to = [np.zeros(0, np.uint32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
                    for x in told.pop(c, []):
                        data = zstandard.ZstdDecompressor().decompress(x)
                        n = struct.unpack_from("<I", data)[0]
                        for out, kind, size, at in zip(answers_to, (np.uint32, np.int32, np.int64), (n, n, -1), (4, 4 + 4 * n, 4 + 8 * n), strict=True):
                            out.append(np.frombuffer(data, kind, size, at))
                    out = list(chunk.kept(*map(np.concatenate, answers_to), window))
                    for a in range(0, len(out), 500):
                        part = out[a : a + 500]
                        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in part], t.type) for i, t in enumerate(schema)], schema=schema)

    return map_batches(tasks, cut, "doc_id long, n_words long, removed array<struct<start: int, end: int>>, kept_text string")


def _answer_files(path: str, k: int) -> list[tuple[str, int]]:
    from pyarrow import fs as pfs

    fs, root = open_fs(path)
    return _files(f"{path}/file={k}") if fs.get_file_info(f"{root}/file={k}").type == pfs.FileType.Directory else []


# -- a bounded reference, broadcast ---------------------------------------------------------------


def reference_shards(reference: DataFrame, shard_words: int):
    """Lists of texts of at most ``shard_words`` words together, or one text."""
    shard, size = [], 0
    for (text,) in reference.select("text").where(F.col("text").isNotNull()).distinct().toLocalIterator():
        words = text.encode("utf-8", "replace").split()
        if words and shard and size + len(words) > shard_words:
            yield shard
            shard, size = [], 0
        if words:
            shard.append(b" ".join(words))
            size += len(words)
    if shard:
        yield shard


def remove_known(docs: DataFrame, reference: DataFrame, *, window: int = WINDOW, shard_words: int = 200_000) -> DataFrame:
    """As ``remove_repeats``, for passages that a reference holds: doc_id, n_words, removed, kept_text.

    The reference is cut into shards of bounded size; the suffix automaton of each is broadcast (as
    its texts, from which a worker builds it once) and all documents stream through it, one shard
    after another, each pass adding to the windows found.  A text without words is no reference.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", F.array().cast("array<int>").alias("at"))
    for shard in reference_shards(reference, shard_words):
        rows = _known(rows, spark.sparkContext.broadcast(shard), window)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_text", pa.string())])

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, text, at in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                words, spans, kept, done = (text or "").encode("utf-8", "replace").split(), [], [], 0
                for a in at:
                    if spans and a <= spans[-1]["end"]:
                        spans[-1]["end"] = a + window
                    else:
                        spans.append({"start": a, "end": a + window})
                for s in spans:
                    kept += words[done : s["start"]]
                    done = s["end"]
                out.append((doc_id, len(words), spans, b" ".join(kept + words[done:]).decode()))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t.type) for i, t in enumerate(schema)], schema=schema)

    return map_batches(rows, cut, "doc_id long, n_words long, removed array<struct<start: int, end: int>>, kept_text string")


def _known(rows: DataFrame, shared, window: int) -> DataFrame:
    def build() -> SuffixAutomaton:
        automaton = SuffixAutomaton()
        for text in shared.value:
            automaton.add(text.split(b" "), True)
        return automaton

    def run(batches):
        automaton = Held.of((SuffixAutomaton, hash(tuple(shared.value))), build)
        for batch in batches:
            found = []
            for text, at in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                seen = automaton.first_owners((text or "").encode("utf-8", "replace").split(), window)
                found.append(sorted({*at, *[i for i, x in enumerate(seen) if x]}))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], names=["doc_id", "text", "at"])

    return map_batches(rows, run, "doc_id long, text string, at array<int>")
