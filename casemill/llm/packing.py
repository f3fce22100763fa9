"""Best-fit packing of token sequences, by patterns that are fitted to the histogram of lengths.

1. Each document becomes ids and an end id; one longer than ``size`` is cut into pieces of ``size``,
   the first of which may be shorter.  Tasks number their pieces of each length.
2. The histogram of lengths (at most ``size`` rows) goes to the driver.  Lengths fall into classes;
   all patterns of up to ``most`` classes that fill a sequence are enumerated, and non-negative
   least squares finds how often each is to be used.  The repeats are rounded down and turned into
   patterns of exact lengths, the last member of each being the best fit for what is left.
3. What remains is packed best-fit decreasing, by counts of lengths, also into the gaps left in 2.
   All this works on counts, with steps bounded by ``size`` and the patterns, whatever the corpus.
4. The result is a table of intervals: the pieces of a length that are numbered from a to b go to
   consecutive sequences at one offset.  It is bounded as well, and broadcast.  The number of a
   piece among all of its length is its number in its task plus the counts of the tasks before.

Edge cases: a null or empty text is the end id alone; repeated rows are packed each; a null doc_id
is kept; an empty table gives no pieces; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casemill.llm.common import map_batches, written
from casemill.llm.tokens import Encoder

PIECES = "task int, number long, doc_id long, piece int, start long, length int, ids binary, ids_crc32 long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % size or size
    return [(0, min(n, first)), *[(a, size) for a in range(first, n, size)]] if n > size else [(0, n)]


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    end = struct.pack("<I", end_id)
    arrow = pa.schema([("task", pa.int32()), ("number", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids", pa.binary()), ("ids_crc32", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        encoder, task, counts = Encoder.of(tokenizer), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            out, held = [], 0
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode_all(batch.column(1)), strict=True):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, size)):
                    part = ids[4 * start : 4 * (start + n)]
                    out.append((task, counts[n], key, k, start, n, part, zlib.crc32(part)))
                    counts[n] += 1
                    held += len(part)
                if held > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)
        encoder.rest()

    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), run, PIECES)


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    w = a.T @ (b - a @ x)
    for _ in range(3 * a.shape[0]):
        if passive.all() or w[~passive].max(initial=-1) <= 1e-7 * max(1.0, np.abs(b).max()):
            break
        passive[np.argmax(np.where(passive, -np.inf, w))] = True
        while True:
            s = np.zeros(n)
            s[passive] = np.linalg.lstsq(a[:, passive], b, rcond=None)[0]
            low = passive & (s <= 1e-9)
            if not low.any():
                break
            step = np.min(x[low] / np.maximum(x[low] - s[low], 1e-12))
            x = np.maximum(x + step * (s - x), 0)
            passive &= x > 1e-9
        x = s
        w = a.T @ (b - a @ x)
    return x


def class_patterns(classes: int, most: int) -> list[tuple[int, ...]]:
    """Decreasing tuples of up to ``most`` classes whose middles fill a sequence.

    Class k of ``classes`` holds lengths around (k - 1/2) / ``classes`` of a sequence.
    """
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], rest: int) -> None:  # in half classes
        if head and 0 <= rest <= 1:
            out.append(head)
        if len(head) < most:
            for k in range(1, (head[-1] if head else classes) + 1):
                if 2 * k - 1 <= rest:
                    grow((*head, k), rest - 2 * k + 1)

    grow((), 2 * classes)
    return out


#: (classes, most members of a pattern, room that a pattern may leave open) that plan() tries.
SETTINGS = ((32, 4, 64), (32, 4, 4), (32, 4, 0), (64, 3, 32), (64, 3, 4), (64, 3, 0), (128, 2, 4))


def plan(histogram: dict[int, int], size: int, settings=SETTINGS) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats): packs a histogram of lengths up to ``size`` into sequences of ``size``.

    Of the plans for the given settings, the one with the fewest sequences.
    """
    return min((fitted(histogram, size, *x) for x in settings), key=lambda r: sum(n for _, n in r))


def fitted(histogram: dict[int, int], size: int, classes: int, most: int, slack: int) -> list[tuple[tuple[int, ...], int]]:
    left = np.zeros(size + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    done: list[tuple[tuple[int, ...], int]] = [((size,), int(left[size]))] if left[size] else []
    left[size] = 0
    # Bins still open: by the room left, a list of (lengths, how many such bins).
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(lengths: tuple[int, ...], count: int) -> None:
        room = size - sum(lengths)
        if room == 0:
            done.append((lengths, count))
        else:
            open_bins.setdefault(room, []).append((lengths, count))

    width = -(-size // classes)
    of = (np.arange(size + 1) + width - 1) // width
    have = np.bincount(of, weights=left, minlength=classes + 1)[1 : classes + 1]
    patterns = class_patterns(classes, most)
    if have.sum() and patterns:
        matrix = np.zeros((classes, len(patterns)))
        for j, p in enumerate(patterns):
            for k in p:
                matrix[k - 1, j] += 1
        scale = max(1.0, have.max())
        repeats = np.floor(nnls(matrix, have / scale) * scale + 1e-9).astype(np.int64)
        for j in np.argsort(-repeats, kind="stable"):
            todo = int(repeats[j])
            while todo > 0:
                lengths: list[int] = []
                for at, k in enumerate(patterns[j]):
                    room = size - sum(lengths)
                    taken = np.zeros(size + 1, np.int64)
                    for x in lengths:
                        taken[x] += 1
                    last = at == len(patterns[j]) - 1
                    low, high = (k - 1) * width + 1, min(k * width, room)
                    if last:  # the best fit: the longest that there is, within a class of the room left
                        low, high = max(1, room - slack), room
                    free = np.flatnonzero(left[low : high + 1] > taken[low : high + 1])
                    if not len(free):
                        lengths = []
                        break
                    lengths.append(low + int(free[-1]))
                if not lengths:
                    break
                uses = {x: lengths.count(x) for x in lengths}
                n = min([todo, *[int(left[x]) // c for x, c in uses.items()]])
                for x, c in uses.items():
                    left[x] -= n * c
                put(tuple(lengths), n)
                todo -= n
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            room = next((r for r in range(length, size) if open_bins.get(r)), None)
            if room is None:
                fit = size // length
                if count >= fit:
                    put((length,) * fit, count // fit)
                    count %= fit
                else:
                    put((length,) * count, 1)
                    count = 0
                continue
            lengths, n = open_bins[room].pop()
            each = min(room // length, max(1, count // n)) if count >= n else 1
            used = min(n, count // each)
            if n > used:
                open_bins[room].append((lengths, n - used))
            put(lengths + (length,) * each, used)
            count -= used * each
    return done + [x for rest in open_bins.values() for x in rest]


def intervals(recipes: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, low, high, first sequence, offset): where the pieces of a length numbered low to high - 1 go."""
    rank: dict[int, int] = {}
    out, first = [], 0
    for lengths, repeats in recipes:
        offset = 0
        for x in lengths:
            low = rank.get(x, 0)
            out.append((x, low, low + repeats, first, offset))
            rank[x] = low + repeats
            offset += x
        first += repeats
    return out


def pack(docs: DataFrame, *, tokenizer: str, size: int = 2048, end_id: int = 0, settings=SETTINGS) -> DataFrame:
    """doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset: a row for each piece."""
    spark = docs.sparkSession
    pieces = written(token_pieces(docs, tokenizer, size, end_id), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    spots = intervals(plan(histogram, size, settings))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("task").alias("_task"), F.col("length").alias("_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = pieces.join(offsets, (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length")))
    ranked = ranked.withColumn("_rank", F.col("number") + F.col("_before"))
    table = spark.createDataFrame(spots, "_l int, _low long, _high long, _first long, offset long")
    placed = ranked.join(F.broadcast(table), (F.col("length") == F.col("_l")) & (F.col("_rank") >= F.col("_low")) & (F.col("_rank") < F.col("_high")))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", (F.col("_first") + F.col("_rank") - F.col("_low")).alias("sequence_id"), "offset")
