"""Benchmark decontamination with one Aho-Corasick automaton.

Texts are lower-cased (A-Z only) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a pattern
is ``window`` consecutive words of a benchmark item, or the whole item where it has fewer.  Each
document is scanned once; every word inside an occurrence of a pattern is hit.

The automaton's letters are the digits of word numbers, a few for each word, since its states search
their followers one by one.  It doesn't spell each window out: an item of ``window`` words
or more is cut into blocks of half a window, and any window of it holds a whole block.  Where the
automaton meets a block in a document, the words beside it are compared with those of the item, and
a run of ``window`` or more equal words is hit.  So there are two or three states for each word of the
benchmark instead of one for each letter of each window, and the scan still goes over a text once.

The items are broadcast as they are, at most ``shard_chars`` characters of them, and each worker builds
the automaton once (MEMORY below).  A larger benchmark is scanned in several passes, one after the
other, each written before the next begins; so a worker holds one automaton at a time.

Edge cases: a null or empty text has no words and no hits; an item without words has no pattern;
an item with a null item_id is left out with all its patterns, so a text that only it holds stays clean;
several items may share a pattern and all count; repeated document rows each get a row; other
columns of the input are ignored (``contamination``) or kept (``drop_contaminated``).
"""

from __future__ import annotations

import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.llm.common import Held, map_batches, written

#: bytes -> bytes: A-Z to a-z, digits, a-z and all non-ASCII bytes as they are, the rest to blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
#: Measured: 4 M characters of items (0.7 M words, no block twice) take 0.2 GB in a worker, 16 M 0.6 GB.
SHARD_CHARS = 16_000_000

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_words", T.ArrayType(T.IntegerType())),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
])


def fold_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def word_codes(words) -> tuple[dict[bytes, str], int]:
    """A code of equal length for each word: the digits of its number to the base 64, each place with letters of its own."""
    known = dict.fromkeys(words)
    digits = max(1, -(-(len(known) - 1).bit_length() // 6)) if known else 1
    letters = [[chr(1 + 64 * j + d) for d in range(64)] for j in range(digits)]
    for n, w in enumerate(known):
        known[w] = "".join([letters[j][n >> 6 * j & 63] for j in range(digits)])
    return known, digits


class Scanner:
    """The automaton over the blocks of some items, and the scan of a document."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        import ahocorasick

        self.window, self.block = window, (window + 1) // 2
        self.codes, self.digits = word_codes(w for _, words in items for w in words)
        whole: dict[tuple, list[str]] = {}  # short items: the whole sequence -> items
        blocks: dict[tuple, dict[tuple, list[str]]] = {}  # a block -> (words before it, after it) -> items
        beside = window - self.block
        for item, words in items:
            w = tuple(map(self.codes.__getitem__, words))
            if len(w) < window:
                whole.setdefault(w, []).append(item)
                continue
            for at in range(0, len(w) - self.block + 1, self.block):
                end = at + self.block
                around = (w[max(0, at - beside) : at][::-1], w[end : end + beside])
                owners = blocks.setdefault(w[at:end], {}).setdefault(around, [])
                if item not in owners[-1:]:
                    owners.append(item)
        self.automaton = ahocorasick.Automaton()
        for key in whole.keys() | blocks.keys():
            self.automaton.add_word("".join(key), (len(key), whole.get(key, ()), self.places(blocks.get(key, {}))))
        self.empty = not len(self.automaton)
        if not self.empty:
            self.automaton.make_automaton()

    @staticmethod
    def places(arounds: dict[tuple, list[str]]):
        """The places of a block, by the word before and by the word after it, if it has many."""
        every = list(arounds.items())
        if len(every) <= 8:
            return every, None, None
        before: dict[str, list] = {}
        after: dict[str, list] = {}
        for x in every:
            (left, right), _ = x
            if left:
                before.setdefault(left[0], []).append(x)
            if right:
                after.setdefault(right[0], []).append(x)
        return every, before, after

    @classmethod
    def of(cls, name: str, items: list[tuple[str, list[bytes]]], window: int) -> Scanner:
        return Held.of((cls, window, name), lambda: cls(items, window))

    def near(self, places, words: list[str], a: int, b: int):
        """The places of a block whose neighbours may fit the words beside (a, b)."""
        every, before, after = places
        if before is None or self.block >= self.window:
            return every
        left = before.get(words[a - 1], ()) if a else ()
        right = after.get(words[b], ()) if b < len(words) else ()
        return [*left, *(x for x in right if not (x[0][0] and a and x[0][0][0] == words[a - 1]))]

    def scan(self, text: str | None) -> dict:
        """n_words, the hit words (by number), their items and the hit spans of the original."""
        found = fold_words(text)
        out = {"n_words": len(found), "hit_words": [], "hit_items": [], "hit_spans": []}
        if not found or self.empty:
            return out
        get, unknown = self.codes.get, "\0" * self.digits
        words = [get(w, unknown) for w in found]
        hit: set[int] = set()
        items: set[str] = set()
        for last, (k, whole, places) in self.automaton.iter("".join(words)):
            b = (last + 1) // self.digits
            a = b - k
            if whole:
                hit.update(range(a, b))
                items.update(whole)
            for (left, right), owners in self.near(places, words, a, b) if places[0] else ():
                x, y = a, b
                for w in left:
                    if not x or words[x - 1] != w:
                        break
                    x -= 1
                for w in right:
                    if y == len(words) or words[y] != w:
                        break
                    y += 1
                if y - x >= self.window:
                    hit.update(range(x, y))
                    items.update(owners)
        if hit:
            found = sorted(hit)
            places = [m.span() for m in WORD.finditer(text)]
            spans: list[list[int]] = []
            last = -2
            for i in found:
                if i == last + 1:
                    spans[-1][1] = places[i][1]
                else:
                    spans.append(list(places[i]))
                last = i
            out |= {"hit_words": found, "hit_items": sorted(items), "hit_spans": spans}
        return out


def item_shards(benchmark: DataFrame, shard_chars: int = SHARD_CHARS):
    """Lists of (item_id, words as bytes), each of at most ``shard_chars`` characters or one item."""
    shard, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").where(F.col("item_id").isNotNull()).distinct().toLocalIterator():
        words = fold_words(row[1])
        n = sum(map(len, words)) + len(words)
        if words:
            if shard and size + n > shard_chars:
                yield shard
                shard, size = [], 0
            shard.append((row[0], words))
            size += n
    if shard:
        yield shard


def _scanned(docs: DataFrame, shared, window: int) -> DataFrame:
    """``docs`` with the columns of HITS, what they had before (of other shards) included."""
    names = [c for c in docs.columns if c not in HITS.names]
    schema = T.StructType([*[docs.schema[c] for c in names], *HITS.fields])
    before = [c for c in HITS.names[1:] if c in docs.columns]
    name = uuid.uuid4().hex

    def run(batches):
        scanner = Scanner.of(name, shared.value, window)
        types = pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.list_(pa.int32()))
        for batch in batches:
            found = [scanner.scan(t) for t in batch.column("text").to_pylist()]
            for c in before:
                for x, old in zip(found, batch.column(c).to_pylist(), strict=True):
                    if old:
                        x[c] = sorted({*map(tuple, old), *map(tuple, x[c])}) if c == "hit_spans" else sorted({*old, *x[c]})
            cols = [pa.array([x["n_words"] for x in found], pa.int64())]
            cols += [pa.array([x[k] for x in found], t) for k, t in zip(HITS.names[1:], types, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *cols], names=[*names, *HITS.names])

    return map_batches(docs, run, schema)


def _hits(rows: DataFrame, benchmark: DataFrame, window: int, shard_chars: int) -> DataFrame:
    sc, passes = rows.sparkSession.sparkContext, 0
    for part in item_shards(benchmark, shard_chars):
        rows = _scanned(written(rows, "scanned") if passes else rows, sc.broadcast(part), window)
        passes += 1
    return rows if passes else _scanned(rows, sc.broadcast([]), window)


def _contaminated(share: float):
    n_hit = F.size("hit_words")
    return (n_hit > 0) & (n_hit >= share * F.col("n_words"))


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, share: float = 0.05, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """doc_id, n_words, hit_words, hit_items, hit_spans (of the original text), contaminated.

    A document is contaminated when at least ``share`` of its words, and at least one, are hit.
    """
    out = _hits(docs.select("doc_id", "text"), benchmark, window, shard_chars).drop("text")
    return out.withColumn("contaminated", _contaminated(share))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 13, share: float = 0.05, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return _hits(rows, benchmark, window, shard_chars).where(~_contaminated(share)).select("_row.*")
