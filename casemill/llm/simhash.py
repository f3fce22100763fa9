"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints.  A text (A-Z lower-cased) is cut into words, and its ``shingle``-word sequences are
hashed by XXH64; a bit of the 64-bit fingerprint is 1 if it is set in over half of the hashes.

Links.  Two fingerprints link at ``distance`` or fewer differing bits.  Distinct fingerprints are
dealt into shards: of ``distance + 1`` blocks of bits two linked ones agree in at least one, so each
fingerprint goes to one shard for each block (with more fingerprints, for each pair of more
blocks).  A shard sorts its fingerprints by Gray rank, so that neighbours share most bits, and
builds a hierarchy: runs of ``FAN`` entries form a node that holds the bits on which all below it
agree, less those that the nodes above hold already.  A search goes down with the differences
that it has met so far and drops a whole group once they exceed the distance.  A shard of more than
``CHUNK`` fingerprints is dealt again, by ``distance + 1`` blocks of the bits that its key doesn't hold; one
that is still too large, since its fingerprints crowd around a few patterns, is cut into chunks, and
pairs of chunks are searched as groups of their own.  Shards report a spanning forest of their
links, not all pairs.

Components.  The forests of all shards are joined by star steps; all is exact.

Edge cases: a null or empty text has fingerprint zero and links like any other; a text of fewer
words than a shingle is one sequence; repeated rows each get a row; an empty table gives none;
rows that share a doc_id but not their text are judged by their own texts; other columns are ignored
(``near_groups``) or kept (``drop_near_copies``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casemill.llm.common import Held, hot_join, map_batches, maybe_among, written
from casemill.llm.components import star_forest

SEED, FAN = 42, 16
CHUNK = 2048
UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    import xxhash

    parts = (text or "").encode("utf-8", "replace").translate(UPPER_TO_LOWER).split()
    n = len(parts)
    if not n:
        return 0
    if n <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    line = b" ".join(parts)
    ends = (np.cumsum(np.fromiter(map(len, parts), np.int64, n) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[: n - shingle]]]
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=True)]), np.uint8)
    m = n - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, m, 1 << 16):
        ones += np.unpackbits(h[8 * at : 8 * (at + (1 << 16))].reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > m).tobytes(), "big")


def fingerprints(docs: DataFrame, *more: str, shingle: int = 4) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) and the columns ``more``."""
    thin = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", *more)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), *[thin.schema[c] for c in more]])

    def run(batches):
        Held.drop()
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], names=schema.names)

    return map_batches(thin, run, schema)


# -- the index ---------------------------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each pattern in Gray order."""
    x = x.copy()
    for k in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(k)
    return x


class GrayIndex:
    """Hierarchy over fingerprints in Gray order; ``search`` finds all within a distance."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps), kind="stable")
        self.fps = fps[self.order]
        ands, ors = self.fps, self.fps
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        levels = [(np.full(len(fps), full), self.fps)]  # (bits that a node's entries share, the pattern), leaves first
        while len(ands) > FAN:
            cuts = np.arange(0, len(ands), FAN)
            ands, ors = np.bitwise_and.reduceat(ands, cuts), np.bitwise_or.reduceat(ors, cuts)
            levels.append((~(ands ^ ors), ands))
        # Of its own each node keeps only the bits that its parent doesn't hold.
        self.levels = [(mask & ~above[0][np.arange(len(mask)) // FAN] if above else mask, pattern) for (mask, pattern), above in zip(levels, [*levels[1:], None], strict=True)]

    def search(self, queries: np.ndarray, distance: int, block: int = 1 << 20):
        """Yields (numbers of queries, numbers of entries in Gray order) of all that are near."""
        top = len(self.levels) - 1
        roots = len(self.levels[top][0])
        step = max(1, block // max(1, roots))
        for at in range(0, len(queries), step):
            own = np.arange(at, min(at + step, len(queries)))
            todo = [(top, np.repeat(own, roots), np.tile(np.arange(roots), len(own)), np.zeros(len(own) * roots, np.uint8))]
            while todo:
                level, q, node, met = todo.pop()
                mask, pattern = self.levels[level]
                met = met + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
                near = met <= distance
                q, node, met = q[near], node[near], met[near]
                if not len(q):
                    continue
                if level == 0:
                    yield q, node
                    continue
                below = len(self.levels[level - 1][0])
                for a in range(0, len(q), block // FAN):
                    b = slice(a, a + block // FAN)
                    child = (node[b, None] * FAN + np.arange(FAN)).ravel()
                    real = child < below
                    todo.append((level - 1, np.repeat(q[b], FAN)[real], child[real], np.repeat(met[b], FAN)[real]))


class Forest:
    """Union by least label over 0..n-1, a block of links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def shard_links(fps: np.ndarray, ids: np.ndarray, left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between entries marked ``left`` and those marked ``right``."""
    order = np.argsort(ids, kind="stable")  # so that the least label is the least id
    fps, ids, left, right = fps[order], ids[order], left[order], right[order]
    held, asked = np.flatnonzero(left), np.flatnonzero(right)
    forest = Forest(len(ids))
    if len(held) and len(asked):
        index = GrayIndex(fps[held])
        place = held[index.order]
        for q, e in index.search(fps[asked], distance):
            forest.add(asked[q], place[e])
    child = np.flatnonzero(forest.root != np.arange(len(ids)))
    return ids[child], ids[forest.root[child]]


# -- shards --------------------------------------------------------------------------------------


def block_masks(distance: int, count: int, agree: int) -> list[int]:
    """Masks of the bits that make a shard's key: all choices of ``agree`` of ``count`` blocks."""
    from itertools import combinations

    edges = [64 * i // count for i in range(count + 1)]
    block = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(count)]
    return [sum(block[i] for i in x) for x in combinations(range(count), agree)]


def masks_for(n: int, distance: int) -> list[int]:
    """Keys long enough that a shard of evenly spread fingerprints holds a few thousand."""
    agree = 1
    while n >> (64 * agree // (distance + agree)) > 4096 and agree < 5:
        agree += 1
    return block_masks(distance, distance + agree, agree)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def sub_masks(mask: int, parts: int) -> list[int]:
    """The bits that ``mask`` lacks, in ``parts`` blocks."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in free[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _sized(rows: DataFrame, chunk: int) -> DataFrame:
    """``rows`` with _n, the rows of their shard, where it holds more than ``chunk``."""
    large = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > chunk).select(F.col("t").alias("_t"), F.col("key").alias("_key"), "_n")
    return rows.join(large, (F.col("t") == F.col("_t")) & (F.col("key") == F.col("_key")), "left").drop("_t", "_key")


def links(nodes: DataFrame, *, distance: int = 4, chunk: int = CHUNK) -> DataFrame:
    """``nodes`` (fp, id; distinct fp) -> u, v: links whose components are those of all links."""
    masks = masks_for(nodes.count(), distance)
    key = lambda t, m: F.struct(t.alias("t"), F.col("fp").bitwiseAND(m).alias("key"))
    rows = _sized(nodes.select("fp", "id", F.inline(F.array(*[key(F.lit(i), F.lit(_signed(m))) for i, m in enumerate(masks)]))), chunk)
    # A large shard again, by one more block; linked fingerprints agree in one of these as well.
    finer = F.array(*[F.array(*[F.lit(_signed(m | x)) for x in sub_masks(m, distance + 1)]) for m in masks])
    again = [key(len(masks) + F.col("t") * (distance + 1) + j, F.get(F.get(finer, F.col("t")), F.lit(j))) for j in range(distance + 1)]
    small = rows.where("_n is null").select("fp", "id", "t", "key", F.lit(None).cast("long").alias("_n"))
    rows = small.unionByName(_sized(rows.where("_n is not null").select("fp", "id", F.inline(F.array(*again))), chunk))
    # Chunk i meets chunk j in group (min, max), and is "left" in its own and those where it is the lower.
    c = F.coalesce(F.ceil(F.col("_n") / chunk), F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), c).cast("int")
    pair = lambda j: F.struct(F.least("_mine", j).alias("i"), F.greatest("_mine", j).alias("j"), (F.col("_mine") <= j).alias("held"), (F.col("_mine") >= j).alias("asked"))
    rows = rows.withColumn("_mine", mine).withColumn("_cc", c.cast("int")).select("fp", "id", "t", "key", F.inline(F.transform(F.sequence(F.lit(0), F.col("_cc") - 1), pair)))
    dealt = rows.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")

    def run(batches):
        held: list[pa.RecordBatch] = []

        def solved(table: pa.Table):
            fps, ids = table["fp"].to_numpy().view(np.uint64), table["id"].to_numpy()
            return shard_links(fps, ids, table["held"].to_numpy(), table["asked"].to_numpy(), distance)

        def groups():
            rest = None
            for batch in batches:
                part = pa.Table.from_batches([batch])
                rest = part if rest is None else pa.concat_tables([rest, part])
                at = boundaries(rest)
                for a, b in zip(at[:-2], at[1:-1], strict=True):
                    yield rest.slice(a, b - a)
                rest = rest.slice(at[-2])
            if rest is not None and len(rest):
                yield rest

        def boundaries(table: pa.Table) -> list[int]:
            new = np.zeros(len(table), bool)
            new[0] = True
            for k in ("t", "key", "i", "j"):
                v = table[k].to_numpy()
                new[1:] |= v[1:] != v[:-1]
            return [*np.flatnonzero(new).tolist(), len(table)]

        out_u, out_v, n = [], [], 0
        for group in groups():
            if len(group) < 2:
                continue
            u, v = solved(group)
            if len(u):
                out_u.append(u)
                out_v.append(v)
                n += len(u)
            if n > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])
                out_u, out_v, n = [], [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], names=["u", "v"])

    return map_batches(dealt, run, "u long, v long")


def _grouped(docs: DataFrame, shingle: int, distance: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp and ``more`` of each row; fp, root and component_id of each fingerprint that a doc_id has)."""
    marked = written(fingerprints(docs, *more, shingle=shingle), "fingerprints")
    nodes = written(marked.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("id")), "classes")
    roots = star_forest(links(by_id(nodes), distance=distance))
    named = by_id(nodes).join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("fp", F.coalesce("root", "id").alias("root"), "_doc")
    least = named.groupBy("root").agg(F.min("_doc").alias("component_id"))
    return marked, hot_join(named.drop("_doc"), least, ["root"], ["fp"])


def by_id(nodes: DataFrame) -> DataFrame:
    """``nodes`` (fp, id) by the fingerprint itself, since two of them may have the same least doc_id."""
    return nodes.select("fp", F.col("fp").alias("id"), F.col("id").alias("_doc"))


def near_groups(docs: DataFrame, *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fp and component_id: the smallest doc_id that links of the fingerprints reach.

    Rows with a null doc_id take part in no link and get a null component_id.
    """
    marked, named = _grouped(docs, shingle, distance)
    out = hot_join(marked, named.drop("root"), ["fp"], ["doc_id"])
    return out.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, *, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents with one of each group left, all columns kept.

    That of the smallest doc_id stays; of several rows of that doc_id in the group the one whose text
    has the least hash, and of repeated rows of that text the least by its other columns.  Rows with
    a null doc_id all stay.
    """
    own = docs.columns
    packed = docs.select(F.struct(*own).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    marked, named = _grouped(packed, shingle, distance, "_h")
    # Of each text of each doc_id: how many rows, its group, and whether it is the one that stays.
    texts = marked.where(F.col("doc_id").isNotNull()).groupBy("fp", "doc_id", "_h").agg(F.count(F.lit(1)).alias("_n"))
    texts = written(hot_join(texts, named.drop("component_id"), ["fp"], ["doc_id", "_h"]), "texts")
    first = texts.groupBy("root").agg(F.min(F.struct("doc_id", "_h")).alias("_first"))
    judged = hot_join(texts, first, ["root"], ["doc_id", "_h"]).select("doc_id", "_h", (F.struct("doc_id", "_h") == F.col("_first")).alias("_stay"), "_n")
    touched = written(judged.where(~F.col("_stay") | (F.col("_n") > 1)).drop("_n"), "touched")
    # Only rows that may go, or are there more than once, are shuffled; the others stay where they are read.
    key = F.xxhash64("doc_id", "_h")
    rows, maybe = packed.drop("text"), F.coalesce(maybe_among(touched, key, key), F.lit(False)) & F.col("doc_id").isNotNull()
    asked = hot_join(rows.where(maybe), touched, ["doc_id", "_h"], ["doc_id"])
    order = F.struct(*[F.col("_row")[c] for c in own if orderable(docs.schema[c].dataType)])
    once = asked.where("_stay").groupBy("doc_id", "_h").agg(F.min_by("_row", order).alias("_row"))
    parts = [rows.where(~maybe), asked.where("_stay is null"), once]
    return parts[0].select("_row").unionByName(parts[1].select("_row")).unionByName(parts[2].select("_row")).select("_row.*")


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    return orderable(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))
