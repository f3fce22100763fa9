import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from casemill.llm import components, simhash
from tests.llm.helpers import DOCS, documents, frame, words


def fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, ids, distance=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return [least[find(k)] for k in range(len(fps))]


def test_against_plain(spark):
    rows = documents(n=90)
    ids = [x[0] for x in rows]
    fps = [fingerprint(x[1]) for x in rows]
    got = sorted((x.doc_id, x.fp % 2**64, x.component_id) for x in simhash.near_groups(frame(spark, rows)).collect())
    want = sorted(zip(ids, fps, groups(fps, ids), strict=True))
    assert got == want and len({x[2] for x in want}) < len(want)
    left = simhash.drop_near_copies(frame(spark, rows)).collect()
    assert sorted(x.doc_id for x in left) == sorted({x[2] for x in want})


def test_long_text_and_case():
    t = "Ab cD é " * 40000
    assert simhash.fingerprint(t) == fingerprint(t)
    assert simhash.fingerprint("ONE two") == simhash.fingerprint("one\tTWO")


@settings(deadline=None, max_examples=40)
@given(st.integers(0, 2**32 - 1), st.integers(1, 300), st.integers(0, 6))
def test_index_finds_all(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 4, dtype=np.uint64) * np.uint64(2)
    fps = centres[rng.integers(0, 4, n)]
    for _ in range(5):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    index = simhash.GrayIndex(fps)
    got = {(a, b) for q, e in index.search(fps, d, block=1000) for a, b in zip(q.tolist(), index.order[e].tolist(), strict=True)}
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= d
    assert got == set(zip(*[x.tolist() for x in np.nonzero(near)], strict=True))


def test_links_in_chunks_and_wider_keys(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base, base ^ np.uint64(0b1011), np.array([7] * 400, np.uint64) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 400).astype(np.uint64))])
    fps = np.unique(fps)
    ids = rng.permutation(len(fps)).tolist()
    nodes = spark.createDataFrame([(int(f) - (1 << 64 if int(f) >> 63 else 0), i) for f, i in zip(fps, ids, strict=True)], "fp long, id long")
    want = groups([int(x) for x in fps], ids)
    for agree in (1, 2):  # the shards of the crowd are dealt again, and then cut into chunks
        monkeypatch.setattr(simhash, "masks_for", lambda n, d, a=agree: simhash.block_masks(d, d + a, a))
        roots = {x.node: x.root for x in components.star_forest(simhash.links(nodes, distance=4, chunk=50)).collect()}
        assert [roots.get(i, i) for i in ids] == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 150), (150, 120), (7, 7), (200, 300), (300, 200)]
    roots = {x.node: x.root for x in components.star_forest(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, 120: 100, 150: 100, 300: 200}


def test_empty_and_nulls(spark):
    assert simhash.near_groups(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c", "en", "s", 1), (4, "a b c", "en", "s", 1), (4, "a b c", "en", "s", 1)]
    assert sorted(map(str, [x.component_id for x in simhash.near_groups(frame(spark, rows)).collect()])) == ["4", "4", "None"]
    docs = frame(spark, rows).selectExpr("*", "1 as component_id", "2 as fp")
    out = simhash.drop_near_copies(docs)
    assert out.columns == docs.columns and out.count() == 2


def test_rows_of_one_id_lose_nothing(spark):
    """Of three texts that share ids two by two, each group keeps one row, by the stated order."""
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "red green blue yellow black white")
    rows = [(5, a, "en", "s", 1), (5, b, "en", "s", 1), (6, b, "en", "s", 1), (7, c, "en", "z", 3), (7, c, "en", "b", 4), (7, c, "en", "b", 2), (None, a, "en", "s", 1), (None, a, "en", "s", 1)]
    docs = frame(spark, rows).selectExpr("*", "'x' as _h", "map(1, 2) as m")
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(((x.doc_id, x.text, x.source, x.n_chars, x._h, x.m) for x in got.collect()), key=str) == sorted([(5, a, "s", 1, "x", {1: 2}), (5, b, "s", 1, "x", {1: 2}), (7, c, "b", 2, "x", {1: 2}), (None, a, "s", 1, "x", {1: 2}), (None, a, "s", 1, "x", {1: 2})], key=str)
    assert sorted((x.component_id for x in simhash.near_groups(docs).where("doc_id is not null").collect())) == [5, 5, 5, 7, 7, 7]


def test_a_crowded_shard_isnt_sent_in_pairs_of_chunks(spark):
    """Fingerprints that share the bits of a key but little else are dealt by further bits."""
    rng = np.random.default_rng(3)
    fps = np.unique(rng.integers(0, 2**51, 3000, dtype=np.uint64))  # all equal in the 13 highest bits
    nodes = spark.createDataFrame([(int(f), i) for i, f in enumerate(fps)], "fp long, id long")
    plan = simhash.links(nodes, distance=4, chunk=100)
    sent = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().split("\n") if "MapInArrow" in x]
    assert sent
    masks = simhash.masks_for(3000, 4)
    assert len(masks) == 5 and all(bin(m | x).count("1") > bin(m).count("1") and not m & x for m in masks for x in simhash.sub_masks(m, 5))
    assert all(sum(simhash.sub_masks(m, 5)) == (1 << 64) - 1 - m for m in masks)
    near = {(int(u), int(v)) for u, v in plan.collect()}
    got = groups([int(f) for f in fps], list(range(len(fps))))
    assert {u for u, v in near} == {i for i, g in enumerate(got) if g != i}
