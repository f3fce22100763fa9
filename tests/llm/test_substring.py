import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from casemill.llm import substring
from tests.llm.helpers import DOCS, documents, frame, words


def plain(rows, window=13):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for a in range(len(w) - window + 1):
            k = tuple(w[a : a + window])
            if i is not None and i < first.get(k, i + 1):
                first[k] = i
    out = []
    for i, t, *_ in rows:
        w = words(t)
        gone = {a + k for a in range(len(w) - window + 1) if i is not None and first[tuple(w[a : a + window])] < i for k in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((x.doc_id, x.n_words, sum(s.end - s.start for s in x.removed), hashlib.sha256(x.kept_text.encode()).hexdigest()) for x in df.collect())


def test_against_plain(spark):
    rows = documents() + [(None, documents()[4][1], "en", "s", 1)] + [(2000 + i, " ".join(["a", "b"] * 40), "en", "s", 1) for i in range(3)]
    want = plain(rows)
    assert sum(n[2] > 0 for n in want) > 8
    assert got(substring.remove_repeats(frame(spark, rows))) == want
    assert got(substring.remove_repeats(frame(spark, rows), chunk_words=100, shard_bytes=2000)) == want


def test_tasks_of_several_shards_and_long_texts(spark, monkeypatch):
    """More shards than tasks, a text of 60,000 words that holds others, and columns of clashing names."""
    import random

    rng = random.Random(4)
    monkeypatch.setattr(substring, "SHARD_TASKS", 3)
    rows = documents(seed=9, n=30)
    long = " ".join(f"v{rng.randrange(5000)}" for _ in range(60_000))
    rows += [(4000, long, "en", "s", 1), (4001, " ".join(long.split()[20_000:40_000]), "en", "s", 1), (4002, " ".join(long.split()[100:130]), "en", "s", 1)]
    docs = frame(spark, rows).selectExpr("*", "1 as n_words", "2 as removed", "'x' as kept_text", "3 as shard")
    assert got(substring.remove_repeats(docs, shard_bytes=3000)) == plain(rows)


def test_common_anchors_change_nothing(spark, monkeypatch):
    rows = documents(seed=3)
    chunk = substring.Chunk()
    for i, t, *_ in rows:
        chunk.add(i, t)
    every = np.unique(chunk.solve(np.zeros(0, np.uint64), 13, 4).keys)
    monkeypatch.setattr(substring, "common_anchors", lambda *a: every[::2].copy())
    assert got(substring.remove_repeats(frame(spark, rows), chunk_words=500)) == plain(rows)


def test_known_passages(spark):
    rows = documents(seed=5)
    known = [(t,) for _, t, *_ in rows[::9]] + [(None,), ("",), ("too short",)]
    ref = {tuple(words(t)[a : a + 13]) for (t,) in known for a in range(len(words(t)) - 12)}
    want = []
    for i, t, *_ in rows:
        w = words(t)
        gone = {a + k for a in range(len(w) - 12) if tuple(w[a : a + 13]) in ref for k in range(13)}
        want.append((i, len(w), len(gone), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    for most in (200_000, 60):
        assert got(substring.remove_known(frame(spark, rows), spark.createDataFrame(known, "text string"), shard_words=most)) == Counter(want)
    assert substring.remove_known(frame(spark, rows), spark.createDataFrame([], "text string")).where("size(removed) > 0").count() == 0


def test_empty(spark):
    assert substring.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.integers(0, 2), max_size=24), max_size=6), st.lists(st.integers(0, 2), max_size=30))
def test_automaton(known, asked):
    automaton = substring.SuffixAutomaton()
    for owner, x in enumerate(known):
        automaton.add(x, owner)
    want = [next((o for o, x in enumerate(known) if any(x[k : k + 4] == asked[a : a + 4] for k in range(len(x) - 3))), None) for a in range(len(asked) - 3)]
    assert automaton.first_owners(asked, 4) == want


def test_equal_hashes_are_compared(spark, monkeypatch):
    monkeypatch.setattr(substring, "mix", lambda x: x & np.uint64(7))
    chunk = substring.Chunk()
    for i, t, *_ in documents():
        chunk.add(i, t)
    chunk.solve(np.zeros(0, np.uint64), 13, 4)
    texts = [chunk.text[a:b] for a, b in zip(chunk.a.tolist(), chunk.b.tolist())]
    for n, s, c in zip(chunk.number.tolist(), chunk.first.tolist(), chunk.count.tolist()):
        assert texts[n] == chunk.text[chunk.starts[s] : chunk.ends[s + c + 11]]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 12))
def test_window_minima(x, span):
    a = np.array(x, np.uint64)
    if span <= len(x):
        assert substring.window_minima(a, span).tolist() == [i + int(np.argmin(a[i : i + span])) for i in range(len(x) - span + 1)]
