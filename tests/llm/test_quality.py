from collections import Counter, defaultdict

from casemill.llm import quality
from tests.llm.helpers import DOCS, documents, frame, words


def base(text):
    t = text or ""
    w = words(t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(inside), failed


def plain(rows, min_docs, share, most_docs, min_words, min_left):
    texts, carriers = defaultdict(set), defaultdict(set)
    norm = lambda x: " ".join(words(x)).lower()
    for _, t, _, s, _ in rows:
        texts[s].add(t)
        for x in (t or "").split("\n"):
            if words(x):
                carriers[s, norm(x)].add(t)
    common = {k for k, v in carriers.items() if len(v) > min(most_docs, max(min_docs, share * len(texts[k[0]])))}
    out = []
    for i, t, _, s, _ in rows:
        n = base(t)
        lost = sum(len(words(x)) for x in (t or "").split("\n") if (s, norm(x)) in common)
        out.append((i, *n, lost, not n[5] and not (lost > 0 and (n[0] - lost < min_words or n[0] - lost < min_left * n[0]))))
    return sorted(out), common


def test_report(spark):
    rows = documents() + [(1000, "# a < b\n\n# a < b\nc d e c d e c d e " * 9, "en", "src0", 1), (1001, "v v v v v v", "en", None, 2)]
    for limits in ({"min_docs": 3, "share": 0.1, "most_docs": 20, "min_words": 50, "min_left": 0.3}, {"min_docs": 9, "share": 0.9, "most_docs": 2, "min_words": 60, "min_left": 0.95}):
        got = quality.quality_report(frame(spark, rows), **limits).select("doc_id", *quality.COUNTS, "n_removed_words", "kept").collect()
        want, common = plain(rows, **limits)
        assert sorted(map(tuple, got)) == want
        assert common and any(not x[-1] and not x[-3] for x in want) == (limits["most_docs"] == 2)


def test_apply(spark):
    rows = documents()
    out = quality.apply_quality(frame(spark, rows), min_docs=3).collect()
    want, common = plain(rows, 3, quality.SHARE, quality.MOST_DOCS, quality.MIN_WORDS, quality.MIN_LEFT)
    assert sorted(x.doc_id for x in out) == sorted(x[0] for x in want if x[-1])
    cut = [x for x in out if x.n_chars is not None and "Click here" not in x.text]
    assert common and cut and all(x.doc_id == 903 or x.n_chars for x in cut)
    assert all("Click here" not in x.text for x in out if x.source == "src2")


def test_limit_on_small_and_large_hosts(spark):
    """A line of four of nine documents is common, and one of 21 of 400; copies of one text don't make their lines common."""
    body = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, f"{body(i)}\nshared footer line" if i < 4 else body(i), "en", "small", 1) for i in range(9)]
    rows += [(100 + i, f"{body(100 + i)}\nrare footer line" if i < 21 else body(100 + i), "en", "large", 1) for i in range(400)]
    rows += [(1000 + i, f"{body(1000)}\nline of a copied page", "en", "small", 1) for i in range(50)]
    docs = frame(spark, rows)
    keyed = quality._keyed(docs)
    found = {(r.source, r.n_docs) for r in quality.common_lines(keyed, quality._lines(keyed)).collect()}
    assert found == {("small", 4), ("large", 21)}
    out = {r.doc_id: r.text for r in quality.apply_quality(docs).collect()}
    assert len(out) == len(rows) and sum("footer" in t for t in out.values()) == 0 and "copied page" in out[1000]


def test_the_method_rejects_what_the_base_keeps(spark):
    """A document of 52 words that loses nine is depleted; one of 90 words isn't."""
    body = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(i, f"{body(i, 43 if i < 5 else 81)}\na b c d e f g h i", "en", "s", 1) for i in range(9)]
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality.quality_report(frame(spark, rows)).collect()}
    assert got == {i: (False, i >= 5) for i in range(9)}
    assert sorted(r.doc_id for r in quality.apply_quality(frame(spark, rows)).collect()) == [5, 6, 7, 8]


def test_empty_and_clashing_columns(spark):
    assert quality.quality_report(spark.createDataFrame([], DOCS)).count() == 0
    docs = frame(spark, documents()).selectExpr("*", "1 as n_words", "'x' as kept", "2 as _cut")
    assert quality.quality_report(docs).count() == docs.count()
    assert quality.apply_quality(docs).columns == docs.columns
