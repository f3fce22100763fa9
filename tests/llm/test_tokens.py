import struct
import zlib

import pyarrow as pa
import pytest

from casemill.llm import packing, tokens
from casemill.llm.queries import tokenizer_path
from tests.llm.helpers import DOCS, documents, frame

ODD = [
    "", " ", "a  b", "x   y", "a\x1cb !\x1cb", "é é ́a", "l'été d'ici it's IT'S we'll 'd", "tab\t\tnew\n\n\nline ", "日本　語", "1 22 333,4", "<|endoftext|> a",
    "ΟΔΥΣΣΕΥΣ ΣΑΣ.", "İstanbul ﬁ", "…—‘q’", "\r\n x \r y", "\U0001f642 ‍↔", " lead", "trail ", "a \nb", "a\n b", "½ ² ª x×y",
    "ÉCOLE Ÿ ǅ Ǆx ŉ ß ẞ", "a b   c", "foo_bar--baz!!?? (x)[y]{z} #$% a1b2 3c", "'" * 4 + "s 'S '", "\x00 \x7f", "a\x0bb\x0cc",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_pieces_equal_whole(name):
    encoder = tokens.Encoder(tokenizer_path(name))
    for t in ODD + [x[1] or "" for x in documents()] + ["".join(ODD), " ".join(ODD[::-1])]:
        assert encoder.encode(t) == encoder.whole(t)
    assert encoder.kind == name.split("_")[0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_full_caches_and_random_texts(name, monkeypatch):
    import random

    monkeypatch.setattr(tokens, "WORDS_KEPT", 3)
    monkeypatch.setattr(tokens, "PARTS_KEPT", 4)
    encoder, rng = tokens.Encoder(tokenizer_path(name)), random.Random(8)
    marks = [*"abcXYZ'stlmd.,!_-#0123  \n\t\r", "é", "É", "ñ", "Ÿ", "'s", "'ll", " the", "²", "́"]
    for _ in range(3000):
        t = "".join(rng.choices(marks, k=rng.randrange(30)))
        assert encoder.encode(t) == encoder.whole(t), repr(t)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_batches_equal_whole(name):
    import random

    encoder, rng = tokens.Encoder(tokenizer_path(name)), random.Random(9)
    marks = [*" \n\t\r.,", "  ", "\n\n", "a", "Foo", "foo.", "It's", "'ll", "12", "...", "é", "ſ", "\xa0", "\u3000", "\x0b", "\x1c", "\x00", "漢", "<|endoftext|>", "\U0001f642"]
    texts = [None, *ODD, "".join(ODD), *("".join(rng.choices(marks, k=rng.randrange(9))) for _ in range(3000)), None, ""]
    column, want = pa.array(texts, pa.string()), [encoder.whole(t or "") for t in texts]
    for size in (1, 7, 1000):
        assert [x for i in range(0, len(texts), size) for x in encoder.encode_all(column.slice(i, size))] == want
    assert encoder.encode_all(column.cast(pa.large_string())) == want and encoder.encode_all(column[:0]) == []


def test_a_batch_asks_once_for_each_word_and_old_words_stay():
    encoder, asked = tokens.Encoder(tokenizer_path("byte_bpe_50k.json")), []

    class Counted(tokens.Kept):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    encoder.words = Counted(encoder._word, 20)
    encoder.encode_all(pa.array([". the cat", "- the cat the cat"] * 5))
    assert sorted(asked) == ["cat", "the"]
    for i in range(100):
        encoder.words["x" * (i + 1)]
    assert len(encoder.words) <= 20 and {"the", "cat"} <= set(encoder.words)


def test_latin_letters_cut_alike():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = tokens.Encoder(tokenizer_path(name))
        for c in map(chr, range(0x20, 0x2B0)):
            for t in (c, f"a{c}b", f"a {c} 1{c}", f"{c}{c}"):
                assert encoder.encode(t) == encoder.whole(t), repr(t)


def test_another_pre_tokenizer_is_left_alone(tmp_path):
    import json

    spec = json.load(open(tokenizer_path("byte_bpe_50k.json")))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(spec))
    encoder = tokens.Encoder(str(tmp_path / "t.json"))
    assert encoder.kind is None and encoder.encode("a b") == encoder.whole("a b")


def test_another_normaliser_or_model_is_left_alone(tmp_path):
    import json

    def changed(change):
        spec = json.load(open(tokenizer_path("word_bpe_49k.json")))
        change(spec)
        (tmp_path / "t.json").write_text(json.dumps(spec))
        return tokens.Encoder(str(tmp_path / "t.json"))

    for change in (
        lambda s: s["normalizer"]["normalizers"][1].update(content="-"), lambda s: s["normalizer"]["normalizers"][1].update(pattern={"String": "a"}),
        lambda s: s["model"].update(ignore_merges=True), lambda s: s["pre_tokenizer"]["pretokenizers"][0].update(behavior="Isolated"),
    ):
        encoder = changed(change)
        assert encoder.kind is None and encoder.encode("a banana  is here") == encoder.whole("a banana  is here")
    assert changed(lambda s: None).kind == "word"


def expected(rows, name, end):
    encoder = tokens.Encoder(tokenizer_path(name))
    return [(i, encoder.whole(t or "") + struct.pack("<I", end)) for i, t, *_ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))]


def test_files(spark, tmp_path, monkeypatch):
    rows = documents() + [(None, "no id", "en", "s", 1)]
    monkeypatch.setattr(tokens, "FRAME_BYTES", 2000)
    path = tokens.write_tokens(frame(spark, rows), str(tmp_path / "t"), tokenizer=tokenizer_path("word_bpe_49k.json"))
    got = sorted((x.start, x.doc_id, x.n_tokens, bytes(x.ids)) for x in tokens.read_tokens(spark, path).collect())
    at, want = 0, []
    for i, ids in expected(rows, "word_bpe_49k.json", 1):
        want.append((at, i, len(ids) // 4, ids))
        at += len(ids) // 4
    assert got == want
    some = tokens.read_tokens(spark, path, doc_ids=[903, 30]).collect()
    assert {x.doc_id: bytes(x.ids) for x in some} == {i: ids for _, i, _, ids in want if i in (903, 30)}


def test_repeated_ids_go_to_many_files_of_bounded_size(spark, tmp_path):
    """Two thirds of the rows have one id or none; extra columns of clashing names are ignored."""
    rows = [(7 if i % 3 else None, f"text {i % 40}", "en", "s", 1) for i in range(600)] + [(8 + i, "last", "en", "s", 1) for i in range(10)]
    docs = frame(spark, rows, 6).selectExpr("*", "1 as _h", "2 as _from", "3 as start", "4 as ids")
    path = tokens.write_tokens(docs, str(tmp_path / "t"), tokenizer=tokenizer_path("word_bpe_49k.json"), file_docs=50)
    import json

    manifest = json.loads((tmp_path / "t" / tokens.MANIFEST).read_text())
    assert max(x["docs"] for x in manifest) <= 50 and len(manifest) >= 13 and sum(x["docs"] for x in manifest) == len(rows)
    out = sorted(((x.start, x.doc_id, x.n_tokens, bytes(x.ids)) for x in tokens.read_tokens(spark, path).collect()), key=lambda x: x[0])
    assert [x[1] for x in out] == sorted((x[0] for x in rows), key=lambda i: (i is not None, i or 0))
    assert [x[0] for x in out] == [sum(x[2] for x in out[:k]) for k in range(len(out))]
    encoder = tokens.Encoder(tokenizer_path("word_bpe_49k.json"))
    assert sorted(((x[1], x[3]) for x in out), key=str) == sorted(((i, encoder.whole(t) + struct.pack("<I", 1)) for i, t, *_ in rows), key=str)
    some = tokens.read_tokens(spark, path, doc_ids=[12])
    assert some.rdd.getNumPartitions() < len(manifest) and [x.doc_id for x in some.collect()] == [12]


def test_reads_only_what_is_asked_and_checks(tmp_path):
    import pyarrow.fs as pfs

    fs, name = pfs.LocalFileSystem(), str(tmp_path / "f.zst")
    w = tokens.FileWriter(fs.open_output_stream(name, compression=None), 3)
    for i in range(9):
        w.add(i, bytes([i]) * (tokens.FRAME_BYTES // 2))
    w.close()
    r = tokens.FileReader(fs.open_input_file(name))
    assert [k for k, *_ in r.documents({4})] == [4] and r.opened == 2  # the directory and a frame
    data = bytearray(open(name, "rb").read())
    import zstandard

    assert len(b"".join(zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read(1 << 30) for _ in [0])) > 8
    entry = len(data) - 9 - 12 * len(r.table) + 8
    data[entry] ^= 1
    open(name, "wb").write(data)
    with pytest.raises(ValueError, match="checksum"):
        list(tokens.FileReader(fs.open_input_file(name)).documents({0}))


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert tokens.read_tokens(spark, tokens.write_tokens(none, tokenizer=tokenizer_path("word_bpe_49k.json"))).count() == 0
    assert packing.pack(none, tokenizer=tokenizer_path("byte_bpe_50k.json")).count() == 0


def test_packing(spark):
    rows = documents() + [(None, "no id", "en", "s", 1)]
    out = packing.pack(frame(spark, rows), tokenizer=tokenizer_path("byte_bpe_50k.json"), size=256).collect()
    want = []
    for i, ids in expected(rows, "byte_bpe_50k.json", 0):
        n = len(ids) // 4
        at = 0
        for k, size in enumerate([n] if n <= 256 else [x for x in [n % 256] if x] + [256] * (n // 256)):
            want.append((i, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
            at += size
    key = lambda x: tuple(-1 if y is None else y for y in x)
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out), key=key) == sorted(want, key=key)
    assert all(zlib.crc32(x.ids) == x.ids_crc32 for x in out)
    rooms = {}
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert rooms.get(x.sequence_id, 0) == x.offset
        rooms[x.sequence_id] = x.offset + x.length
    assert max(rooms.values()) <= 256 and len(rooms) <= best_fit([x[3] for x in want], 256)


def best_fit(lengths, size):
    """How many sequences best-fit decreasing takes."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(size - n)
    return len(rooms)


def test_plan_covers_every_length_once():
    import random
    from collections import Counter

    for seed in range(30):
        rng = random.Random(seed)
        size = rng.choice([1, 2, 7, 64, 300, 2048])
        lengths = Counter(min(size, 1 + int(rng.expovariate(1 / rng.choice([2, 40, 900])))) for _ in range(rng.choice([0, 1, 30, 4000])))
        recipes = packing.plan(lengths, size)
        got = Counter()
        for xs, n in recipes:
            assert sum(xs) <= size
            for x in xs:
                got[x] += n
        assert got == lengths
        assert sum(n for _, n in recipes) >= -(-sum(k * v for k, v in lengths.items()) // size)
