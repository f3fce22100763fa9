"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Three base patterns find assignments, access keys and hex runs.  Then each run of 20 or more
``[A-Za-z0-9+/_=-]`` characters with a letter, or what these patterns leave of it if that is as long,
is split by a tiktoken vocabulary: text of any language yields several characters for each token, a
random string few, so a run of less than ``ratio`` characters for each token is reported as
``random``.  Known digests (hex of the usual lengths, UUIDs), identifiers and pieces of the alphabet
in order are excluded first.  An identifier is two or more words of ``WORDLIKE`` letters on average,
by separators and case, with one number at most, or ``LEAST_PARTS`` or more parts between separators,
each a word, a number or one after the other (a name with a date, a numbered list of fields).  Runs
without a letter (numbers, rules) are not tested.

Spans are of code points, end exclusive.  Edge cases: a null text counts as empty; a text of any
length is scanned whole; repeated rows each get a row; other columns are ignored (``find_secrets``)
or kept (``redact_secrets``).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from casemill.llm.common import Held, map_batches

KINDS = ("assign", "access", "hex", "random")
# The patterns that a base scan must report.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
HINT = re.compile(r"(?ai)passw|secret|token|api_?key")

LEAST_RUN = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
JOINTS = "+/_=-"
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGEST = re.compile(r"(?ai)(?:0x|sha\d*[-=])?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12})")
WORDLIKE, LEAST_PARTS = 4, 4
PART = re.compile(r"[A-Z]?[a-z]{0,12}[0-9]{0,8}|[A-Z]{1,12}[0-9]{0,8}|[0-9]{1,8}[A-Za-z]{0,2}[0-9]{0,4}")
RATIO = 2.0


class Vocabulary:
    """A tiktoken encoding from a file of ranks."""

    @staticmethod
    def read(path: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str):
        return Held.of((cls, path), lambda: cls.read(path))


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, start of the secret itself) of the fixed patterns."""
    out = []
    if HINT.search(text):
        out += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    return out


def identifier(run: str) -> bool:
    words, parts = HUMP.findall(run), [x for x in re.split("[+/_=-]", run) if x]
    if len(parts) >= LEAST_PARTS and all(map(PART.fullmatch, parts)):
        return True
    return len(words) > 1 and sum(map(len, words)) >= WORDLIKE * len(words) and len(re.findall("[0-9]+", run)) < 2


def known(run: str) -> bool:
    return not any(c.isalpha() for c in run) or run.lower() in ALPHABET or bool(DIGEST.fullmatch(run)) or identifier(run)


def left_of(a: int, b: int, base: list) -> list[tuple[int, int]]:
    """What the base spans leave of (a, b), in order."""
    out = []
    for start, end, *_ in sorted(base):
        if start < b and a < end:
            out.append((a, start))
            a = max(a, end)
    return [(x, y) for x, y in [*out, (a, b)] if y - x >= LEAST_RUN]


def random_spans(text: str, base: list, encode, ratio: float = RATIO) -> list[tuple[int, int, str, int]]:
    out = []
    for m in RUN.finditer(text):
        if DIGEST.fullmatch(m[0]):
            continue
        for a, b in left_of(*m.span(), base):
            run = text[a:b]
            if known(run if b - a == len(m[0]) else run.strip(JOINTS)):
                continue
            if len(run) < ratio * len(encode(run)):
                out.append((a, b, "random", a))
    return out


def spans_of(text: str | None, encode, ratio: float = RATIO) -> list[tuple[int, int, str, int]]:
    text = text or ""
    base = base_spans(text)
    return sorted(base + random_spans(text, base, encode, ratio), key=lambda x: (x[0], KINDS.index(x[2])))


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("secret", T.IntegerType())]))


def find_secrets(docs: DataFrame, *, vocabulary: str, ratio: float = RATIO) -> DataFrame:
    """doc_id and secrets: an array of (kind, start, end, start of the secret) in order."""
    thin = docs.select("doc_id", "text")
    schema = T.StructType([thin.schema["doc_id"], T.StructField("secrets", SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.int32())]))

    def run(batches):
        encode = Vocabulary.of(vocabulary).encode_ordinary
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b, "secret": s} for a, b, k, s in spans_of(t, encode, ratio)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "secrets"])

    return map_batches(thin, run, schema)


def redacted(text: str | None, spans: list[tuple[int, int, str, int]], mark: str) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for a, b in sorted((s, b) for _, b, _, s in spans):
        if b <= at:
            continue
        out += [text[at : max(a, at)], mark if a >= at else ""]
        at = b
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, *, vocabulary: str, ratio: float = RATIO, mark: str = "[secret]") -> DataFrame:
    """All documents with all columns; in their texts each secret is replaced by ``mark``."""
    names = docs.columns
    at = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        encode = Vocabulary.of(vocabulary).encode_ordinary
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [redacted(t, spans_of(t, encode, ratio), mark) for t in old]
            cols = list(batch.columns)
            cols[at] = pa.array(new, cols[at].type)
            if chars is not None:
                cols[chars] = pa.array([len(b) if a != b else n for a, b, n in zip(old, new, cols[chars].to_pylist(), strict=True)], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_batches(docs, run, docs.schema)
