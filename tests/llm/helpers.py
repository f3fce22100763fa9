"""Small tables with the awkward cases, and plain versions of what the operators compute."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents(seed=1, n=60):
    """Copies, shared passages, repeated rows, nulls, empty and long texts, odd white space."""
    rng = random.Random(seed)
    shared, line = prose(rng, 60), "Click here to accept all of our cookies"
    rows = []
    for i in range(n):
        t = prose(rng, rng.choice([3, 12, 13, 40, 90, 200]))
        kind = i % 6
        if kind == 1:
            t = f"{prose(rng, 20)} {shared} {prose(rng, 10)}"
        elif kind == 2:
            t = f"{line}\n{t}\n{line}\t \n{prose(rng, 70)}"
        elif kind == 3 and rows:
            t = rng.choice(rows)[1]
        elif kind == 4 and rows and rows[-3][1]:
            w = rows[-3][1].split(" ")
            w[len(w) // 2] = "edited"
            t = " ".join(w)
        rows.append((i * 3, t, "en", f"src{i % 3}", None if t is None else len(t)))
    rows += [
        (900, None, None, None, None), (901, "", "en", "src0", 0), (902, " \n\t ", "en", "src0", 4), (903, prose(rng, 6000), "en", "src1", 1),
        (904, "été ça Straße ÉCOLE naïve 日本語 " * 20, "fr", "src2", 1), (905, "a\x0bb\x0cc\rd\x1ce " * 30, "en", "src1", 1), (906, shared, "en", "src1", 1),
        (907, "x", "en", "src1", 1), (907, "x", "en", "src1", 1), (5, rows[10][1], "en", "src1", 1), (908, "don't stop <|endoftext|> it's 12 34 ok!! \n\n  end ", "en", "src2", 1),
    ]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def words(text):
    return WORD.findall(text or "")
