import random
import re

import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string, score string"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n):
    return " ".join("".join(rng.choices("ka lo mi ren tas vo du sil".split(), k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Texts of every awkward kind: null, empty, blank, short, long, odd characters, copies, near copies, shared passages."""
    rng = random.Random(5)
    base, passage, periodic = prose(rng, 300), prose(rng, 60), "ha " * 400
    edited = base.split()
    edited[150] = "changed"
    twice = base.split()
    twice[20] = "other"
    texts = [
        None, "", " \t\n", "one", "two words", "Two WORDS", base, base, base.upper(), " ".join(edited), " ".join(twice),
        prose(rng, 80) + " " + passage + " " + prose(rng, 80), passage + "\n" + prose(rng, 90), prose(rng, 50) + " " + passage,
        periodic, periodic[:300], "x" * 5000, "Ünïcode Σίσυφος 中文 😀 é   İ <|endoftext|> it's 12% ##", prose(rng, 20_000),
    ]
    out = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, len(t) if t and i % 4 else None, "x", "y", "z") for i, t in enumerate(texts)]
    out.append(out[6])  # a row there twice
    out.append((None, base, "en", "s", 5, "x", "y", "z"))  # no id
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
