"""Small tables with every odd case, and what plain Python makes of them."""

import itertools
import random

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; as columns of the input they must not disturb anything.
CLASHING = ["digest", "fp", "score", "n", "found", "keep_rows", "word", "key", "bin_class", "owner", "component", "p", "k", "d", "row", "text_sha256"]

_WORDS = {
    "en": "the of and to in that it for was with this are not from which".split(),
    "de": "der die und das nicht mit sich auf ein eine werden über für schön zwischen".split(),
}


def prose(seed: int, n: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    words = [rng.choice(_WORDS[lang]) if rng.random() < 0.5 else "".join(rng.choice(["ba", "ke", "lo", "tri", "sen", "ou", "ma"]) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(words)


def odd_rows() -> list[tuple]:
    long_ = prose(1, 20_000)
    base = prose(2, 120)
    near = base.replace(" the ", " a ", 1)
    rows = [
        (1, base, "en", "a", 5),
        (2, base.upper(), "en", "a", 5),
        (3, near, "en", "b", None),
        (4, None, "en", None, 0),
        (5, "", None, "c", 0),
        (6, "  \n\t ", "en", "c", 0),
        (7, long_, "en", "a", 9),
        (8, prose(3, 80, "de"), "de", "b", 1),
        (8, prose(3, 80, "de"), "de", "b", 1),
        (9, "12 34 !?", None, "b", 1),
        (10, "one two three", "en", "b", 1),
        (None, "a row without an id", "en", "b", 1),
        (11, "</s>[INST] ▁ <|endoftext|>  two  spaces ", "en", "b", 1),
        (12, prose(5, 40) + " " + prose(4, 70) + " " + prose(6, 40), "en", "b", 1),
        (13, prose(7, 33) + " " + prose(4, 70) + " " + prose(8, 21), "en", "b", 1),
        (14, "日本語の文章です", None, "b", 1),
        (15, "x" * 5000, "en", "b", 1),
    ]
    return rows + [(100 + i, prose(100 + i, 30 + i, "de" if i % 3 == 0 else "en"), "de" if i % 3 == 0 else "en", "z", i) for i in range(40)]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


def clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def components_of(n: int, linked) -> list[int]:
    """The smallest member of the component of each of n things."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(n), 2):
        if linked(i, j):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(n)]
