"""Small frames with everything awkward in them."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_lines long, kept_text string, score double, "
    "fp long, h1 long, begin int, n int, size string, w string, doc string, _keep long, _hash long, _found long, item_id long"
)


def rows():
    words = [f"w{i}" for i in range(60)]
    rng = random.Random(3)
    long = " ".join(rng.choice(words) for _ in range(30_000))
    base = " ".join(rng.choice(words) for _ in range(80))
    texts = [
        (1, base),
        (2, base),
        (2, base),
        (3, base + " tail"),
        (4, None),
        (5, ""),
        (6, " \t\n \n"),
        (None, "no id here"),
        (None, None),
        (7, long),
        (8, "Ünï çödé 日本語 and \U0001f600 text\nline two\n\nline two\r\n  LINE TWO  "),
        (9, "same id, one text"),
        (9, "same id, another text"),
        (10, "short"),
        (11, "a\x1cb\x0bc\u2003d"),
    ]
    texts += [(20 + i, f"common line\nown line {i}\n  Common Line \nshared by some {i % 3}") for i in range(12)]
    return texts


def documents(spark, pairs=None):
    pairs = rows() if pairs is None else pairs
    return spark.createDataFrame(
        [(i, t, "en", None, None, 7, "x", 0.5, 1, 2, 3, 4, "s", "w", "d", 5, 6, 7, 8) for i, t in pairs], SCHEMA
    )


def got(df, *columns):
    """Rows as a sorted list of tuples; nulls sort first."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])


def in_order(found):
    return sorted(found, key=lambda r: [(v is not None, v) for v in r])
