import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, print string, " \
         "score string, start string, kept string"


def doc(key, text, source="s0"):
    """A row of ``documents`` with further columns whose names operators use themselves."""
    return key, text, "en", source, len(text or ""), "p", "x", "y", "z"


@pytest.fixture(scope="session")
def frame(spark):
    return lambda rows: spark.createDataFrame([doc(*r) for r in rows], SCHEMA)


def prose(seed, n, vocabulary=60):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, shared passages, repeats inside, no words, nulls and long runs."""
    a, b, c = prose(1, 60), prose(2, 90), prose(3, 45)
    shared = prose(4, 30)
    return [(1, a), (2, b), (3, a), (4, f"{prose(5, 20)} {shared} {prose(6, 25)}"),
            (5, f"{prose(7, 15)}\n{shared}\t{prose(8, 3)}"), (6, None), (7, ""), (8, " \n\t "),
            (9, c + " " + c), (10, "x " * 300), (11, "ÄÖü ß été " * 12), (12, "one two"),
            (13, "A" * 900), (14, f"{b[:200]} {shared} {b[200:]}"), (15, "one two"),
            (16, shared), (17, f"é{prose(9, 40)}"), (18, f"è{prose(9, 40)}"), (19, prose(20, 3000, 5))]
