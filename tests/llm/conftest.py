import random

import pytest

EXTRA = ("size", "fp", "h", "d", "t", "n_words", "taken", "score", "leaf", "pos", "block", "y")


@pytest.fixture(scope="session")
def corpus(spark):
    """Odd rows besides ordinary ones: nulls, empty and long texts, ties, copies, near copies, repeated rows, clashing columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randrange(1, 7))) for _ in range(60)] + ["Ünï", "É", "x1", "#", "a|b", "x y", "\x1cz"]
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared = line(70)
    texts = [line(rng.randrange(1, 120)) for _ in range(25)]
    texts += [f"{line(rng.randrange(0, 30))}\n{shared}\nUser {i} logged in from host {rng.randrange(99)} at noon\n{line(9)}" for i in range(14)]
    texts += [texts[0], texts[0], texts[30], " ".join(texts[30].split()[:-1]), "Some fixed footer line\n" + line(20), "Some fixed footer line\nSome fixed footer line"]
    texts += ["Some fixed footer line\n" + line(4) for _ in range(5)]
    texts += [None, "", " \t\n\x0b", "one", "two words", line(3000), "\n\n" + line(5) + "\n", "la " * 40, shared.upper(), "A" * 5000]
    rows = [(i * 3 + 1, t, "en", [None, "b", "a", "a", "a"][i % 5], 7) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (rows[3][0], "another text " + shared, "en", "a", 1), (None, shared + " tail", None, None, None), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], schema).repartition(5).cache()


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i * 3 + 1, i % 2 if i % 7 else None, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (1, 0, 1), (9999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def keyed(df, *names):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
