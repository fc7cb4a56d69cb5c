import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid string, label string, pivot long"


def made_texts():
    """Prose of invented words with copies, near copies, shared passages, repeated lines, and odd rows."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    base = prose(200)
    passage = prose(40)
    texts = [prose(rng.randint(1, 150)) for _ in range(40)]
    texts += [base] * 6
    for _ in range(40):  # near copies of one text, some not near each other
        near = base.split(" ")
        for _ in range(rng.randint(1, 4)):
            near[rng.randrange(len(near))] = "edit" + str(rng.randrange(10**6))
        texts.append(" ".join(near))
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(15)]
    texts += [f"{prose(12)}\n{prose(12)}x\n{passage[:60]}\n\n{passage[:59]}?" for _ in range(5)]
    texts += [None, None, "", "", " \n\t ", "one", "one", "One two", "a" * 300, "a" * 300, "é" * 60, "日本" * 30, "b" * 49]
    texts.append(prose(5000))
    texts.append(texts[-1] + " " + prose(20))
    return texts


@pytest.fixture(scope="session")
def texts():
    return made_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [
        (i, t, ["xx", "yy", None][i % 3], ["s1", "s2", None, "s1", "s1"][i % 5], len(t or ""), "u", None, 5)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
