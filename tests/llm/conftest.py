import random

import pytest

ODD = [None, "", " \n ", "one", "One two", "x" * 50_000, "word " * 3000, "é ü ß\n\n", "A b c d. E f g h!\nA b c d. E f g h!"]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with nulls, empties, long texts, exact and near copies, shared passages and a hot group."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice(["an", "the", "ir", "lo", "mé", "st"]) for _ in range(draw.randint(1, 4))) for _ in range(400)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) + draw.choice(["", "", "", ".", ",\n"]) for _ in range(n))
    passage, near = prose(60), prose(150).split(" ")
    texts = [*ODD, *[prose(draw.randint(1, 120)) for _ in range(60)]]
    texts += [prose(30) + " " + passage + " " + prose(draw.randint(5, 40)) for _ in range(25)]
    for _ in range(40):
        copy = list(near)
        for _ in range(draw.randint(0, 4)):
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [texts[20]] * 30
    draw.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns, some with the names that operators use inside."""
    rows = [(i, t, "x", 1, b"p") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, part int, payload binary").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
