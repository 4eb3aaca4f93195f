import random

import pytest

#: Texts at the borders of what operators accept.
ODD = [
    None, "", " \n\t ", "one", "two words", "a b c d", "a b c d", "A B C D", "x" * 3000,
    "é😀 foo@bar.com 😀 +1 222 333 4444", "\n\n\na\n\nb\n", "1 " * 500, "  lead  and\ttrail \n",
    "a@b.c@d.e x@y..z q@w.e_r@t.y", "1.2.3.4.5.6 999.1.1.1 00012.1.1.1 0000.0.0.256",
    "4111 1111 1111 1111 4111-1111-1111-1112 12", "<|endoftext|> don't we'll",
    "Released under the MIT License.",
]


@pytest.fixture(scope="session")
def texts():
    """Random prose with copies, near copies, shared passages and the odd texts."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("aeiourstln") for _ in range(rng.randint(1, 7))) for _ in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = list(ODD)
    passage = prose(70)
    for _ in range(40):
        base = prose(rng.randint(5, 300))
        out.append(base)
        kind = rng.random()
        if kind < 0.3:
            out.append(base.upper() if rng.random() < 0.3 else base)
        elif kind < 0.6:
            w = base.split()
            for _ in range(1 + len(w) // 90):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append(" ".join(w))
        elif kind < 0.8:
            out.append(f"{prose(20)}\n{passage} {prose(30)}\n{prose(9)}")
    long = prose(4000)
    return [*out, long, long + " end", *["same text for a large group of copies here"] * 60]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids, and extra columns whose names clash with results."""
    rows = [(i, t, "x", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, kept string, component_id int, base int"
    ).repartition(3)


@pytest.fixture(scope="session")
def none(docs):
    """An empty table."""
    return docs.limit(0)
