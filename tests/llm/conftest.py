import pytest

from claimlake.llm.queries import workers_find_us


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    workers_find_us(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.fixture(scope="session")
def docs_of(spark):
    def build(*rows):
        """(doc_id, text) rows with further columns, among them names the operators use."""
        return spark.createDataFrame([(i, t, "x", 1, 2.0) for i, t in rows], "doc_id long, text string, spans string, n int, score double")

    return build


@pytest.fixture(scope="session")
def prose():
    """Seeded texts of invented words with shared passages, exact and near copies, and awkward cases."""
    import random

    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeéñüstr") for _ in range(rng.randint(1, 8))) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))

    shared = text(60)
    rows = [(i, text(rng.randint(5, 200))) for i in range(40)]
    rows += [(100 + i, text(30) + "\n" + shared + " " + text(20)) for i in range(6)]
    rows += [(200 + i, rows[0][1]) for i in range(3)]
    for i in range(8):
        copy = rows[41][1].split(" ")
        for _ in range(i // 2):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((300 + i, " ".join(copy)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "One"), (405, "a " * 300), (406, "!?." * 120), (None, shared), (0, rows[0][1])]
    return rows
