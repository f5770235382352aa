import random

import pytest

WORDS = "the of and to in is that it for was on are with as by this from have not but all were when there can".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", str(rng.randrange(50)), ","]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and long texts, exact and near copies, ties and repeated rows."""
    rng = random.Random(4)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(60)]
    out = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", "c", None])) for i, t in enumerate(base)]
    for i in range(60, 110):  # near copies in chains
        words = out[rng.randrange(len(out))][1].split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = "x" + str(rng.randrange(100))
        out.append((i, " ".join(words), "en", "a"))
    out += [(110, base[3].replace(" ", "\n\t"), "en", "b"), (111, base[3] + "  ", "en", "a"), (112, "", "en", "a"), (113, None, None, None),
            (114, " \n\t ", "fr", "c"), (115, "one two", "en", "a"), (116, "ONE  two", "en", "a"), (117, "12 34 !!", "en", "a"),
            (118, prose(rng, 6000), "en", "a"), (119, "line\n" * 40, "en", "b"), (120, "É   ß 日本 \U0001F600", "fr", "c")]
    out += [out[5], out[5]]  # repeated rows
    return out


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With more columns, whose names operators use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for c in ("key", "rep", "n", "block", "c", "p", "h", "points", "word", "line", "component_id", "kept", "share", "start"):
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
