import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Documents with nulls, empty and very long texts, copies, near copies, shared passages, repeated rows and repeated ids."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    common = ["the", "of", "and", "to"] * 60
    passage = prose(rng, 40, words)
    out = []
    for i in range(60):
        text = prose(rng, rng.randint(1, 300), words + common)
        if i % 7 == 3:
            text = text[:200] + " " + passage + " " + text[200:]
        if i % 11 == 5:
            text = out[-3][1]
        if i % 13 == 6 and out[-1][1]:
            text = out[-1][1] + " end"
        out.append([i * 3, text, "en", f"s{i % 4}", len(text or "")])
    out[10][1] = None
    out[11][1] = ""
    out[12][1] = prose(rng, 30_000, words + common)
    out[13][1] = "aaaa" * 700
    out[14][1] = "ß" * 90 + "x" + "日本語" * 40
    out[15][1] = out[14][1] + "ß" * 60
    out[16][3] = None
    out[17][2] = None
    out.append(list(out[20]))
    out.append([out[21][0], "another text under an id that is taken, " + passage, "de", "s1", 0])
    out.append([None, passage + " and more words follow here", "en", "s2", 0])
    out.append([None, passage + " and more words follow here", "en", "s2", 0])
    out.append([-7, " \t\n ", "en", "s2", 4])
    return [tuple(r) for r in out]


@pytest.fixture()
def docs(spark, rows):
    """The same with extra columns, some named like results of the operators."""
    frame = spark.createDataFrame(rows, DOC)
    return frame.selectExpr("*", "'x' AS rid", "1 AS size", "2 AS score", "'y' AS fingerprint", "3 AS component_id", "4 AS shard", "5 AS slot", "6 AS target", "7 AS sequence_id", "8 AS `odd name`")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], DOC)
