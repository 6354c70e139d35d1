import pytest

WORDS = ("amber birch cedar delta ember flint grove haven inlet jetty knoll larch maple north ocean pearl quill ridge slate thorn"
         " umber vivid willow yarrow zephyr").split()


def prose(seed: int, n: int) -> str:
    """Words from a small generator that depends on the seed alone."""
    out, state = [], seed * 2654435761 + 1
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(WORDS[(state >> 33) % len(WORDS)] + WORDS[(state >> 45) % len(WORDS)])
    return " ".join(out)


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with every awkward case: nulls in any column, empty and long texts, repeats, and columns named like an operator's own."""
    long_text = "\n".join(prose(100 + i, 80) for i in range(60))
    near = prose(7, 200)
    edited = near.split()
    edited[100] = "changed"
    rows = [
        (1, prose(1, 60), "a"), (2, prose(1, 60), "a"), (3, None, "b"), (4, "", None), (5, long_text, "b"), (6, near, "c"),
        (7, " ".join(edited), "c"), (7, " ".join(edited), "c"), (None, prose(9, 40), "a"), (8, "one two", None), (9, "ONE  two", "a"),
        (10, " \n\t ", "c"), (11, prose(11, 300) + "\n" + prose(12, 60), "a"), (12, prose(13, 300) + "\n" + prose(12, 60), "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name in ("size", "target", "key", "comp", "block", "value", "n", "score", "run", "place", "k", "h", "cut"):
        df = df.selectExpr("*", f"cast(null as string) as `{name}`")
    return df


@pytest.fixture(scope="session")
def nothing(tricky):
    return tricky.where("false")
