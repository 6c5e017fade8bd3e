import pytest

SF = "/root/testdata/sf0.001"
LONG = "one two three four five six. " * 20_000  # half a megabyte

ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "the same words stand here twice over"),
    (6, "the same words stand here twice over"), (6, "the same words stand here twice over"), (7, LONG), (None, "no id has this row"),
    (None, None), (8, "!!! ??? 123"), (9, "ünï cödé – 日本語 \u0000 end"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with the operators' names."""
    rows = [(i, t, "en", "s", 0, 0, b"", 0, 0, "x", {"a": 1}) for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, shard int, slot int, digest binary, id int, n int, key string, m map<string,int>"
    ).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


def python_free(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not any(w in plan for w in ("Python", "Pandas", "InArrow"))


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a
