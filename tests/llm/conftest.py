import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _texts():
    rng = random.Random(5)
    names = ["alpha", "Beta", "gamma", "delta,", "épsilon", "zeta.", "eta", "theta", "iota", "kappa", "la", "mu"]

    def prose(n):
        return " ".join(rng.choice(names) for _ in range(n))

    base, shared = prose(90), prose(60)
    out = [base, base, base.replace("alpha", "ALPHA"), base + " end", "start " + base, None, "", "   \n\t ", "one", "one two three"]
    out += [prose(20) + " " + shared + " " + prose(10) for _ in range(6)]
    for _ in range(8):  # near copies
        w = base.split(" ")
        w[rng.randrange(len(w))] = "edit%d" % rng.randrange(1000)
        out.append(" ".join(w))
    out += ["x" * 700, "x" * 650, "ab " * 300, "\n".join(["same line of words here"] * 12), "日本語 テキスト 😀 " * 30, " \x85a\x1cb  c"]
    out += [prose(rng.randrange(1, 400)) for _ in range(12)]
    out.append(" ".join(prose(700).split(" ")))
    return out


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids."""
    texts = _texts()
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[3], None, None, None), (None, None, "en", None, 0), (900, texts[0], "en", None, None)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
