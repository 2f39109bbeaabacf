import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, rid long, name string, kept boolean, size string, row string"


def document_rows():
    """Every awkward case: nulls, empty and blank texts, one word, a very long
    text, copies, repeated rows, ties, shared lines and passages."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeèñü") for _ in range(rng.randint(1, 7)))
    words = lambda n: " ".join(word() for _ in range(n))
    passage, footer, long_text = words(70), "all of these words stand at the foot of every page, always", words(9000)
    texts = [None, "", " \t\n ", "word", "Word", "one two", long_text, long_text.replace(" ", "\n", 50), long_text,
             f"{words(30)}\n{passage}\n{footer}", f"{passage}\n{words(20)}\n\n{footer}\n{words(3)}", f"{words(5)} {passage} {words(5)}",
             f"short line\n{footer}", f"short line\n{footer}", "a b c d e f g h i j\nk\nl m\n\nn o p q r s t u v w x y z", "k\nl m\nn o p q r s t u v w x y z",
             "same same same " * 120, "x" * 900, "12 34 ... !!!", "日本語のテキスト 日本語 です", f"{words(40)}\n{footer}\n{words(12)}\n{footer}"]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("s2", "s1", None, "s3")[i % 4], len(t or ""), 1, "n", True, "1", "r") for i, t in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, texts[10], "en", "s1", 0, 2, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    spark.createDataFrame(document_rows(), COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "documents.parquet")
    spark.createDataFrame([], COLUMNS).write.parquet(path)
    return spark.read.parquet(path)
