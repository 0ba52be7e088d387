import random

import pytest

SYLLABLES = "ar be ko lin mar ne or pu ra si ta un vel wo xi ya zo".split()


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(800)]


@pytest.fixture(scope="session")
def corpus(spark, words):
    """Documents with every awkward case: NULL, empty, blank, very long, copies, near copies, repeated rows."""
    rng = random.Random(4)

    def prose(n):
        return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) + rng.choice(["", "", "", "\n"]) for _ in range(n))

    texts = [prose(rng.randint(1, 300)) for _ in range(60)]
    texts += [None, "", "  \n\t ", "a", "A b C d", "x y z x y z x y z x y z", "é ü 中文    ok", "!!! ### $$$", "\x00 \x1c odd\x7f"]
    texts += [prose(6000), "w" * 30000, texts[0], texts[0], texts[1] + " tail", texts[2].upper()]
    near = texts[3].split(" ")
    texts += [" ".join([*near[:-1], "changed"]), " ".join(["new", *near])]
    rows = [(i, t, rng.choice(["aa", "bb", None]), "extra", i, "clash") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5]]  # repeated rows
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string")


@pytest.fixture(scope="session")
def texts(corpus):
    return [(r.doc_id, r.text or "") for r in corpus.collect()]


@pytest.fixture(scope="session")
def empty(corpus):
    return corpus.filter("doc_id < 0")
