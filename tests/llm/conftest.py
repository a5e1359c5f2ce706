import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, _batch long, score double, n_words string"


def sentence(rng, n):
    letters = "abcdefghijklmnoprstuvw"
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def corpus():
    """Texts with copies, edited copies, shared passages, odd white space, data, nulls and ties."""
    rng = random.Random(5)
    base = [sentence(rng, rng.choice((3, 20, 60, 120, 200))) for _ in range(30)]
    passage = sentence(rng, 70)
    texts = list(base)
    texts += base[2:8] + [base[4]] * 3  # exact copies
    for text in base[:12]:  # edited copies
        words = text.split()
        words[len(words) // 2] = "edited"
        texts.append(" ".join(words))
    texts += [f"{sentence(rng, 30)} {passage} {sentence(rng, 40)}" for _ in range(5)]
    texts += [None, None, "", " \n\t ", "one", "One two", "one two three", "a" * 5000, "12 34 !!", "\x0b\x0cx\x1cy é中 😀"]
    texts += [sentence(rng, 3000) + " " + passage, "Mail bo.li@mail3.example.com or call +1 (269) 555-3296 4524132264652876 now.",
              "From 10.20.30.40 and 300.1.1.1 with 4041894974608795.", "UPPER " + base[3].upper()]
    rows = []
    for i, text in enumerate(texts):
        rows.append((i * 3 % 997, text, None if i % 11 == 0 else ("xx", "yy")[i % 2], None if i % 7 == 0 else f"h{i % 3}",
                     len(text or ""), "n", i, 0.5, "w"))
    rows += [rows[5], rows[5], rows[31], (None, base[1], "xx", "h1", 1, None, None, None, None),
             (None, base[1], "xx", "h1", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
