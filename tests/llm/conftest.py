import random

import pytest

LONG = " ".join(random.Random(5).choice(["alpha", "beta", "gamma.", "Delta", "eps\nilon", "été"]) for _ in range(6000))
RUN = "".join(random.Random(6).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
SHARED = "The quick brown fox jumps over the lazy dog while seventeen grey herons watch from the far bank of the river. " * 3
TEXTS = [
    (17, " ".join(f"clean{chr(97 + k % 26)}{chr(97 + k // 26)} word" if k % 2 else "of the" for k in range(90))),
    (18, " ".join("".join(random.Random(k).choices("abcdefghij", k=6)) for k in range(90))),
    (1, SHARED + "one tail"), (2, "Another head. " + SHARED), (3, None), (4, ""), (5, "  \n\t "), (None, "no id here at all"),
    (6, LONG), (7, RUN + " " + RUN[::-1]), (8, "x<|endoftext|>y <|startoftext|> z  é́ İI don't 12,345 \x1c!"),
    (9, "same text"), (9, "same text"), (9, "other text of one id"), (10, "same text"), (-4, "negative id, " + SHARED[:150]),
    (11, "All rights reserved. CC BY and the GNU General Public License; all rights reserved"),
    (12, "mail a.b@c.de, +1 (555) 010-9999, 10.0.0.256 and 10.0.0.25, 4111 1111 1111 1111"), (13, "漢字 " * 40),
    (14, "word " * 300), (15, "line one\nline one\nline two\n" * 9), (16, "\U0001f600" * 70),
]
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, h bigint, fp int, key string, " \
      "tid string, row int, component string, spans string, ids int, n_tokens string, item_id string, diagonals int"


def frame(spark, texts):
    """Documents with extra columns whose names operators use inside, and nulls in every column."""
    rows = [(i, t, None if k % 3 else "en", "s" if k % 2 else None, None if t is None else len(t), k, None, "k", None, k,
             "c", None, 1, "n", "i", None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, TEXTS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
