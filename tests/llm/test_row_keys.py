"""Rows without an id, or with one id, are documents of their own to the pipeline's join."""

from collections import Counter

import pytest

from pairmill.llm import ngram_join


def words(name, n=30):
    return " ".join(f"{name}{i}" for i in range(n))


@pytest.mark.parametrize("shift", [0, 1])
def test_keep_first_by_row(spark, shift):
    given = [
        (1, words("a")),
        (None, words("a")),  # a copy without an id
        (None, words("b")),  # unique texts without one
        (None, words("c")),
        (None, words("d")),  # copies that are all without one
        (None, words("d")),
        (7, words("e")),
        (7, words("e")),  # copies under one id
        (8, words("a")),  # a copy whose id a unique text has too
        (8, words("f")),
        (9, words("g")),  # the id decides, not the place
        (3, words("g") + " end"),
        ((1 << 63) - 1, words("h")),
        (None, words("h")),
        (None, None),
        (None, ""),
    ]
    given = given[::-1] if shift else given
    docs = spark.createDataFrame([(*r, "x") for r in given], "doc_id long, text string, row string").repartition(3)
    kept = ngram_join.keep_first(docs, k=5, num=8, den=10)
    assert kept.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in kept.collect())
    expected = [(1, words("a")), (None, words("b")), (None, words("c")), (None, words("d")), (7, words("e"))]
    expected += [(8, words("f")), (3, words("g") + " end"), ((1 << 63) - 1, words("h")), (None, None), (None, "")]
    assert found == Counter(expected)
