"""How texts meet before they are scored, against brute force."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from weftline.functions.fuzzy import _common, common_lengths, score
from weftline.operators import gates


def test_numbered_texts_meet_on_their_digits(spark):
    """Candidates of texts that numbers part are few more than the matches, and none is lost; texts with several numbers, long ones and none are among them."""
    draw = random.Random(3)
    number = lambda: str(draw.randrange(1, 200_000))
    a = {f"firm {number()}" for _ in range(500)} | {f"firm {number()} pvt ltd" for _ in range(100)} | {"firm 12 34", "firm 34 92", "2 firm 24", "plain", "plain names", f"firm {'123456789' * 4}"}
    b = {f"firm {number()}" for _ in range(300)} | {f"firm {number()} llp" for _ in range(100)} | {"firm 92 34", "firm 5 12", "24 firm", "plain name", "plan", f"firm {'123456789' * 3}12345678"}
    da, db = spark.createDataFrame([(x,) for x in sorted(a)], "x string"), spark.createDataFrame([(y,) for y in sorted(b)], "y string")
    for threshold in (80.0, 90.0):
        want = {(x, y) for x in a for y in b if score(x, y) >= threshold}
        assert {tuple(r) for r in gates.fuzzy_matches(da, db, threshold).select("x", "y").collect()} == want
    one = lambda df, c: df.where(F.col(c).rlike("^firm [0-9]{1,6}( |$)") & (F.size(F.split(c, "[0-9]+")) == 2))
    numbered = {(x, y) for x, y in want if x.startswith("firm") and y.startswith("firm")}
    assert gates.candidates(one(da, "x"), one(db, "y"), 90.0).count() < 2 * len(numbered) + 20


@pytest.mark.parametrize("most", [10, 1_000_000])
def test_blocks_of_any_size_give_the_pairs_of_all(spark, monkeypatch, most):
    """Small blocks are compared by bits and large ones meet on pieces; both give what comparing all texts gives."""
    monkeypatch.setattr(gates, "DIRECT", most)
    draw = random.Random(4)
    name = lambda: f"person{draw.randrange(60)} {draw.choice(['of', 'off', 'von'])} {draw.randrange(7)}{draw.choice(['', ' jr', ' é'])}"
    a, b = {(d, name()) for d in "pqr" for _ in range(3 if d == "r" else 25)}, {(d, name()) for d in "pqs" for _ in range(25)} | {("r", "person1 of 1")}
    da, db = spark.createDataFrame(sorted(a), "d string, x string"), spark.createDataFrame(sorted(b), "d string, y string")
    want = {(d, x, y) for d, x in a for e, y in b if d == e and score(x, y) >= 85}
    assert {tuple(r) for r in gates.fuzzy_matches(da, db, 85.0, "d").select("d", "x", "y").collect()} == want


def test_common_lengths_of_a_batch():
    texts = ["", "a", "abc", "person 12", "person 21", "é\U0001F600x", "x" * 32, "x" * 33, "a\0", "\0a"]
    pairs = [(x, y) for x in texts for y in texts]
    assert list(common_lengths(*(pd.Series(c) for c in zip(*pairs)))) == [_common(x, y) for x, y in pairs]
