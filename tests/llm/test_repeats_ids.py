import random

import pytest

from .test_repeats import brute, run


@pytest.mark.parametrize("same", [None, 7])
def test_rows_of_one_id_are_told_apart(spark, same):
    rng = random.Random(4)
    passage = [rng.randbytes(80).hex() for _ in range(40)]
    rows = []
    for _ in range(2500):
        own = rng.randbytes(rng.randrange(20, 60)).hex()
        cut = rng.randrange(0, 40)
        rows.append((same, own + rng.choice(passage)[cut:] + own[::-1] if rng.random() < 0.5 else own + own[::-1] + own))
    assert run(spark, rows) == brute(rows)
