"""Round 5: buckets of MinHash bands compared without a row a pair."""

import random

import numpy as np
import pytest

from headway.llm import minhash


@pytest.mark.parametrize("members", [4096, 3])
def test_minhash_links_members_beside_the_star(spark, monkeypatch, members):
    """A chain: texts link to the next one, but not to the smallest of their bucket."""
    monkeypatch.setattr(minhash, "MEMBERS", members)
    r, rows = random.Random(11), []
    for group in range(3):
        words = [f"w{r.randrange(10**6)}" for _ in range(300)]
        for step in range(12):
            rows.append((100 * group + step, " ".join(words)))
            for at in r.sample(range(300), 6):
                words[at] = f"w{r.randrange(10**6)}"
    r.shuffle(rows)
    got = minhash.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    from test_round3 import _brute_components

    assert {x.doc_id: x.component_id for x in got} == _brute_components(rows)
    assert len({x.component_id for x in got}) < 12


def test_minhash_compares_a_bucket_without_a_row_a_pair():
    sig = np.random.default_rng(5).integers(0, 1 << 60, (400, minhash.HASHES))
    sig[7] = sig[300]
    doc, root = np.arange(400), np.arange(400)
    zero = np.zeros(400, np.int64)
    pairs = [(int(a), int(b)) for x, y in minhash._alive(zero, doc, root, sig) for a, b in zip(x, y)]
    assert pairs == [(7, 300)]
    assert list(minhash._alive(zero, doc, np.zeros(400), sig)) == []
