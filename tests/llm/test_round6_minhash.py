"""Round 6: buckets of near texts that are no links leave no row a pair."""

import random

import pytest
from test_round3 import _brute_components

from headway.llm import minhash


@pytest.mark.parametrize(("members", "values"), [(4096, 1 << 22), (16, 1 << 22), (4096, 4000)])
def test_minhash_members_below_the_threshold_give_links_only(spark, monkeypatch, members, values):
    """Texts that share most of their shingles with each other, but few of them enough."""
    written, stage = {}, minhash.stage

    def watched(df, label):
        out = stage(df, label)
        written[label] = out
        return out

    monkeypatch.setattr(minhash, "MEMBERS", members)
    monkeypatch.setattr(minhash, "VALUES", values)
    monkeypatch.setattr(minhash, "stage", watched)
    r = random.Random(3)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    rows = [(0, " ".join(base[:40]))]
    for doc in range(1, 60):
        words = list(base)
        for at in r.sample(range(200), 2 if doc % 6 == 0 else 5):
            words[at] = f"w{r.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    got = minhash.digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = _brute_components(rows)
    assert {x.doc_id: x.component_id for x in got} == want
    assert 2 < len(set(want.values())) < len(rows)
    others = written["minhash-others"].collect()
    text = dict(rows)
    for x, y in others:
        assert len(set(_brute_components([(x, text[x]), (y, text[y])]).values())) == 1
    assert len(others) < len(rows) * 4
