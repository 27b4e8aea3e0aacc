"""Round 6: n-grams and log probabilities are shuffled packed."""

import numpy as np

from headway.llm import kneser


def test_keys_and_values_are_packed_without_loss():
    r = np.random.default_rng(4)
    texts = [" ".join("w%d" % w for w in r.zipf(1.3, 200) % 1000) for _ in range(400)]
    keys = kneser._unique(texts_of(texts))
    for some in (keys, keys[kneser._shard(keys >> 8) == 3], keys[:1], keys[:0]):
        data = kneser._packed(np.diff(some, prepend=0))
        assert np.array_equal(np.cumsum(kneser._unpacked(data, "<i8")), some)
    assert len(kneser._packed(np.diff(keys, prepend=0))) < len(keys) * 4
    values = r.standard_normal(1000).astype("<f4")
    assert np.array_equal(kneser._unpacked(kneser._packed(values), "<f4"), values)


def texts_of(texts):
    import pyarrow as pa

    return pa.chunked_array([texts])
