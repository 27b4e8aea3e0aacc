"""Round 6: wavelet planes dealt in parts that stay in a core's cache; pieces listed without scalars."""

import numpy as np
import pyarrow as pa
import pytest

from headway.llm import tokens, wavelet


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_planes_are_dealt_in_parts(monkeypatch, n):
    monkeypatch.setattr(wavelet, "PART", 64)
    parts, dealt = [], wavelet._parts

    def watched(ones, zeros):
        for part in dealt(ones, zeros):
            parts.append(len(part[3]) + len(part[4]))
            yield part

    monkeypatch.setattr(wavelet, "_parts", watched)
    ids = np.random.default_rng(n).integers(0, 50_000, n).astype("<u2")
    file = wavelet.WaveletFile(wavelet.build(ids, np.array([7]), np.array([0, n])))
    assert np.array_equal(file.decode(), ids)
    assert sum(parts) == 2 * 16 * n and max(parts, default=0) <= 64
    level = ids
    for plane in range(16):
        ones = level >> (15 - plane) & 1
        assert np.array_equal(np.unpackbits(file.bits[plane], count=n, bitorder="little"), ones)
        level = np.concatenate((level[ones == 0], level[ones == 1]))


def test_pieces_are_listed_as_they_are():
    values = pa.array([b"", b"a", "é".encode(), b"", b"xyz"], pa.large_binary())
    assert tokens._listed(values) == values.to_pylist()
    assert tokens._listed(values.slice(1, 3)) == values.slice(1, 3).to_pylist()
    assert tokens._listed(values.slice(0, 0)) == []
