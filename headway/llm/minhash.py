"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document's set of distinct 3-word shingles (lower-cased A-Z), each shingle
   as its 64-bit hash, and its MinHash signature of ``HASHES`` values (multiply-add
   hash functions modulo 2^64, least value a set), by NumPy over blocks of text.
   Written are the set's size, two hashes of the whole set and a bucket for each of
   ``BANDS`` bands of ``ROWS`` values, so a document takes as much room as any other.
2. Exact copies of a set are folded first: one representative per set (its
   smallest doc_id), told by two independent hashes of the whole set; copies link
   to it.
3. In a bucket every representative is paired with the bucket's smallest one (its
   star) only, so a bucket of m members gives m - 1 pairs, never m^2. Sets and
   signatures are made again for members of buckets of two or more, and only theirs
   are written and joined.
4. A pair's signatures are compared in batches of ``BATCH`` positions. After each
   batch the posterior of the similarity (uniform prior, Beta posterior) is asked
   how likely a similarity at the threshold still is; below ``MISS`` the pair is
   pruned. Survivors are verified exactly on their full sets.
5. Where a bucket then still holds several components, its members of different
   components take the sequential test with one another, by NumPy over signatures
   (larger buckets by pairs of blocks), and survivors are verified on their full sets
   in the same place. Only links that join two components leave it, fewer than there
   are members, and a pair is looked at in the first of its common buckets alone.
   Members of one component need no test, so components equal those of all candidate
   pairs.
6. Components of the links (smallest doc_id reachable) by the shared
   large-star/small-star rounds.

Sets hold 64-bit hashes of shingles: two different shingles that share a hash
(odds about 2^-64 a pair) would count as one. Heavy keys (stars, buckets, sets)
are joined through the library's skew-aware lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import batches, ready, stage
from headway.llm.components import components
from headway.llm.hashing import SEGMENT, mixed, range_hashes
from headway.operators.skew import fits_broadcast, lookup

# Fixed values of the contract.
SHINGLE = 3
THRESHOLD = (85, 100)  # 100 * |A & B| >= 85 * |A | B|

#: Signature length, bands and values per band (BANDS * ROWS == HASHES).
HASHES, BANDS, ROWS = 128, 32, 4
#: Signature positions compared per step of the sequential test.
BATCH = 16
#: Chance, per step, to prune a pair whose similarity is at the threshold.
MISS = 1e-6
#: Bytes of text whose sets are held at once.
BLOCK = 1 << 20
#: Members of a bucket, or of a block of a larger one, that are compared in one place,
#: and the values of their sets.
MEMBERS, VALUES = 4096, 1 << 22


def _fewest_matches(looked: int) -> int:
    """Fewest equal positions among ``looked`` that keep a pair alive.

    With a uniform prior the posterior after m equal of n is Beta(m + 1, n - m + 1),
    and P(s >= t) = P(Binomial(n + 1, t) <= m). The pair is pruned when that is
    below ``MISS``.
    """
    t = THRESHOLD[0] / THRESHOLD[1]
    tail = 0.0
    for m in range(looked + 1):
        tail += comb(looked + 1, m) * t**m * (1 - t) ** (looked + 1 - m)
        if tail >= MISS:
            return m
    return looked + 1


LOOKS = [(n, _fewest_matches(n)) for n in range(BATCH, HASHES + 1, BATCH)]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.ones(256, dtype=bool)
_INSIDE[[0x20, *range(0x09, 0x0E)]] = False
_MIX = np.uint64(0x9FB21C651E98DF25)


def _word_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words [first, end) of some bytes, a segment of bytes at once."""
    out, at = np.empty(len(first), np.uint64), 0
    while at < len(first):
        upto = int(np.searchsorted(end, first[at] + SEGMENT, side="right"))
        if upto > at:
            lo, hi = first[at], end[upto - 1]
            out[at:upto] = range_hashes(data[lo:hi], first[at:upto] - lo, end[at:upto] - lo)
        else:  # a word longer than a segment
            upto = at + 1
            digest = hashlib.blake2b(data[first[at] : end[at]].tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(digest, "little")
        at = upto
    return mixed(out)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _MIX + right)


def shingle_sets(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, one text behind another, and where they start.

    Null or word-less text: an empty set. Fewer than three words: the whole word
    sequence is the one shingle.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
    data, offsets = _LOWER[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    inside = _INSIDE[data]
    heads = offsets[:-1][np.diff(offsets) > 0]
    starts, stops = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    starts[heads] = inside[heads]
    stops[heads[1:] - 1] = inside[heads[1:] - 1]
    first, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    word = _word_hashes(data, first, end)
    upto = np.searchsorted(first, offsets)
    words = np.diff(upto)
    sizes = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    # The word that each shingle starts with; texts of one or two words are told apart by a salt.
    head = np.arange(begin[-1]) + np.repeat(upto[:-1] - begin[:-1], sizes)
    many = np.repeat(words, sizes)
    shingles = word[head]
    two = many >= 2
    shingles[two] = _joined(shingles[two], word[head[two] + 1])
    three = many >= SHINGLE
    shingles[three] = _joined(shingles[three], word[head[three] + 2])
    shingles[~three] = mixed(shingles[~three] ^ many[~three].astype(np.uint64))
    values = shingles.view(np.int64)
    for lo, hi in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
        values[lo:hi].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[begin[:-1][sizes > 0]] = True
    return values[fresh], np.concatenate(([0], np.cumsum(fresh)))[begin]


#: Hash functions h_i(x) = A_i * x + B_i (mod 2^64) over the 64-bit shingle hashes.
_RNG = np.random.Generator(np.random.PCG64(0x5EED))
A = _RNG.integers(1, 1 << 63, size=HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _RNG.integers(0, 1 << 63, size=HASHES, dtype=np.uint64)
#: Set values a slice of the signature pass holds at once: they stay in a core's cache.
SLICE_VALUES = 1 << 14


def _signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """MinHash signatures of the sets ``values[begin[i]:begin[i + 1]]``; zeros for empty ones."""
    values = values.view(np.uint64)
    sizes = np.diff(begin)
    out = np.zeros((HASHES, len(sizes)), dtype=np.uint64)
    rows = np.flatnonzero(sizes > 0)
    cuts = np.searchsorted(np.cumsum(sizes[rows]), np.arange(SLICE_VALUES, sizes.sum() + SLICE_VALUES, SLICE_VALUES))
    for part in np.split(rows, np.unique(cuts[cuts < len(rows)]) + 1):
        if not len(part):
            continue
        chunk = values[begin[part[0]] : begin[part[-1] + 1]]
        starts = begin[part] - begin[part[0]]
        hashed = np.empty(len(chunk), np.uint64)
        for i in range(HASHES):
            np.multiply(chunk, A[i], out=hashed)
            np.add(hashed, B[i], out=hashed)
            out[i, part] = np.minimum.reduceat(hashed, starts)
    return np.ascontiguousarray(out.T)


def signatures(sets: pa.ListArray) -> pa.Array:
    """MinHash signatures (``HASHES`` longs) of a batch of sets; null for an empty or null set."""
    sets = sets.cast(pa.large_list(pa.int64()))
    begin = np.asarray(sets.offsets, dtype=np.int64)
    out = _signatures(np.asarray(sets.values.fill_null(0), dtype=np.int64), begin)
    flat = pa.array(out.view(np.int64).ravel())
    listed = pa.FixedSizeListArray.from_arrays(flat, HASHES).cast(pa.list_(pa.int64()))
    return pc.if_else(pa.array(np.diff(begin) > 0), listed, pa.nulls(len(sets), listed.type))


def _band_hashes(sig: np.ndarray) -> np.ndarray:
    """A bucket for each band (columns) of each signature; buckets of two bands never agree but by chance."""
    values = sig.reshape(len(sig), BANDS, ROWS)
    out = np.broadcast_to(mixed(np.arange(1, BANDS + 1, dtype=np.uint64)), values.shape[:2])
    for i in range(ROWS):
        out = _joined(out, values[:, :, i])
    return out


def _column(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values))


def _totals(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums, modulo 2^64, of each set's values; zero for empty ones."""
    out = np.zeros(len(begin) - 1, np.uint64)
    rows = np.flatnonzero(np.diff(begin) > 0)
    if len(rows):
        out[rows] = np.add.reduceat(values, begin[rows])
    return out.view(np.int64)


def _banded(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in batches(frames, BLOCK, "text"):
        values, begin = shingle_sets(block["text"])
        bands = _band_hashes(_signatures(values, begin)).view(np.int64)
        held = values.view(np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                block["doc_id"].combine_chunks(),
                pa.array(np.diff(begin)),
                pa.array(_totals(mixed(held), begin)),
                pa.array(_totals(mixed(held ^ _MIX), begin)),
                _column(bands.ravel(), np.arange(len(bands) + 1) * BANDS),
            ],
            ["doc_id", "n_shingles", "set_key", "set_check", "buckets"],
        )


def _signed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in batches(frames, BLOCK, "text"):
        values, begin = shingle_sets(block["text"])
        sets = _column(values, begin)
        yield pa.RecordBatch.from_arrays(
            [block["doc_id"].combine_chunks(), sets, signatures(sets)], ["doc_id", "hashes", "sig"]
        )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (x, y) and ``linked``: passed the sequential test, then the exact check.

    Signatures are joined first; full sets only for pairs that the test left alive.
    ``sets`` holds those of the members of crowded buckets only.
    """
    sig = lambda side: sets.select(F.col("doc_id").alias(side), F.col("sig").alias(f"s{side}"))
    both = lookup(lookup(pairs, sig("x"), ["x"]), sig("y"), ["y"])
    # Running number of equal positions after each batch; pruned at the first look that falls short.
    running = F.lit(0)
    alive = F.lit(True)
    for looked, fewest in LOOKS:
        batch = F.aggregate(
            F.sequence(F.lit(looked - BATCH + 1), F.lit(looked)),
            F.lit(0),
            lambda acc, i: acc + F.when(F.element_at("sx", i) == F.element_at("sy", i), 1).otherwise(0),
        )
        running = running + batch
        alive = alive & (running >= fewest)
    survivors = both.filter(alive).select("x", "y")
    full = lambda side: sets.select(F.col("doc_id").alias(side), F.col("hashes").alias(f"h{side}"))
    checked = lookup(lookup(survivors, full("x"), ["x"]), full("y"), ["y"])
    inter = F.size(F.array_intersect("hx", "hy"))
    union = F.size("hx") + F.size("hy") - inter
    linked = checked.filter(inter * THRESHOLD[1] >= union * THRESHOLD[0]).select(
        "x", "y", F.lit(True).alias("linked")
    ).distinct()
    return pairs.join(linked, ["x", "y"], "left").select("x", "y", F.coalesce("linked", F.lit(False)).alias("linked"))


def _dealt(members: DataFrame) -> DataFrame:
    """Members in order of buckets; buckets above ``MEMBERS`` or ``VALUES`` are dealt by pairs of blocks."""
    blocks = F.ceil(F.greatest(F.col("n") / MEMBERS, F.col("total") / VALUES)).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    dealt = dealt.select(
        "bucket", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "block", "doc_id", "root", "sig", "hashes",
    )
    keys = ["bucket", "lo", "hi"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def _alive(
    block: np.ndarray, doc: np.ndarray, root: np.ndarray, sig: np.ndarray,
    sizes: np.ndarray | None = None, earlier: np.ndarray | None = None,
) -> Iterator[tuple]:
    """Pairs of a bucket's members, of different components, that pass the sequential test.

    Not those whose ``sizes`` are too far apart for a link, nor those that meet in a
    bucket of ``earlier`` (columns) already. ``root`` may change between two pairs.
    """
    across = block.min() != block.max()  # members of one block meet where that block is alone
    for i in range(len(doc) - 1):
        keep = root[i + 1 :] != root[i]
        if across:
            keep &= block[i + 1 :] != block[i]
        if sizes is not None:
            least, most = np.minimum(sizes[i + 1 :], sizes[i]), np.maximum(sizes[i + 1 :], sizes[i])
            keep &= least * THRESHOLD[1] >= most * THRESHOLD[0]
        other = np.flatnonzero(keep) + i + 1
        if earlier is not None and len(other):
            other = other[~(earlier[other] == earlier[i]).any(axis=1)]
        same = np.zeros(len(other), np.int64)
        for looked, fewest in LOOKS:
            same += (sig[other, looked - BATCH : looked] == sig[i, looked - BATCH : looked]).sum(axis=1)
            other, same = other[same >= fewest], same[same >= fewest]
            if not len(other):
                break
        if len(other):
            yield np.minimum(doc[other], doc[i]), np.maximum(doc[other], doc[i])


def _links(
    bucket: int, block: np.ndarray, doc: np.ndarray, root: np.ndarray, sig: np.ndarray,
    values: np.ndarray, sizes: np.ndarray,
) -> tuple[list, list]:
    """Links (x, y) of a bucket's members, checked on full sets, that join two components each."""
    bands = _band_hashes(sig.view(np.uint64)).view(np.int64)
    own = int(np.argmax((bands == bucket).any(axis=0)))
    root, begin, x, y = root.copy(), np.concatenate(([0], np.cumsum(sizes))), [], []
    known = None
    for one, others in _alive(block, np.arange(len(doc)), root, sig, sizes, bands[:, :own]):
        if known is None:  # values that one set alone has are common to none
            _, number, count = np.unique(values, return_inverse=True, return_counts=True)
            shared = count > 1
            known = (np.cumsum(shared) - 1)[number[shared[number]]]
            begin = np.concatenate(([0], np.cumsum(shared[number])))[begin]
            held = np.zeros(int(shared.sum()), dtype=bool)
        i = int(one[0])
        held[known[begin[i] : begin[i + 1]]] = True
        lengths = begin[others + 1] - begin[others]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(begin[others] - (ends - lengths), lengths)
        upto = np.concatenate(([0], np.cumsum(held[known[at]])))
        inter = upto[ends] - upto[ends - lengths]
        held[known[begin[i] : begin[i + 1]]] = False
        union = sizes[i] + sizes[others] - inter
        linked = others[inter * THRESHOLD[1] >= union * THRESHOLD[0]]
        roots, first = np.unique(root[linked], return_index=True)
        for j in linked[first].tolist():
            x.append(int(doc[i]))
            y.append(int(doc[j]))
        root[np.isin(root, roots)] = root[i]
    return x, y


def _compared(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (x, y) of rows of :func:`_dealt`, a bucket or pair of blocks at a time."""

    def compared(bucket: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        x, y = _links(bucket, *(np.concatenate(c) for c in zip(*held, strict=True)))
        if x:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

    now, held = None, []
    for frame in frames:
        keys = np.stack([frame.column(i).to_numpy().astype(np.int64) for i in range(3)])
        edges = np.flatnonzero(np.any(keys[:, 1:] != keys[:, :-1], axis=0)) + 1
        columns = [frame.column(i).to_numpy() for i in (3, 4, 5)]
        columns.append(frame.column(6).flatten().to_numpy().reshape(-1, HASHES))
        values, sizes = frame.column(7).flatten().to_numpy(), pc.list_value_length(frame.column(7)).to_numpy()
        sizes = sizes.astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(sizes)))
        for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), frame.num_rows], strict=True):
            if hi > lo:
                if held and now != tuple(keys[:, lo]):
                    yield from compared(now[0], held)
                    held = []
                now = tuple(keys[:, lo])
                held.append((*(c[lo:hi] for c in columns), values[begin[lo] : begin[hi]], sizes[lo:hi]))
    if held:
        yield from compared(now[0], held)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every input row (see module docstring).

    Repeated rows come back repeated and share their doc_id's component. A row with
    a null doc_id is linked with nothing: its component_id is null and it is kept.
    Documents with an empty set link with nothing. An empty table gives no rows.
    Exact copies of a set are told by two independent 64-bit hashes of the whole set.
    """
    ready(documents.sparkSession)
    texts = documents.select("doc_id", "text")
    sets = stage(
        texts.mapInArrow(
            _banded, "doc_id long, n_shingles long, set_key long, set_check long, buckets array<long>"
        ),
        "minhash-sets",
    )
    usable = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    # Exact copies: one representative a set, the others link to it. A set decides its buckets.
    firsts = stage(
        usable.groupBy("set_key", "set_check").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("buckets").alias("buckets"),
            F.first("n_shingles").alias("size"),
        ),
        "minhash-firsts",
    )
    copied = firsts.filter("n > 1").select("set_key", "set_check", "rep")
    copies = lookup(usable.select("doc_id", "set_key", "set_check"), copied, ["set_key", "set_check"], "inner")
    copy_links = copies.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    banded = firsts.select(F.col("rep").alias("doc_id"), "size", F.explode("buckets").alias("bucket"))
    crowded = stage(
        banded.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("star"))
        .filter("n > 1")
        .select("bucket", "star", "n"),
        "minhash-crowded",
    )
    # Large buckets are split by adaptive skew handling: a bucket has one row on the right.
    members = stage(banded.join(crowded, "bucket"), "minhash-members")
    nodes = stage(members.select("doc_id").distinct(), "minhash-nodes")
    near = texts.join(nodes if fits_broadcast(nodes) else nodes.hint("shuffle_hash"), "doc_id", "left_semi")
    near = near.mapInArrow(_signed, "doc_id long, hashes array<long>, sig array<long>").filter("sig is not null")
    near = stage(near, "minhash-near")

    to_star = members.filter("doc_id <> star").select(F.col("doc_id").alias("x"), F.col("star").alias("y"))
    star_links = stage(_verified(stage(to_star.distinct(), "minhash-pairs"), near), "minhash-star")
    linked = star_links.filter("linked").select(F.col("x").alias("u"), F.col("y").alias("v"))
    known = stage(components(linked.unionByName(copy_links)), "minhash-known")
    # In buckets that still hold several components, members of different ones are compared.
    labels = known.select(F.col("node").alias("doc_id"), F.col("root").alias("root"))
    labelled = lookup(members.filter("n > 2").select("doc_id", "bucket", "n", "size"), labels, ["doc_id"]).select(
        "doc_id", "bucket", "n", "size", F.coalesce("root", "doc_id").alias("root")
    )
    labelled = stage(labelled, "minhash-labelled")
    open_ = (
        labelled.groupBy("bucket")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.sum("size").alias("total"))
        .filter("lo <> hi")
        .select("bucket", "total")
    )
    left = labelled.join(open_, "bucket").join(near.select("doc_id", "sig", "hashes"), "doc_id")
    rest = stage(_dealt(left).mapInArrow(_compared, "x long, y long").distinct(), "minhash-others")

    edges = known.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(
        rest.select(F.col("x").alias("u"), F.col("y").alias("v"))
    )
    roots = components(edges).select(F.col("node").alias("doc_id"), F.col("root").alias("_root"))
    out = lookup(sets.select("doc_id", "n_shingles"), roots, ["doc_id"])
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def digest(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents)
