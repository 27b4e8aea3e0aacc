"""The training-data operators against brute force, on a small table and on odd rows."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from headway.llm import chat, decontaminate, kneser, packing, pages, repeats, shards, simhash, topk, wavelet
from headway.llm.dom import blocks, parse
from headway.llm.queries import ORACLES, QUERIES
from headway.llm.tokens import encoder, vocabulary_path

SF = "/root/testdata/sf0.001"
PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of light and shade for all"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Documents with nulls, empty, repeated, white and very long texts, and odd columns."""
    words = random.Random(1)
    long = " ".join("".join(words.choices("abcdefgh", k=words.randint(1, 9))) for _ in range(40_000))
    rows = [
        (1, PASSAGE + " one two three", "en", "a"),
        (2, "  " + PASSAGE.upper() + "\n\n x  \t y", "en", "a"),
        (3, None, None, None),
        (4, "", "en", ""),
        (5, " \t\n ", "xx", "a"),
        (6, long, "en", "b"),
        (7, long[:5000] + "é" + long[5001:9000], "fr", "b"),
        (8, "ab" * 200, "en", "c"),
        (9, PASSAGE + " one two three", "en", "a"),
        (9, PASSAGE + " one two three", "en", "a"),
        (9, "other text of the same number", "en", "a"),
        (None, PASSAGE + " null id", "en", "a"),
        (12, "<|endoftext|> a  b   c \n d", "en", "c"),
    ]
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for name in ("fp", "row", "bucket", "ids", "queue", "chunk", "key", "u", "pid"):  # names of helpers
        df = df.withColumn(name, F.lit("x"))
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(params=["table", "odd", "empty"])
def any_docs(request, docs, odd):
    return {"table": docs, "odd": odd, "empty": odd.limit(0)}[request.param]


def rows_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def first(key):
    return (key is not None, key)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "embeddings", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    mine = QUERIES[name](spark, SF)
    names = sorted(mine.columns)
    theirs = con.sql(ORACLES[name])
    assert sorted(theirs.columns) == names
    want = sorted(map(str, theirs.select(", ".join(names)).fetchall()))
    assert sorted(str(tuple(r)) for r in mine.select(names).collect()) == want


def test_chat_odd_turns(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "a\\<s>"), (1, 1, "assistant", "</s>\\"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("e", F.lit(1))
    got = {r.conv_id: r for r in chat.digest(df).collect()}
    said = "user\n\n" + "\na\\<s>\n" + "assistant\n</s>\\\n"
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[1].loss_chars == 5 and got[None].loss_chars == 0 and got[None].n_turns == 1
    assert chat.digest(df.limit(0)).count() == 0


def test_simhash(any_docs):
    def fp(t):
        w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
        import xxhash

        s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    data = rows_of(any_docs)
    prints = [fp(t) for _, t in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(data):
        r = root(i)
        least[r] = min(least.get(r, (True, 0)), (d is None, d or 0))
    want = sorted(str((d, f"{p:016x}", None if least[root(i)][0] else least[root(i)][1])) for i, ((d, _), p) in enumerate(zip(data, prints)))
    got = simhash.digest(any_docs).collect()
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert sum(r.kept for r in got) == len(least)


def test_simhash_crowded_bucket(spark):
    base = 0x0123456789ABCDEF
    prints = [base ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    from headway.llm.components import components

    for bucket in (20, 1 << 16):
        got = components(simhash.links(df, bucket)).select("root").distinct().count()
        assert got == 1


def test_wavelet_and_packing(any_docs):
    data = rows_of(any_docs)
    tokenizer = encoder(vocabulary_path()).tokenizer
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for _, t in data]

    def crc(x):
        return zlib.crc32(np.array(x, "<u4").tobytes())

    got = wavelet.digest(any_docs).collect()
    assert sorted((first(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (first(d), len(x) + 1, crc([*x, 0])) for (d, _), x in zip(data, ids)
    )
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    pieces = packing.pack(any_docs).collect()
    assert sum(p.length for p in pieces) == sum(len(x) + 1 for x in ids)
    places = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    for (s, o, n), (t, q, _) in zip(places, places[1:]):
        assert (t, q) == ((s, o + n) if o + n < 2048 else (s + 1, 0))
    known = {(first(d), len(x) + 1): [*x, 1] for (d, _), x in zip(data, ids)}
    for p in pieces:
        own = known[first(p.doc_id), p.doc_tokens]
        assert p.ids_crc32 == crc(own[p.start : p.start + p.length])


def test_packing_proportions(spark, docs):
    mixed = docs.withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b"))
    pieces = packing.pack(mixed, weights={"a": 3.0, "b": 1.0}).groupBy("sequence_id", "queue").agg(F.sum("length")).collect()
    totals = {(r[0], r[1]): r[2] for r in pieces}
    both = [w for w in range(20) if (w, 0) in totals and (w, 1) in totals]
    assert both and all(abs(totals[w, 0] - 1536) <= 1 for w in both)


def test_wavelet_queries():
    ids = np.random.default_rng(3).integers(0, 300, 5000).astype(np.uint16)
    one = wavelet.WaveletFile(wavelet.build(ids, np.array([1, 2]), np.array([0, 2000, 5000])))
    assert (one.decode() == ids).all()
    for token in (0, 7, 299, 40_000):
        where = np.flatnonzero(ids == token)
        assert one.count(token) == len(where) and one.rank(token, 777) == (where < 777).sum()
        assert [one.select(token, k) for k in range(len(where))] == where.tolist()
    assert [one.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()


def test_shards(any_docs):
    got = sorted(shards.assign(any_docs, 5).collect(), key=lambda r: r.first_byte)
    data = rows_of(any_docs)
    assert sorted((first(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (first(d), len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in data
    )
    total, at, slots = sum(len(t.encode()) + 8 for _, t in data), 0, {}
    for r in got:
        assert r.first_byte == at and r.shard == (2 * at + r.size) * 5 // (2 * total)
        assert r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
        at += r.size


def test_topk_odd_vectors(spark):
    same = [float(i % 3) for i in range(8)]
    rows = [(i, same) for i in range(0, 60)] + [(60, None), (61, [1.0, None]), (62, [float("nan")] * 8), (63, []), (64, [2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("row", F.lit("x"))
    got = sorted((r.query_id, r.rank, r.vec_id) for r in topk.digest(df).collect())
    assert [x for x in got if x[0] == 20] == [(20, k + 1, k) for k in range(20)]
    assert {x[0] for x in got} == {0, 20, 40} and topk.digest(df.limit(0)).count() == 0


def test_repeats(any_docs):
    data = sorted({(d, t) for d, t in rows_of(any_docs)}, key=lambda x: (first(x[0]), simhash_order(any_docs, x[1])))
    seen, want = set(), {}
    for d, t in data:
        b = t.encode()
        gone = np.zeros(len(b) + 1, dtype=int)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p] += 1
                gone[p + 100] -= 1
            seen.add(b[p : p + 100])
        mask = np.cumsum(gone[: len(b)]) > 0
        left = bytes(np.frombuffer(b, np.uint8)[~mask])
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        want[d, len(b), hashlib.sha256(left).hexdigest()] = (int(mask.sum()), runs)
    got = repeats.digest(any_docs).collect()
    assert len(got) == any_docs.count()
    for r in got:
        assert want[r.doc_id, r.n_bytes, r.kept_sha256] == (r.n_removed, r.n_spans)


def simhash_order(df, text):
    hashes = df.sparkSession.range(1).select(F.shiftrightunsigned(F.xxhash64(F.lit(text)), 32)).first()[0]
    return hashes


def test_leaks(spark, odd):
    changed = PASSAGE.replace("quick", "rapid").replace("lazy ", "")
    items = spark.createDataFrame([(1, changed), (2, None), (3, "short one"), (4, "words that no text holds " * 4)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.digest(odd, items).collect()}
    assert got == {(d, 1) for d in (1, 2, 9, None)}
    assert decontaminate.digest(odd.limit(0), items).count() == 0 and decontaminate.digest(odd, items.limit(0)).count() == 0


def test_quality(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in kneser.digest(docs, labels).collect()}
    assert len(got) == docs.count()
    marked = {r.doc_id: r for r in labels.collect()}
    good = [got[d].keep for d, m in marked.items() if m.quality == 1 and not m.toxic and d in got]
    bad = [got[d].keep for d, m in marked.items() if m.quality == 0 and d in got]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.5
    strange = kneser.digest(odd, labels.limit(0)).collect()
    assert sum(r.keep for r in strange) == sum(1 for r in strange if r.n_bytes) and len(strange) == 13
    assert kneser.digest(odd.limit(0), labels).count() == 0


def test_kneser_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([("abracadabra abba cabal",), ("a b c",)], "text string")
    model = kneser.train(df).toPandas()
    tables = [tuple(model[model.kind == k].sort_values("key")[c].to_numpy() for c in ("key", "value")) for k in (0, 1)]
    for context in (b"abra", b"zzzz", b"zaba"):
        head = (1 << 32) | int.from_bytes(context, "big")
        p = np.exp(kneser.log_probabilities((head << 8) | np.arange(256), *tables))
        assert p.sum() == pytest.approx(1.0)


def test_pages(spark):
    rows = [
        (1, "u", "<nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>One  <b>two\n three<p>Four&nbsp;five.</article><footer>&copy; me</footer>"),
        (2, "u", None), (3, "u", ""), (4, None, "<script>x</script>"), (None, "u", "<p"),
    ]
    got = {r.page_id: r for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(0))).collect()}
    assert got[1].text == "A & B\nOne two three\nFour five." and got[1].n_chars == len(got[1].text)
    assert [got[k].text for k in (2, 3, 4, None)] == [""] * 4


def test_pages_held_out():
    trees = pages.model()
    x, y = pages.training(60, 99)
    assert ((trees.predict(x) > 0) == (y > 0)).mean() > 0.97
    nodes = parse("<div><p>a<br>b<!-- c --> <span>d</span></div><ul><li>e<li>f</ul>")
    assert blocks(nodes, np.ones(len(nodes), bool)) == ["a b d", "e", "f"]


def test_pipeline(spark, docs):
    frame, counts = docs, []
    for name, step in corpus_pipeline.STAGES[:-1]:
        frame = step(spark, frame, SF)
        assert frame.columns == docs.columns
        frame = corpus_pipeline.stage(frame, name)
        counts.append(frame.count())
    assert docs.count() > counts[0] >= counts[-1] > 0
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_latent_sample_is_the_least_hashes(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "SAMPLE", 8)
    _, known = decontaminate.weights(docs)
    least = docs.filter("text is not null").orderBy(F.xxhash64("doc_id", "text")).limit(8)
    assert known == docs.filter("text is not null").count() > 16
    got = sorted(r.text for r in decontaminate.sampled(docs, known).collect())
    assert len(got) == 8 and got == sorted(r.text for r in least.collect())
