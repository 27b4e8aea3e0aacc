"""Round 4: bounded memory and whole training sets."""

import random

import numpy as np
import pyarrow as pa

from headway.llm import kneser, tokens


def test_pieces_of_odd_texts_have_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 50)
    signs = [
        " ", "  ", "\n", "\t", "a", "B", "hello", " ", "　", " ", " ", "᠎", "“", "日",
        "é", "×", "÷", "\x1c", "\x85", " ", "﻿", "'s", "12", "½", ".", "<|endoftext|>",
        "​", "\U0001f600", "Ж", "҂", "́", "\x00", "\x7f",
    ]
    pick = random.Random(4)
    texts = ["".join(pick.choices(signs, k=pick.randrange(0, 14))) for _ in range(5000)]
    encoder = tokens.Encoder(tokens.vocabulary_path())
    got, sizes = encoder.column(pa.array(texts, pa.string()).slice(3), b"\1\0")
    want = [np.append(encoder.tokenizer.encode(t, add_special_tokens=False).ids, 1).astype("<u2") for t in texts[3:]]
    assert got == [w.tobytes() for w in want]
    assert sizes.tolist() == [len(w) for w in want]
    assert len(encoder.pieces) <= 50
    assert encoder.column(pa.array([], pa.string()))[0] == [] and encoder.ids("") == b""


def test_kneser_trains_on_all_trusted_documents(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(kneser, "TRUSTED", 5, raising=False)
    seen = []
    train = kneser.train

    def watched(docs):
        seen.extend(r.text for r in docs.collect())
        return train(docs)

    monkeypatch.setattr(kneser, "train", watched)
    rows = [(i if i % 7 else None, f"text {i} of the corpus", "en") for i in range(400)]
    rows += [(5, "text again", "en"), (6, None, "en")]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id bigint, quality int, toxic int")
    assert kneser.classify(docs, labels).count() == len(rows)
    ids = kneser.trusted_ids(labels).filter("not held_out")
    want = docs.join(ids, "doc_id", "left_semi").select("text").collect()
    assert len(want) > 100
    assert sorted(map(str, seen)) == sorted(str(r.text) for r in want)
