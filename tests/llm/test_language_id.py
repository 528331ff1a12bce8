import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnloom.llm import language_id


@pytest.fixture(scope="module")
def net(spark, sf):
    return language_id.learn(spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet"))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = language_id.new_network(["a", "b", "c"], 3, 1)
    x, size, y = rng.integers(0, 256, (7, 5)).astype(np.uint8), np.array([7, 7, 4, 1, 6]), np.array([0, 1, 2, 1, 0])

    def loss():
        valid = (np.arange(7)[:, None] < size[None, :]).astype(np.float32)
        both = np.concatenate([language_id._run(net, s, x, valid) for s in (0, 1)], axis=1).astype(np.float64)
        z = net.v @ both + net.b
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        return -(np.log(p[:, y, np.arange(5)]) * valid).sum() / valid.sum()

    grads = language_id._gradients(net, x, size, y)
    worst = 0.0
    for a, g in zip(net.arrays(), grads):
        for i in np.argsort(-np.abs(g).ravel())[:4]:
            at = np.unravel_index(i, a.shape)
            old = a[at]
            a[at] = old + 2e-3
            up = loss()
            a[at] = old - 2e-3
            down = loss()
            a[at] = old
            worst = max(worst, abs((up - down) / 4e-3 - g[at]) / (abs(g[at]) + 1e-3))
    assert worst < 0.05


def test_held_out_accuracy(spark, net):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = language_id.predict(docs, net).withColumn("out", language_id.held_out(F.col("doc_id"))).collect()
    assert len(told) == 1000
    tested = [r for r in told if r["out"]]
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["out"] for r in told)
    assert sum(r["lang"] == r["lang_pred"] for r in tested) / len(tested) > 0.95
    assert all(0 <= r["score"] <= 1 for r in told)


def test_pooling_is_the_mean_over_positions(net):
    text = ("Der Hund und die Katze sind nicht hier. " * 20).encode()
    x = np.frombuffer(text[:256], np.uint8)[:, None]
    h = net.hidden
    f, b = language_id._run(net, 0, x, None), language_id._run(net, 1, x, None)
    p = np.stack([language_id._softmax(net.v[:, :h] @ f[t] + net.v[:, h:] @ b[t] + net.b)[:, 0] for t in range(256)])
    assert np.allclose(language_id.pool(net, [text[:256]])[0], p.mean(axis=0), atol=1e-4)
    labels = language_id.label_positions(net, text)
    assert len(labels) == len(text) and set(labels) <= set(net.languages)
    many = [text, b"", text[:300], text[:1], text * 40]
    alone = np.concatenate([language_id.pool(net, [t]) for t in many])
    assert np.allclose(language_id.pool(net, many, chunk=8), alone, atol=1e-4)


def test_odd_texts(spark, net):
    rows = [(1, None, "x"), (2, "", "x"), (3, "123 ... \n", "x"), (4, "é", "x"), (5, "the " * 50_000, "x"), (None, "the and", "x"), (6, "日本", "x"), (6, "日本", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = language_id.predict(df, net).collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, True, False, False, False, False, False]
    assert [r["score"] for r in got][:3] == [0, 0, 0] and len(got) == 8
    assert language_id.predict(df.limit(0), net).collect() == []


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None), (None, "abc", "en")], "doc_id long, text string, lang string")
    net = language_id.learn(df)
    assert net.languages == []
    assert [r["lang_pred"] for r in language_id.predict(df, net).collect()] == ["und", "und"]


def test_learning_reads_no_held_out_rows(spark):
    rows = [(i, f"text {i}", "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    usable = ~language_id.held_out(F.col("doc_id"))
    texts, labels = language_id.training_sample(df, usable, "doc_id", "text", "lang", per_language=7)
    assert set(labels) == {"en"} and len(texts) == 7
