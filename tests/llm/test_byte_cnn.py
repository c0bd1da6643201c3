import numpy as np

from tests.llm.frames import awkward, none
from vacanta.llm import byte_cnn as cnn
from vacanta.llm.queries import op10_byte_cnn


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = cnn.fresh(rng)
    net = cnn.Network(*(p.astype(np.float64) for p in net))
    data = rng.integers(97, 110, 900).astype(np.uint8)
    grad = cnn.Network(*(np.zeros_like(p) for p in net))
    cnn.gradients(net, data, 1, grad)
    loss = lambda: -np.log(cnn.probability(net, data))
    for part, found in zip(net, grad, strict=True):
        for spot in np.argsort(-np.abs(found).ravel())[:4]:
            old = part.flat[spot]
            part.flat[spot] = old + 1e-5
            up = loss()
            part.flat[spot] = old - 1e-5
            down = loss()
            part.flat[spot] = old
            assert abs((up - down) / 2e-5 - found.flat[spot]) < 1e-3 * (1 + abs(found.flat[spot]))


def test_blocks_give_what_one_convolution_gives():
    rng = np.random.default_rng(1)
    net = cnn.fresh(rng)
    for n in (1, 4, 255, 256, 259, 260, 5000, cnn.HALF * cnn.BLOCK + 3, 20_000):
        data = cnn.padded(rng.integers(0, 256, n).astype(np.uint8))
        whole = cnn.convolve(net, data)
        want = np.stack([whole[s : s + cnn.HALF].max(0) for s in range(0, len(whole), cnn.HALF)])
        assert np.array_equal(cnn.half_maxima(net, data), want)


def test_the_end_of_a_long_text_counts():
    rng = np.random.default_rng(2)
    good = [bytes(rng.integers(97, 123, 300).astype(np.uint8)) for _ in range(60)]
    bad = [t[:290] + b"###$$$%%%&" for t in good]
    net = cnn.train(good + bad, [1] * 60 + [0] * 60, 0.5)
    long = np.frombuffer(b"".join(good), np.uint8)
    spoiled = np.concatenate([long, np.frombuffer(b"###$$$%%%&" * 3, np.uint8)])
    assert cnn.probability(net, spoiled) < cnn.probability(net, long)


def test_awkward_rows(spark):
    docs = awkward(spark)
    net = cnn.fresh(np.random.default_rng(4))
    got = cnn.score(docs, net)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    rows = got.collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if not r["text"]}
    assert len(empty) == 1
    assert cnn.score(none(spark), net).count() == 0


def test_one_label_only():
    net = cnn.train([b"a", b"b"], [1, 1], 0.8)
    assert abs(cnn.probability(net, np.frombuffer(b"anything", np.uint8)) - 0.8) < 1e-6
    assert cnn.probability(cnn.train([], [], 0.0), np.zeros(0, np.uint8)) == 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = op10_byte_cnn(spark, sf).join(labels, "doc_id").where("held_out").toPandas()
    assert got[got.quality == 1].predicted.mean() > 0.97
    assert got[got.quality == 0].predicted.mean() < 0.2
