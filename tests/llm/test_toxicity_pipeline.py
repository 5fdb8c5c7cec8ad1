import random

import zlib

import numpy as np
from llm_inputs import documents, edge_texts, prose

from microlake.llm import toxicity as tox

VILE = ["wretchface", "scumbrain", "vilelout", "wretchface", "wretchling", "wretchery"]


def sample(rng, n):
    """Long and short texts; a third hold two or three vile words somewhere."""
    rows = []
    for k in range(n):
        words = prose(rng, rng.choice([15, 60, 200])).split()
        if k % 3 == 0:
            for _ in range(rng.randint(2, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(VILE) + rng.choice(["", ",", "!"]))
        rows.append((" ".join(words), int(k % 3 == 0)))
    return rows


def test_windows_cover_every_word():
    for n in [*range(1, 80), 1000, 1001]:
        starts = tox.window_starts(n)
        seen = {k for s in starts for k in range(s, min(n, s + tox.WINDOW))}
        assert seen == set(range(n)) and (np.diff(starts) <= tox.STRIDE).all()


def test_gradients_equal_differences():
    net = {k: v.astype(np.float64) for k, v in tox.new_network(3).items()}
    rng = np.random.default_rng(1)
    table = rng.standard_normal((9, 2, 3 * tox.HIDDEN))
    rows = rng.integers(0, 9, (4, 6))
    rows[1, 3:] = -1
    pull = rng.standard_normal(4)

    def loss():
        return float(forward64(net, rows, table) @ pull)

    def forward64(net, rows, table, keep=None):
        zeros, empty = np.zeros, np.empty
        try:        # the network runs in single precision; differences need double
            tox.np.zeros = lambda s, t=None: zeros(s)
            tox.np.empty = lambda s, t=None: empty(s)
            return tox.forward(net, rows, table, keep)
        finally:
            tox.np.zeros, tox.np.empty = zeros, empty

    kept: dict = {}
    forward64(net, rows, table, kept)
    grads, d_table = tox.backward(net, kept, pull, 9)
    for name, array, grad in [*((k, net[k], g) for k, g in grads.items()), ("table", table, d_table)]:
        flat = array.reshape(-1)
        for at in rng.integers(0, flat.size, 8):
            old = flat[at]
            flat[at] = old + 1e-5
            up = loss()
            flat[at] = old - 1e-5
            down = loss()
            flat[at] = old
            assert abs((up - down) / 2e-5 - np.asarray(grad).reshape(-1)[at]) < 1e-4 * (1 + abs(up - down) / 2e-5), name


def test_held_out_accuracy_and_whole_texts():
    rng = random.Random(4)
    net = tox.train(sample(rng, 450))
    scorer = tox.Scorer(net)
    fresh = sample(rng, 200)
    scores = scorer.scores([t for t, _ in fresh])
    labels = np.array([y for _, y in fresh])
    assert ((scores >= 0.5) == labels).mean() >= 0.95
    long = prose(rng, 9000)
    for at in (0, 4000, 6140, 8999):           # one vile passage at any place of a very long text counts
        words = long.split()
        words[at:at + 2] = ["wretchface", "scumbrain", "wretchling"]
        assert scorer.scores([" ".join(words), long])[0] > max(0.5, scorer.scores([long])[0])
    assert scorer.scores([]).shape == (0,)
    empty = scorer.scores([None, "", " \n"])
    assert (empty == 0).all()
    first = scorer.scores(["wretchface, scumbrain! " + prose(rng, 30)])
    before, tox.MAX_WORDS = tox.MAX_WORDS, 10
    try:                                        # a full table starts afresh and changes no score
        again = tox.Scorer(net)
        again.scores([t for t, _ in fresh])
        assert np.allclose(again.scores([t for t, _ in fresh]), scores, atol=1e-5)
    finally:
        tox.MAX_WORDS = before
    assert first.shape == (1,)


def test_train_needs_both_labels():
    assert tox.train([]) is None and tox.train([("a b", 1)]) is None and tox.train([(None, 0), ("", 1)]) is None


def labelled(spark, rng):
    rows = sample(rng, 240)
    texts = [t for t, _ in rows] + edge_texts()
    ids = list(range(240)) + [None, 240, 241, 242, 243, 244, 245, 246, 247, 248, 249, 250]
    labels = spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)] + [(None, 1, 1), (3, 0, None), (5, 1, 7)],
                                   "doc_id long, quality int, toxic int")
    return documents(spark, texts, ids), labels, dict(enumerate(y for _, y in rows))


def test_judge_and_drop(spark):
    docs, labels, truth = labelled(spark, random.Random(9))
    rows = tox.judge(spark, docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    right = [r["predicted"] == truth[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(right) >= 0.9 * len(right)
    kept = tox.drop_toxic(spark, docs, labels)
    assert kept.columns == docs.columns
    low = sorted(str(r["doc_id"]) for r in rows if not r["predicted"])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == low
    assert tox.judge(spark, docs, labels.limit(0)).where("score <> 0").count() == 0
    assert tox.judge(spark, docs.limit(0), labels).count() == 0


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = labelled(spark, random.Random(9))
    flipped = labels.withColumn("toxic", tox.F.when(tox.held_out(), 1 - tox.F.col("toxic")).otherwise(tox.F.col("toxic")))
    one, two = (tox.fit(spark, docs, x) for x in (labels, flipped))
    assert all((one[k] == two[k]).all() for k in one)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(12)
    rows = sample(rng, 200)
    item = prose(rng, 30)
    texts = [t for t, _ in rows] + [prose(rng, 80) + " " + item, "token=abcdef123 " + prose(rng, 70)] + [rows[1][0]] * 30 + edge_texts()
    docs = documents(spark, texts)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, y) for k, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int") \
        .write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in cp.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "packing"]
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for k, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, at, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        seen.append(at.select("doc_id", *(["text"] if k < 4 else [])).distinct().collect())
    ids = [{r["doc_id"] for r in x} for x in seen]
    toxic = {k for k, (_, y) in enumerate(rows) if y}
    assert len(toxic & ids[0]) <= 0.1 * len(toxic) and len({k for k, (_, y) in enumerate(rows) if not y} - ids[0]) <= 5
    assert 1 in ids[1] and not ids[1] & set(range(202, 232))            # copies of 1 go, 1 stays
    assert 200 in ids[1] and 200 not in ids[2] and 201 in ids[2]
    assert next(r["text"] for r in seen[3] if r["doc_id"] == 201).startswith("[assign]")
    assert ids[4] == ids[3] == ids[2]
    whole = cp.run(spark, str(tmp_path))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, whole.select(*key).collect())) == sorted(map(str, at.select(*key).collect()))


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_entry_without_the_package(monkeypatch):
    import __spark_entry__ as entry

    found = entry.importlib.util.find_spec
    monkeypatch.setattr(entry.importlib.util, "find_spec", lambda name: None if "llm" in name or name == "corpus_pipeline" else found(name))
    assert not any(k.startswith("op1_") or k == "pipeline" for k in entry.queries())


def test_grams_of_a_word_are_its_own():
    words = ["idiot", "", "réeuxaux", "a", "«Achlichte!»", "achlichte"]
    slots, grams, firsts = tox.inputs_of(words)
    ends = np.append(firsts[1:], len(grams))
    for k, word in enumerate(words):
        alone = tox.inputs_of([word])
        assert alone[0][0] == slots[k] and alone[1].tolist() == grams[firsts[k]:ends[k]].tolist()
        size = len(word.strip(tox._SIGNS).encode())
        # the word with a start mark: grams of 4 octets reach over three end marks, longer ones over one at most
        assert ends[k] - firsts[k] == size + 1 + sum(max(0, size + 4 - need + 1) for need in (8, 10, 12))
    assert grams.min() >= 0 and grams.max() < tox.GRAM_SLOTS


def test_only_shared_words_are_learnt():
    texts = ["good day to all", "good night to all", "bad stray to all"]
    vocab = tox._Vocabulary(texts, 2)
    known = {w for w in vocab.place if vocab.shared_words[tox.inputs_of([w])[0][0]]}
    assert known == {"good", "to", "all"}
