import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_inputs import documents, edge_texts, prose
from tokenizers import Tokenizer

from microlake.llm import packing, token_planes
from microlake.llm.tokens import PieceEncoder, token_path

FILES = [("word_bpe_49k.json", "lower_words"), ("byte_bpe_50k.json", "byte_level")]
PARTS = [" ", " ", "\n", "\t", "a", "B", "'s", "'ll", "é", "ß", "İ", "́", "\x1c", "\x85", "\xa0", " ", "1", "23", "!", "...",
         "<|endoftext|>", "the", " dog", "中", "　", "Σ", "ς", "\r\n", "  ", "\x00", "-", "ﬁ", "​"]


def library(file):
    tok = Tokenizer.from_file(token_path(file))
    tok.encode_special_tokens = True
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file,kind", FILES)
def test_pieces_encode_like_whole_texts(file, kind):
    rng, encoder, whole = random.Random(2), PieceEncoder(token_path(file), kind, 50, 50), library(file)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)] + edge_texts()
    for text in texts:
        assert encoder.ids(text) == array("I", whole(text)).tobytes(), repr(text)


def test_the_cache_keeps_two_generations():
    encoder = PieceEncoder(token_path(FILES[0][0]), FILES[0][1], 1000, 3)
    for text in ("one two three four", "five six", "one seven"):
        encoder.ids(text)
        assert len(encoder._known) <= 3 + 4 + 1
    assert "one" in encoder._known and "four" not in encoder._known and "four" in encoder._old_known


@pytest.mark.parametrize("file,kind", FILES)
def test_blocks_of_texts_encode_like_single_ones(file, kind):
    rng, whole = random.Random(4), library(file)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(200)] + edge_texts() + [None, "", "y" * 300]
    encoder, seen = PieceEncoder(token_path(file), kind, 2000, 100), 0
    for first, ids, ends in encoder.blocks(pa.array(texts, pa.string()), 7):
        begin = 0
        for k, end in enumerate(ends.tolist()):
            assert ids[begin:end].tolist() == [*whole(texts[first + k]), 7]
            begin, seen = end, seen + 1
    assert seen == len(texts)


def test_a_worker_builds_its_encoder_once(spark):
    docs = documents(spark, ["some words here"] * 40).repartition(20)
    path, kind = token_path(FILES[0][0]), FILES[0][1]

    def seen(batches):
        import os

        import pyarrow as pa

        from microlake.llm.tokens import worker_encoder
        for _ in batches:
            pass
        yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "encoder": [id(worker_encoder(path, kind))]})

    rows = docs.select("doc_id").mapInArrow(seen, "pid long, encoder long").collect()
    assert len(rows) == 20 and len({(r["pid"], r["encoder"]) for r in rows}) == len({r["pid"] for r in rows}) < 20


def test_rows_of_one_doc_id_span_all_ranges(spark):
    docs = spark.range(0, 6000, 1, 6).selectExpr("CAST(7 AS BIGINT) AS doc_id", "'the same text' AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # these few bytes would share a task
    try:
        segments = token_planes.write_planes(spark, docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = {r["part"]: r["n_docs"] for r in segments.groupBy("part").agg({"n_docs": "sum"}).withColumnRenamed("sum(n_docs)", "n_docs").collect()}
    assert len(sizes) == 4 and max(sizes.values()) <= 3000 and sum(sizes.values()) == 6000
    back = [r["start"] for r in token_planes.read_planes(segments).collect()]
    assert len(set(back)) == 6000


def test_unknown_kind():
    with pytest.raises(ValueError):
        PieceEncoder(token_path(FILES[0][0]), "other")


@pytest.mark.parametrize("planes", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 100, 1000])
def test_planes_round_trip(planes, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    image = token_planes.write_segment(ids, [None, 5], [0, n], planes, chunk_ids=64)
    assert (token_planes.read_ids(image) == ids).all()
    for a, b in ((0, n), (3, 70), (60, 65), (n, n + 5), (64, 128)):
        assert (token_planes.read_ids(image, a, b) == ids[a:b]).all()
    doc_ids, sizes = token_planes.read_docs(image)
    assert doc_ids == [None, 5] and sizes.tolist() == [0, n]


def test_broken_segment_is_refused():
    image = token_planes.write_segment(np.arange(9, dtype=np.uint32), [1], [9])
    with pytest.raises(ValueError):
        token_planes.read_ids(image[:-1])


def test_token_planes_read_back(spark):
    texts = edge_texts()
    ids = [7, 3, 5, 5, 11, None, 1, 2, 20, 9, 8, 4]
    docs = documents(spark, texts, ids)
    segments = token_planes.write_planes(spark, docs, planes="bit", chunk_ids=1000, segment_ids=40)
    assert segments.count() > 3
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_planes.read_planes(segments).collect())
    encode, start, want = library("word_bpe_49k.json"), 0, []
    key = lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, (x[1] or "").encode())
    for i, text in sorted(zip(ids, texts), key=key):
        row = array("I", [*encode(text), 2])
        want.append((start, i, len(row), zlib.crc32(row.tobytes())))
        start += len(row)
    assert got == want
    assert token_planes.read_planes(token_planes.write_planes(spark, docs.limit(0))).count() == 0


def test_plan_places_every_piece_once():
    rng = random.Random(1)
    for _ in range(150):
        cap = rng.choice([4, 8, 64, 2048])
        counts = Counter(min(cap, 1 + int(rng.expovariate(5 / cap))) for _ in range(rng.choice([0, 1, 5, 200, 3000])))
        runs, n = packing.packing_plan(dict(counts), cap)
        placed, sequences = Counter(), defaultdict(list)
        ranks = defaultdict(list)
        for length, rank, count, first, offset in runs:
            placed[length] += count
            ranks[length] += range(rank, rank + count)
            for k in range(count):
                sequences[first + k].append((offset, length))
        assert placed == counts and len(sequences) == n
        assert all(sorted(r) == list(range(counts[length])) for length, r in ranks.items())
        for parts in sequences.values():
            end = 0
            for offset, length in sorted(parts):
                assert offset == end
                end += length
            assert end <= cap


def test_complement_sums_fill_gaps():
    # 10 = 7 + 3 = 6 + 2 + 2 = 4 + 3 + 2 + 1: single, pair and triple complements
    _, n = packing.packing_plan({7: 1, 3: 2, 6: 1, 2: 3, 4: 1, 1: 1}, 10)
    assert n == 3
    with pytest.raises(ValueError):
        packing.packing_plan({11: 1}, 10)


def test_pack(spark):
    rng = random.Random(9)
    texts = edge_texts() + [prose(rng, rng.randint(1, 700)) for _ in range(60)] + ["copy of a text"] * 40
    docs = documents(spark, texts, [None if k == 4 else k for k in range(len(texts))]).repartition(5)
    rows = packing.pack(spark, docs, capacity=256).collect()
    encode = library("byte_bpe_50k.json")
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, text in enumerate(texts):
        ids, own = [*encode(text), 0], sorted(pieces[None if i == 4 else i], key=lambda r: r["piece"])
        total += len(ids)
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // 256) and all(r["length"] == 256 for r in own[1:])
        end = 0
        for r in own:
            assert r["start"] == end
            end += r["length"]
            assert r["ids_crc32"] == zlib.crc32(array("I", ids[r["start"]:end]).tobytes())
        assert end == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert len(sequences) <= -(-total // 256) * 1.02 + 1
    assert packing.pack(spark, docs.limit(0)).count() == 0


def test_block_size_of_a_worker_encoder_is_the_callers():
    """op3 encodes larger blocks than op6: one process holds an encoder of each size, with equal ids."""
    from microlake.llm import token_planes
    from microlake.llm.tokens import BLOCK_BYTES, worker_encoder
    path = token_path(token_planes.TOKENIZER)
    small, large = (worker_encoder(path, token_planes.KIND, b) for b in (BLOCK_BYTES, token_planes.BLOCK_BYTES))
    assert (small.block_bytes, large.block_bytes) == (BLOCK_BYTES, 8 << 20) and small.ids("Some words, 12") == large.ids("Some words, 12")
