"""What a worker holds on to, within a task and from one operator to the next."""

import gc
import random
import tracemalloc
import weakref

import public_tokenizers as P
import pyarrow as pa

from tallyspark.llm import bpe, jaccard_join
from tallyspark.llm.common import BATCH_BYTES, WordHash, begin, map_rows, word_hashes


def test_a_vocabulary_goes_when_a_task_of_another_operator_begins():
    path = P.path("byte_bpe_50k.tiktoken")
    first = begin(lambda: bpe.load(path, P.PATTERN))
    assert begin(lambda: bpe.load(path, P.PATTERN)) is first          # the next task of the same operator finds it
    gone = weakref.ref(first)
    del first
    gc.disable()
    try:
        begin(lambda: None)
        assert gone() is None
    finally:
        gc.enable()


def test_remembered_words_are_bounded_and_change_no_hash():
    words, fresh = WordHash(), WordHash()
    texts = [b"w%d" % i for i in range(300_000)]
    hashes = words.array(texts)
    assert len(words) + len(words.old) <= 1 << 17
    assert fresh.array(texts[:10]).tolist() == hashes[:10].tolist() == words.array(texts[:10]).tolist()


def test_words_of_any_kind_and_length_hash_alone_as_in_a_text():
    rng, seen = random.Random(1), {}
    for _ in range(2000):
        text = bytes(rng.choice(b" \t\n\x0b\x0c\r\x1c\x1f\x85\xa0ab\x00\xff") for _ in range(rng.randrange(120)))
        text = text.replace(b"ab", b"ab" * rng.randrange(1, 60))
        words, hashes = text.split(), word_hashes(text).tolist()
        assert len(words) == len(hashes)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes))
    assert len(set(seen.values())) == len(seen) > 5_000
    for word in (b"x" * n for n in (1, 7, 8, 9, 16, 63, 64, 65, 1000)):
        assert word_hashes(word).tolist() == word_hashes(b" " + word + b"\n")[-1:].tolist()
    assert len(word_hashes(b"")) == len(word_hashes(b" \r\n")) == 0


def test_a_shingle_set_makes_no_object_for_a_word_and_remembers_none():
    words = 100_000
    text = " ".join(f"word{i}" for i in range(words))
    jaccard_join.shingle_set(text[:1000])
    tracemalloc.start()
    try:
        assert len(jaccard_join.shingle_set(text)) == words - 4
        left, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert left < words and most < 130 * words


def test_batches_sent_to_python_are_bounded_in_bytes(spark):
    def make():
        return lambda batch: [pa.RecordBatch.from_arrays([pa.array([batch.column(0).buffers()[-1].size])], ["n"])]

    texts = spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 2000) AS t")
    sizes = [r.n for r in map_rows(texts, "n bigint", make).collect()]
    assert len(sizes) >= 9000 / 256 and max(sizes) <= 2 * BATCH_BYTES  # a column's buffer may have room to spare
