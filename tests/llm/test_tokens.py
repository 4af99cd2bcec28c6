import base64
import random

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import bpe_tree, token_count, token_store

RANKS, BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def hard_texts():
    rng = random.Random(9)
    letters = "ab aeiou \n\t\x1c\x1f\x85 ᠎ 　'sdtmé漢ßΣςİ1²٣🙂‍.,#_-\x00 ́ſ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(1500)]
    texts += ["a" * 4000, "ab" * 1500, "=" * 999, " " * 999 + "x", "".join(rng.choice("etaoin") for _ in range(3000))]
    return texts


def test_tree_encodes_as_the_library(reference):
    codec = bpe_tree.load(RANKS, public_tokenizers.PATTERN)
    for text in hard_texts():
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_join_is_associative():
    codec = bpe_tree.load(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(200):
        data = bytes(rng.choice(b"etaoinshrd") for _ in range(90))
        a, b = sorted((rng.randrange(91), rng.randrange(91)))
        x, y, z = (bpe_tree.direct(p, codec.ranks) for p in (data[:a], data[a:b], data[b:]))
        whole = bpe_tree.direct(data, codec.ranks)
        assert codec.join(codec.join(x, y), z) == codec.join(x, codec.join(y, z)) == whole


def test_encode_and_decode_columns(odd, odd_rows, empty, reference, same_rows):
    done = odd.select("doc_id", bpe_tree.encode(F.col("text"), RANKS, public_tokenizers.PATTERN).alias("ids")).select(
        "doc_id", F.sha2("ids", 256), bpe_tree.decode(F.col("ids"), RANKS, public_tokenizers.PATTERN).cast("string")
    )
    expected = [(i, brute.digest_ids(reference.encode_ordinary(t or "")), t or "") for i, t, *_ in odd_rows]
    same_rows(done, expected, *done.columns)
    assert empty.select(bpe_tree.encode(F.col("text"), RANKS, public_tokenizers.PATTERN)).count() == 0


def test_counts_as_the_library(odd, odd_rows, same_rows):
    library, counter = Tokenizer.from_file(BYTES), token_count.load(BYTES)
    for text in [*hard_texts(), "<|endoftext|>", "x<|endoftext|><|endoftext|> <|endoftext"]:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    counted = odd.select("doc_id", token_count.count_tokens(F.col("text"), BYTES).alias("t"))
    same_rows(counted, [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in odd_rows], "doc_id", "t")


def test_words_encode_as_texts():
    """The ids of a text are those of its words, for every kind of white space and mark."""
    library, encoder = Tokenizer.from_file(WORDS), token_store.WordEncoder(WORDS, 2)
    texts = [*hard_texts(), "<|endoftext|> ΑΣ ΑΣ. x<|startoftext|>y", "é e ́"]
    for batch in (texts, [None, "", " ", *texts[:300]], texts[1400:]):  # known words, and a slice of an array
        ids, counts = encoder.encode(pa.array(["cut off", *batch])[1:], 2)
        parts = np.split(np.frombuffer(ids, "<u2"), np.cumsum(counts)[:-1])
        for text, part in zip(batch, parts, strict=True):
            assert part.tolist() == [*library.encode(text or "", add_special_tokens=False).ids, 2]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_store.WordEncoder(BYTES, 4)


def test_store_round_trip(odd, odd_rows, empty, same_rows):
    library = Tokenizer.from_file(WORDS)
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for i, text, *_ in ordered:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((i, start, len(ids), brute.crc_ids(ids)))
        start += len(ids)
    manifest = token_store.write_store(odd, WORDS, shards=3)
    stored = token_store.read_store(manifest).selectExpr("doc_id", "start", "octet_length(ids) div 4 as n", "crc32(ids) as c")
    same_rows(stored, expected, "doc_id", "start", "n", "c")
    shard = token_store.Shard(manifest.orderBy("part").first()["uri"])
    ends = shard.ends.values().tolist()
    assert shard.keys(0, 10**6).to_pylist() == [k for i in range(0, len(ends), 3) for k in shard.keys(i, 3).to_pylist()]
    for i in range(len(ends)):  # single documents by select
        assert len(shard.document(i)) == ends[i] - (ends[i - 1] if i else 0)
    assert token_store.read_store(token_store.write_store(empty, WORDS)).count() == 0


@pytest.mark.parametrize("values", [[0], [5], [0, 0, 0], [3, 3, 9, 10**6], [*range(700), *range(10**7, 10**7 + 700)], list(range(2000)), [2**63 - 1, 2**64 - 1], []])
def test_elias_fano(values):
    coded = token_store.EliasFano.of(np.array(values, dtype=np.uint64))
    assert coded.values().tolist() == values and [coded.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        coded.select(len(values))
    for first in {0, 1, 255, 256, 257, len(values) - 1}:
        for count in (0, 1, 300, 5000):
            assert coded.select_run(max(0, first), count).tolist() == values[max(0, first) : max(0, first) + count]


def test_elias_fano_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20000))
    assert 8 * sum(map(len, token_store.EliasFano.of(values).sections())) / 20000 < 2 + 10 + 1
