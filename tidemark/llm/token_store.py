"""Token ids in files whose document boundaries are Elias-Fano coded.

A store is a row of shards, each holding the documents of one range of ids in ascending order. A shard is

    magic | ids (2 or 4 bytes each) | sections | footer (JSON) | footer length | magic

The sections hold two Elias-Fano sequences: where documents end in the id array, and the document
ids themselves. A sequence keeps the low bits of each value packed, the high bits as unary gaps, and
every 256th set bit's place, so ``select`` finds one boundary from a few hundred bits: about
2 + log2(ids per document) bits for each document in place of 64.

Defined results: a null or empty text has only the end id. Null document ids come first; rows with equal ids
stay apart, ordered by the first 64 characters of their texts, then by a hash. An empty table makes no shard. Other columns aren't read.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import bytes_of, open_store, parts_for, shared_uri, write_once

MAGIC = b"TDMKIDS1"
SAMPLED = 256
# Pieces a worker remembers fill about twice that many bytes; an entry takes some besides its letters.
CACHED_BYTES = 24 << 20
ENTRY = 200
ASKED = 4096
RUN_DOCS = 8192
BLOCK_IDS = 1 << 20


def _packed(values: np.ndarray, width: int) -> bytes:
    if not width or not len(values):
        return b""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(bits[:, 64 - width :]).tobytes()


def _unpacked(data: bytes, width: int, first: int, count: int) -> np.ndarray:
    if not width or not count:
        return np.zeros(count, dtype=np.uint64)
    start, stop = first * width // 8, -(-(first + count) * width // 8)
    bits = np.unpackbits(np.frombuffer(data, np.uint8, stop - start, start))
    own = bits[first * width - 8 * start :][: count * width].reshape(count, width)
    full = np.zeros((count, 64), dtype=np.uint8)
    full[:, 64 - width :] = own
    return np.packbits(full, axis=1).view(">u8").ravel().astype(np.uint64)


class EliasFano:
    """A non-descending sequence of unsigned numbers."""

    def __init__(self, count: int, width: int, low: bytes, high: bytes, places: np.ndarray):
        self.count, self.width, self.low, self.high, self.places = count, width, low, high, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        count = len(values)
        top = int(values[-1]) if count else 0
        width = max(0, (top // count).bit_length() - 1) if count else 0
        bits = np.zeros((top >> width) + count + 1, dtype=np.uint8)
        ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(count)
        bits[ones] = 1
        return cls(count, width, _packed(values, width), np.packbits(bits).tobytes(), ones[::SAMPLED].astype("<u4"))

    def select(self, i: int) -> int:
        """The i-th value, from its low bits and a short scan of the high ones."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        at = int(self.places[i // SAMPLED])
        left, byte = i % SAMPLED, at // 8
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte))
        bits[: at % 8] = 0
        while (here := int(bits.sum())) <= left:
            left -= here
            byte += 1
            bits = np.unpackbits(np.frombuffer(self.high, np.uint8, 1, byte))
        place = 8 * byte + int(np.flatnonzero(bits)[left])
        return ((place - i) << self.width) | int(_unpacked(self.low, self.width, i, 1)[0])

    def select_run(self, first: int, count: int) -> np.ndarray:
        """The values from the first-th on, by one select and a scan of the high bits up to the last wanted."""
        count = max(0, min(count, self.count - first))
        if not count:
            return np.zeros(0, dtype=np.uint64)
        at = int(self.places[first // SAMPLED])
        left, byte = first % SAMPLED + count, at // 8
        stop = -(-(int(self.places[(first + count - 1) // SAMPLED]) + 1) // 8)
        found: list[np.ndarray] = []
        while left > 0:
            bits = np.unpackbits(np.frombuffer(self.high, np.uint8, stop - byte, byte))
            if not found:
                bits[: at % 8] = 0
            ones = np.flatnonzero(bits)[:left] + 8 * byte
            found.append(ones)
            left -= len(ones)
            byte, stop = stop, min(len(self.high), stop + SAMPLED)
        ones = np.concatenate(found)[first % SAMPLED :]
        high = (ones - np.arange(first, first + count)).astype(np.uint64) << np.uint64(self.width)
        return high | _unpacked(self.low, self.width, first, count)

    def values(self) -> np.ndarray:
        return self.select_run(0, self.count)

    def sections(self) -> list[bytes]:
        return [self.low, self.high, self.places.tobytes()]

    def about(self) -> dict:
        return {"count": self.count, "width": self.width, "bytes": [len(s) for s in self.sections()]}

    @classmethod
    def read(cls, about: dict, read) -> EliasFano:
        low, high, places = (read(n) for n in about["bytes"])
        return cls(about["count"], about["width"], low, high, np.frombuffer(places, "<u4"))


def _classes() -> np.ndarray:
    """Space, letter, digit, sign, or other for every byte; what is other leaves its word whole."""
    table = np.full(256, OTHER, dtype=np.uint8)
    for code in range(33, 127):
        mark = chr(code)
        table[code] = LETTER if mark.isalpha() else DIGIT if mark.isdigit() else SIGN
    table[[9, 10, 13, 32]] = SPACE
    table[ord("'")] = OTHER  # begins short forms
    return table


SPACE, LETTER, DIGIT, SIGN, OTHER = range(5)
CLASS = _classes()
FOLD = np.frombuffer(bytes(range(256)).lower(), np.uint8)
LATIN = 0xC3  # first byte of U+00C0 to U+00FF
# What ``pieces`` makes of words that it takes apart. A comma stands between them when the library is asked.
PLAIN = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]{1,64}|[0-9]|(?!.*<\|)[!-&(-/:-@\[-`{-~]{1,64}")


def pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """What a tokenizer takes apart: gaps, runs of letters in lower case, digits, runs of signs; words with other bytes stay whole.

    Also, how many pieces begin in each text or before it. A gap may reach into the next text.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    kind, low = CLASS[data], FOLD[data]
    # letters of Latin-1 take two bytes; times and division are no letters, and upper case is 32 before lower case
    lead = np.flatnonzero((data[:-1] == LATIN) & (data[1:] != 0x97) & (data[1:] != 0xB7))
    kind[lead] = kind[lead + 1] = LETTER
    low[lead + 1] |= 32 * (data[lead + 1] < 0x9F).astype(np.uint8)
    edge = np.zeros(len(data) + 2, dtype=bool)
    edge[1:-1] = kind != SPACE
    edges = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = edges[::2], edges[1::2]
    odd = kind == OTHER
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))  # special tokens begin so
    before = np.concatenate([[0], np.cumsum(odd)])
    whole = before[ends] > before[starts]
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[starts[whole]] = 1
    step[ends[whole]] = -1
    inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    begins = np.ones(len(data), dtype=bool)
    begins[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & ~(inside[1:] & inside[:-1])
    places = np.flatnonzero(begins)
    folded = np.where(inside, data, low)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(places), [None, pa.py_buffer(np.append(places, len(data))), pa.py_buffer(folded)]
    )
    return found, np.searchsorted(places, np.cumsum([len(t) + 1 for t in texts]))


# How a tokenizer file describes the steps that ``pieces`` relies on.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}


class WordEncoder:
    """Ids of texts by the library, which is asked for each distinct piece that a worker doesn't remember.

    The tokenizer must drop white space, fold case, and keep runs of letters, single digits and runs of other signs apart, as
    its own steps before the merges say. Then the ids of a text are those of its pieces. Words with anything but ASCII and letters of
    Latin-1, an apostrophe or what may be a special token are left whole.
    """

    def __init__(self, path: str, id_bytes: int):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as described:
            steps = json.load(described)
        if (steps["normalizer"], steps["pre_tokenizer"]) != (NORMALIZER, PRE_TOKENIZER):
            raise ValueError(f"{path} takes texts apart in another way")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = f"<u{id_bytes}"
        self.known: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}
        self.held = 0
        self.comma = self.tokenizer.encode(",", add_special_tokens=False).ids[0]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[bytes, np.ndarray]:
        """Ids of all texts with the end id behind each, and how many each has.

        Arrow numbers the distinct pieces; only those are looked up, and numpy puts their ids in place.
        """
        if not len(texts):
            return b"", np.zeros(0, dtype=np.int64)
        found, last = pieces(bytes_of(texts))
        coded = found.dictionary_encode()
        known = self._ids_of(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(known), dtype=self.kind)
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // np.dtype(self.kind).itemsize
        numbers = coded.indices.to_numpy(zero_copy_only=False)
        own = sizes[numbers]
        upto = np.concatenate([[0], np.cumsum(own)])
        counts = np.diff(np.concatenate([[0], upto[last]])) + 1
        out = np.full(int(counts.sum()), end_id, dtype=self.kind)
        # places of the ids in the table and in the result, where one is left for the end behind each text
        step = np.arange(int(upto[-1])) - np.repeat(upto[:-1], own)
        origin = (np.cumsum(sizes) - sizes)[numbers]
        ends = np.repeat(np.arange(len(last)), np.diff(np.concatenate([[0], last])))
        out[step + np.repeat(upto[:-1] + ends, own)] = ids[step + np.repeat(origin, own)]
        return out.tobytes(), counts

    def _ids_of(self, wanted: list[bytes]) -> list[bytes]:
        """Two generations are remembered: what isn't met again while one fills up is forgotten."""
        if self.held > CACHED_BYTES:
            self.earlier, self.known, self.held = self.known, {}, 0
        known, earlier = self.known, self.earlier
        new = [w for w in wanted if w not in known]
        missing = []
        for word in new:
            ids = earlier.get(word)
            if ids is None:
                missing.append(word)
            else:
                known[word] = ids
        for first in range(0, len(missing), ASKED):
            self._ask(missing[first : first + ASKED])
        self.held += sum(map(len, new)) + ENTRY * len(new)
        return [known[w] for w in wanted]

    def _ask(self, words: list[bytes]) -> None:
        """Encode new pieces: plain ones in one call with commas between, others one by one."""
        texts = [w.decode() for w in words]
        plain = [PLAIN.fullmatch(t) is not None and "," not in t for t in texts]
        joined = " , ".join(["", *(t for t, p in zip(texts, plain, strict=True) if p), ""])
        rest = [t for t, p in zip(texts, plain, strict=True) if not p]
        done = self.tokenizer.encode_batch_fast([joined, *rest], add_special_tokens=False)
        ids = np.array(done[0].ids, dtype=self.kind)
        commas = np.flatnonzero(ids == self.comma)
        size, data = ids.itemsize, ids.tobytes()
        bounds = zip((size * (commas[:-1] + 1)).tolist(), (size * commas[1:]).tolist(), strict=True)
        others = iter(done[1:])
        for word, own in zip(words, plain, strict=True):
            if own:
                first, last = next(bounds)
                self.known[word] = data[first:last]
            else:
                self.known[word] = np.array(next(others).ids, dtype=self.kind).tobytes()


@lru_cache(maxsize=2)
def load(path: str, id_bytes: int) -> WordEncoder:
    return WordEncoder(path, id_bytes)


def write_store(
    docs: DataFrame, tokenizer: str, folder: str | None = None, key: str = "doc_id", text: str = "text",
    end_id: int = 2, id_bytes: int = 2, shards: int | None = None,
) -> DataFrame:
    """Write the shards and return the manifest, one row per shard, kept beside them.

    Ranges of ids are dealt to tasks, which sort, encode and write them as a stream. ``id_bytes`` is
    2 for vocabularies of up to 65,536 ids, else 4. Shards stay as long as the folder does.
    """
    spark = docs.sparkSession
    folder = folder or shared_uri(spark, "token-store")
    shards = shards or parts_for(docs)

    def write(batches):
        out = uri = None
        keys, sizes = [], []
        encoder = load(tokenizer, id_bytes)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out, uri = write_once(folder, "shard")
                out.write(MAGIC)
            keys += batch.column("key").to_pylist()
            ids, counts = encoder.encode(batch.column("text"), end_id)
            out.write(ids)
            sizes += counts.tolist()
        if out is None:
            return
        known = [k for k in keys if k is not None]
        least = known[0] if known else 0
        numbers = np.array(known, dtype=np.int64).astype(np.uint64) - np.uint64(least % 2**64)
        ends, names = EliasFano.of(np.cumsum(sizes)), EliasFano.of(numbers)
        for section in ends.sections() + names.sections():
            out.write(section)
        n_ids = int(sum(sizes))
        footer = json.dumps({
            "id_bytes": id_bytes, "n_ids": n_ids, "n_null_keys": len(keys) - len(known), "least_key": least,
            "ends": ends.about(), "keys": names.about(),
        }).encode()
        out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        out.close()
        yield pa.RecordBatch.from_pydict({
            "uri": [uri], "first_key": [keys[0]], "last_key": [keys[-1]], "part": [_task()],
            "n_docs": [len(keys)], "n_ids": [n_ids],
        }, schema=pa.schema([
            ("uri", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("part", pa.int64()),
            ("n_docs", pa.int64()), ("n_ids", pa.int64()),
        ]))

    ordered = docs.select(F.col(key).cast(LongType()).alias("key"), F.col(text).alias("text"))
    # ranges cut through rows of one key too; samples of these columns go to the driver, so none is a whole text
    order = ["key", F.substring("text", 1, 64), F.xxhash64("text"), F.col("row")]
    ordered = ordered.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(shards, *order)
    ordered = ordered.sortWithinPartitions(*order).drop("row")
    ordered.mapInArrow(
        write, "uri string, first_key long, last_key long, part long, n_docs long, n_ids long"
    ).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _task() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


class Shard:
    """One file of a store, opened for reading."""

    def __init__(self, uri: str):
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        length = struct.unpack("<I", tail[:4])[0]
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token store shard")
        about = json.loads(self.file.read_at(length, size - 12 - length))
        self.n_ids, self.kind = about["n_ids"], f"<u{about['id_bytes']}"
        self.width = about["id_bytes"]
        self.file.seek(len(MAGIC) + self.n_ids * self.width)
        self.ends = EliasFano.read(about["ends"], self.file.read)
        self.names = EliasFano.read(about["keys"], self.file.read)
        self.n_null_keys, self.least_key = about["n_null_keys"], about["least_key"]

    def ids(self, start: int, stop: int) -> np.ndarray:
        data = self.file.read_at((stop - start) * self.width, len(MAGIC) + start * self.width)
        return np.frombuffer(data, dtype=self.kind)

    def document(self, i: int) -> np.ndarray:
        """Ids of one document, by two selects and one read."""
        return self.ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def keys(self, first: int, count: int) -> pa.Array:
        """Keys of a run of documents; those without one come first."""
        blank = max(0, min(self.n_null_keys - first, count))
        numbers = self.names.select_run(max(0, first - self.n_null_keys), count - blank) + np.uint64(self.least_key % 2**64)
        return pa.concat_arrays([pa.nulls(blank, pa.int64()), pa.array(numbers.view(np.int64))])


def read_store(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document; ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it. The sums behind it run over the
    manifest alone, a row per shard.
    """
    placed = manifest.selectExpr("uri", "sum(n_ids) over (order by part) - n_ids as before")
    placed = placed.repartition(max(1, manifest.count()), "uri")

    def read(batches):
        for batch in batches:
            for uri, before in zip(batch.column("uri").to_pylist(), batch.column("before").to_pylist(), strict=True):
                shard = Shard(uri)
                first, begin = 0, 0
                while first < shard.ends.count:
                    ends = shard.ends.select_run(first, RUN_DOCS).astype(np.int64)
                    ends = ends[: max(1, int(np.searchsorted(ends, begin + BLOCK_IDS, "right")))]
                    bounds = np.concatenate([[begin], ends])
                    ids = shard.ids(begin, int(ends[-1])).astype("<u4")
                    yield pa.RecordBatch.from_arrays([
                        shard.keys(first, len(ends)), pa.array(before + bounds[:-1]),
                        pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(4 * (bounds - begin)), pa.py_buffer(ids)]).cast(pa.binary()),
                    ], names=["doc_id", "start", "ids"])
                    first, begin = first + len(ends), int(ends[-1])

    return placed.mapInArrow(read, "doc_id long, start long, ids binary")
