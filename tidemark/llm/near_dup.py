"""Near-duplicate documents by a join of MinHash signatures on their coordinates.

A document is its set of 5-word shingles; texts with equal sets are one class, and only classes are compared.
Each class has a signature of ``COORDINATES`` minima and is posted under its coordinate-value pairs. Two
sets that are similar enough agree in ``MATCHES`` coordinates or more (a pair at 0.75 misses that with
a chance of 3e-6), so they share a pair among any COORDINATES - MATCHES + 1 of
each. The rarest pairs of a class are taken for this prefix; values that nobody shares count first and
need no posting, which skips all but the copies and keeps common passages out of the join.

Links are found without pairing everybody in a posting list. First each class is compared with one head of
its lists, classes whose values most others share. Links are confirmed on the full sets, then connected. Classes
that lists hold together form families; those that are one component by then are done. In the others, members are
compared across components, two blocks of a family at a time inside a task: collisions are counted over the posting lists of
the two, short ones joined and long ones looked up, pairs with
enough are confirmed on the full sets, and only links that join components leave the task. Blocks are bounded in rows and bytes. Pairs within a
component can't change the result.

Defined results: a null or empty text, or one of gaps only, has an empty set and is linked with nothing. A text below five words
is one shingle. The component of a row is the smallest id reachable; null ids count only among themselves, and such
rows are kept if nothing with an id is linked to them. Repeated rows are one class. Other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import GAP_BYTES, Scratch, bytes_of, mix

SHINGLE = 5
COORDINATES = 64
MATCHES = 32
PREFIX = COORDINATES - MATCHES + 1
# A block of a family holds about that many rows and bytes of text at most.
BLOCK = 1024
BLOCK_BYTES = 2 << 20
COLUMNS = 4096
BASE = 0x9E3779B97F4A7C15

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[list(GAP_BYTES)] = True
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_SALTS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(BASE))


def _steps(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            run = np.full(max(n, 2 * len(_powers[k])), base, dtype=np.uint64)
            run[0] = 1
            _powers[k] = np.cumprod(run, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def shingle_codes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit codes of the word shingles, ascending."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    word = np.zeros(len(data) + 2, dtype=bool)
    word[1:-1] = ~_GAP[data]
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    up, down = _steps(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    codes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    n = max(1, len(codes) - size + 1)
    whole = np.zeros(n, dtype=np.uint64)
    for i in range(min(size, len(codes))):
        whole = mix(whole * np.uint64(3) + codes[i : i + n])
    return np.unique(whole)


def signature(codes: np.ndarray) -> np.ndarray:
    """Minimum of each coordinate's hash over the set."""
    out = np.full(COORDINATES, ~np.uint64(0))
    for k in range(0, len(codes), 4096):
        part = codes[k : k + 4096]
        for i in range(COORDINATES):
            out[i] = min(out[i], ((part ^ _SALTS[i]) * np.uint64(0xD6E8FEB86659FD93)).min())
    return out


def row_tag(text: Column) -> Column:
    """Tells rows with equal ids apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, tag, n, class, signature) of every row; class is a 128-bit digest of the set, null if empty."""
    import hashlib

    def run(batches):
        for batch in batches:
            counts, names, signatures = [], [], []
            for data in bytes_of(batch.column("text")):
                codes = shingle_codes(data)
                counts.append(len(codes))
                names.append(hashlib.blake2b(codes.tobytes(), digest_size=16).digest() if len(codes) else None)
                signatures.append(signature(codes).view(np.int64) if len(codes) else None)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "tag": batch.column("tag"), "n": pa.array(counts, pa.int64()), "class": pa.array(names, pa.binary()),
                "signature": pa.array(signatures, pa.list_(pa.int64())),
            })

    rows = docs.select(F.col(key).cast("long").alias("id"), row_tag(F.col(text)).alias("tag"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, tag long, n long, class binary, signature array<long>")


def _postings(classes: DataFrame) -> DataFrame:
    """(posting, node, shared): the rarest coordinate-value pairs of each class that others share."""
    pairs = classes.select("node", F.posexplode("signature").alias("k", "v")).select(
        "node", F.xxhash64("k", "v").alias("posting")
    )
    shared = pairs.groupBy("posting").agg(F.count("*").alias("n")).where("n > 1")
    per_class = pairs.join(shared, "posting").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("n", "posting"))).alias("found")  # COORDINATES at most
    )
    # unshared values come first in the order of rareness and use up the prefix
    room = F.lit(PREFIX - COORDINATES) + F.size("found")
    return per_class.where(room > 0).select(
        "node", F.aggregate("found", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("shared"),
        F.explode(F.slice("found", F.lit(1), room)["posting"]).alias("posting"),
    )


def _matches(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def _could_link(n_a: str, n_b: str) -> Column:
    """Sets of these sizes can have a similarity of 0.75."""
    return 100 * F.least(n_a, n_b) >= 75 * F.greatest(n_a, n_b)


def _with_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of (a, b): those with enough equal coordinates and sizes near enough, with their ``matches``."""
    side = classes.select("node", "n", "signature")
    for name in ("a", "b"):
        pairs = pairs.join(
            side.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}")),
            name,
        )
    return pairs.where(_could_link("n_a", "n_b")).select(
        "a", "b", _matches(F.col("s_a"), F.col("s_b")).alias("matches")
    ).where(F.col("matches") >= MATCHES)


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. ``texts`` has one text per node."""
    for name in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("node").alias(name), F.col("text").alias(f"t_{name}")), name)

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        known: dict[bytes, np.ndarray] = {}

        def codes(data: bytes) -> np.ndarray:
            if data not in known:
                if len(known) > 64:
                    known.clear()
                known[data] = shingle_codes(data)
            return known[data]

        out = []
        for a, b in zip(bytes_of(left), bytes_of(right), strict=True):
            x, y = codes(a), codes(b)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= 75 * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return pairs.where(similar("t_a", "t_b")).select("a", "b")


def connect(links: DataFrame, stage) -> DataFrame:
    """(node, component) of every node with a link; the component is its smallest node.

    Alternates two steps until nothing changes: all larger neighbours of a node, then all smaller ones, move
    to its smallest neighbour. The number of rounds is about the logarithm of the longest path. ``stage`` writes each
    round as a table and reads it again.
    """
    def mark(table: DataFrame):
        return table.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before, now = None, mark(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, now = now, mark(edges)
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select("component", "component").distinct().toDF("node", "component"))


def _across(stars: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, stage) -> DataFrame:
    """Links between components of a family, enough to connect what belongs together."""
    told = connect(stars, stage).withColumnRenamed("component", "family").join(labels, "node", "left")
    told = stage(told.withColumn("component", F.coalesce("component", "node")), "families")
    sized = told.join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
    blocks = F.greatest(F.col("size") / BLOCK, F.col("bytes") / BLOCK_BYTES)
    mixed = sized.groupBy("family").agg(
        F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("size"), F.sum("bytes").alias("bytes")
    ).where("c1 < c2").select("family", F.ceil(blocks).cast("int").alias("blocks"))
    members = told.join(mixed, "family").join(classes.select("node", "signature"), "node").join(texts, "node")
    blocks = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).groupBy(
        "family", "blocks", "block"
    ).agg(F.collect_list(F.struct("node", "component", "signature", "text")).alias("rows"))
    # a family in one block meets itself; longer ones meet block by block
    left = blocks.withColumn("other", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = blocks.select("family", F.col("block").alias("other"), F.col("rows").alias("other_rows"))
    met = left.join(right, ["family", "other"]).select("rows", "other_rows")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                found = _links_across(*(_block(batch.column(c)[i]) for c in ("rows", "other_rows")))
                if found:
                    a, b = zip(*found, strict=True)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return met.mapInArrow(run, "a long, b long")


def _block(rows) -> tuple[list, list, np.ndarray, list]:
    values = rows.values
    signatures = values.field("signature").flatten().to_numpy(zero_copy_only=False)
    return (
        values.field("node").to_pylist(), values.field("component").to_pylist(),
        signatures.reshape(-1, COORDINATES), bytes_of(values.field("text")),
    )


def intersections(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices of a few columns each."""
    codes = np.concatenate([*xs, *ys])
    known, place, times = np.unique(codes, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(xs) + len(ys)), [len(s) for s in (*xs, *ys)])
    shared = times[place] > 1
    column = (np.cumsum(times > 1) - 1)[place[shared]]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[shared][order]
    total = np.zeros((len(xs), len(ys)), dtype=np.float32)
    for first in range(0, int(np.count_nonzero(times > 1)), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        cells = np.zeros((len(xs) + len(ys), COLUMNS), dtype=np.float32)
        cells[owner[a:b], column[a:b] - first] = 1
        total += cells[: len(xs)] @ cells[len(xs) :].T
    return total.astype(np.int64)


def collisions(sx: np.ndarray, sy: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which wanted pairs of two blocks agree in MATCHES coordinates or more, counted over posting lists.

    Every coordinate-value pair has a list of rows on both sides. Pairs of rows are found in the lists of the left row's PREFIX
    rarest values only, as MATCHES agreements can't all lie outside. The long lists that are left are skipped: they are never
    joined, but looked into for the pairs found so far, as long as these can still reach the threshold.
    """
    n, m = len(sx), len(sy)
    lists = []
    sizes = np.empty((n, COORDINATES), dtype=np.int64)
    for k in range(COORDINATES):
        order = np.argsort(sy[:, k], kind="stable")
        first, last = (np.searchsorted(sy[order, k], sx[:, k], side) for side in ("left", "right"))
        lists.append((order, first, last))
        sizes[:, k] = last - first
    rarest = np.argsort(sizes, axis=1, kind="stable")
    short = np.zeros((n, COORDINATES), dtype=bool)
    np.put_along_axis(short, rarest[:, :PREFIX], True, axis=1)
    count = np.zeros((n, m), dtype=np.int16)
    for k, (order, first, last) in enumerate(lists):
        rows = np.flatnonzero(short[:, k] & (last > first))
        spans = last[rows] - first[rows]
        at = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans) + np.repeat(first[rows], spans)
        count[np.repeat(rows, spans), order[at]] += 1
    a, b = np.nonzero((count > 0) & wanted)
    found = count[a, b].astype(np.int64)
    for left in range(COORDINATES - PREFIX, 0, -1):  # lists a row has left, rarest first
        able = found + left >= MATCHES
        a, b, found = a[able], b[able], found[able]
        k = rarest[a, COORDINATES - left]
        found += sx[a, k] == sy[b, k]
    out = np.zeros((n, m), dtype=bool)
    enough = found >= MATCHES
    out[a[enough], b[enough]] = True
    return out


def _links_across(left: tuple, right: tuple) -> list[tuple[int, int]]:
    """Links between different components of two blocks; of several that join the same ones, the first."""
    (x, cx, sx, tx), (y, cy, sy, ty) = left, right
    near = collisions(sx, sy, np.array(cx)[:, None] != np.array(cy)[None, :])
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(rows):
        return []
    a, b = [shingle_codes(tx[i]) for i in rows], [shingle_codes(ty[j]) for j in columns]
    both = intersections(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - both
    parent: dict[int, int] = {}

    def top(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    found = []
    for i, j in zip(*np.nonzero(near[np.ix_(rows, columns)] & (100 * both >= 75 * union)), strict=True):
        u, v = top(cx[rows[i]]), top(cy[columns[j]])
        if u != v:
            parent[u] = v
            found.append((x[rows[i]], y[columns[j]]))
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, tag, n_shingles, group (number of its component, null for an empty set), component_id, kept."""
    scratch = Scratch(docs.sparkSession, "components")
    stage = scratch.stage
    rows = stage(features(docs, key, text), "signatures")
    # numbers for the classes; the table is written, so they stay as they are
    classes = stage(
        rows.where("class is not null").groupBy("class").agg(
            F.min(F.struct("id", "tag")).alias("least"), F.min("id").alias("least_id"), F.first("n").alias("n"),
            F.first("signature").alias("signature"),
        ).withColumn("node", F.monotonically_increasing_id()), "classes",
    )
    postings = stage(_postings(classes), "postings")
    heads = postings.groupBy("posting").agg(F.max_by("node", F.struct("shared", -F.col("node"))).alias("b"))
    stars = postings.join(heads, "posting").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    stars = stage(stars, "stars")
    best = _with_signatures(stars, classes).groupBy("a").agg(F.max_by("b", F.struct("matches", -F.col("b"))).alias("b"))

    wanted = postings.select("node").distinct().join(classes.select("node", "class", "least.*"), "node")
    source = docs.select(
        F.col(key).cast("long").alias("id"), row_tag(F.col(text)).alias("tag"), F.col(text).cast("binary").alias("text")
    )
    texts = stage(_texts_of_nodes(source, wanted), "texts")
    scratch.release()

    links = stage(_confirm(best, texts), "links")
    labels = stage(connect(links, stage), "labels")
    more = stage(_across(stars, labels, classes, texts, stage), "links")
    if not more.isEmpty():
        labels = stage(connect(links.unionByName(more), stage), "labels")
    told = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = told.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = told.join(ids, "component").select("class", F.col("component").alias("group"), "component_id")
    # the class of an empty set is null and joins nothing: such a row is its own component
    told = rows.join(told, "class", "left").select(
        "id", "tag", F.col("n").alias("n_shingles"), "group",
        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return scratch.result(told).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _texts_of_nodes(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text per wanted class, taken from the row with its smallest id (null before all), then tag."""
    same = source["id"].eqNullSafe(wanted["id"]) & (source["tag"] == wanted["tag"])
    joined = source.join(wanted, same).select("node", "class", "text")

    @F.arrow_udf("boolean")
    def own(names: pa.Array, texts: pa.Array) -> pa.Array:
        import hashlib

        return pa.array([
            hashlib.blake2b(shingle_codes(t).tobytes(), digest_size=16).digest() == c
            for c, t in zip(names.to_pylist(), bytes_of(texts), strict=True)
        ], pa.bool_())

    # tags are hashes, so a row of another class may have the same; of equal sets any text serves
    return joined.where(own("class", "text")).dropDuplicates(["node"]).select("node", "text")
