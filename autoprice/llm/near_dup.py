"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles, weight = count in the text x IDF, and IDF is
``1 + ln(N / df)``, df being in how many of the N documents the shingle stands. All frequencies are exact:
texts are dealt to blocks; a block sends its distinct shingles with their counts, packed by hash range, to shards; a
shard adds them up and answers each block with those that stand in several documents (the others stand in
one); block and answers meet again, and each text keeps the frequencies of its shingles beside its samples. Neither the
driver nor a single task holds a table of all shingles.

Each document draws SAMPLES improved consistent weighted samples (per shingle and sample: r and c from
Gamma(2, 1), b uniform; t = floor(ln w / r + b); the shingle with the least ln c - r (t - b + 1) and its t
are the sample). Samples are banded; documents that share a band meet in a bucket.

1. Equal texts are one node, named by the smallest id.
2. Each bucket links its members to its smallest id; the links are verified by exact weighted Jaccard
   similarity and joined into components. This is linear in the bucket, however large.
3. Buckets that still hold several components compare the members outside their largest component with
   the members of other components, in blocks of bounded size. What the samples and the weights leave
   open (equal samples estimate the similarity) is verified exactly, and only links that join two
   components are returned. Members of one component are never compared, so a large group of copies costs
   nothing here; a large bucket of texts that are less alike costs comparisons but neither rows nor memory.

Defined cases: null, empty and word-less texts are classes of their own; one to four words form one
shingle; repeated ids with different texts are linked as different texts of one id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from autoprice.llm.common import broadcast_checked, fresh, materialise, releasing, text_batches
from autoprice.llm.components import connected_components
from autoprice.llm.textcore import U, mix, shingles, slices, split_words, utf8

SHINGLE = 5
THRESHOLD = 0.8
#: Frequencies below this share of the documents would count as that share: none do, IDF is never held constant.
IDF_SHARE = 0.0
#: Text of a block at most (a longer text is one of its own), and of a shard about.
BLOCK_BYTES = 4 << 20
SHARD_BYTES = 8 << 20
BANDS, ROWS = 12, 4
SAMPLES = BANDS * ROWS
#: Texts of a side that a task compares at once, across the components of a bucket.
BLOCK = 1024
#: Of 48 samples, pairs at 0.8 agree on 38.4 +- 2.8: fewer than 28 is below by 3.7 deviations.
LEAST_EQUAL = 28


def _gamma_quantiles(n: int) -> np.ndarray:
    """Quantiles of Gamma(2, 1) at (i + 1/2) / n, from its distribution 1 - (1 + x) exp(-x)."""
    x = np.linspace(0, 40, 1 << 21) ** 2 / 40
    return np.interp((np.arange(n) + 0.5) / n, 1 - (1 + x) * np.exp(-x), x)


_R = _gamma_quantiles(1 << 16).astype(np.float32)
_LN_C = np.log(_gamma_quantiles(1 << 16)).astype(np.float32)
_SEEDS = mix(np.arange(1, SAMPLES + 1, dtype=U) * U(0xD1342543DE82EF95))


def bags(data: np.ndarray, off: np.ndarray):
    """Distinct shingles of each row, sorted by row and hash: (hash, count, row bounds)."""
    h, row = shingles(split_words(data, off), SHINGLE)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))), np.searchsorted(row[at], np.arange(len(off)))


def idf(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    return 1 + np.log(n_docs / np.maximum(frequency, IDF_SHARE * n_docs))


def weighted(data: np.ndarray, off: np.ndarray, frequency: np.ndarray, n_docs: int):
    """Distinct shingles of each row, sorted by row and hash: (hash, weight, row bounds). ``frequency``: of each of them, in order."""
    h, tf, first = bags(data, off)
    return h, tf * idf(frequency, n_docs), first


def _frequencies(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers packed in a binary column, and the row bounds."""
    data, off = utf8(arr)
    return data[off[0]:off[-1]].view(np.uint32), (off - off[0]) // 4


def _packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array of the bytes of ``values`` between the cuts."""
    size = values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * size).astype(np.int32).tobytes()),
                                                              pa.py_buffer(np.ascontiguousarray(values).tobytes())])


def _planes(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary array of the values between the cuts, first bytes first: in ascending numbers the upper bytes repeat, and shuffles compress them."""
    return pa.array([values[i:j].view(np.uint8).reshape(j - i, -1).T.tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())


def _from_planes(arr: pa.Array | pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    """The values of each row."""
    size = np.dtype(kind).itemsize
    return [np.frombuffer(x, np.uint8).reshape(size, -1).T.copy().view(kind).ravel() for x in arr.to_pylist()]


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of neighbouring rows that are equal in all columns."""
    n = len(columns[0])
    new = np.zeros(max(n - 1, 0), bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return [(i, j) for i, j in zip(cuts, cuts[1:]) if j > i]


def _add_up(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of ``h``, the distinct values, the sums of ``n`` over each, and how often each occurs."""
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    at = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], at) if len(at) else n[:0]
    return order, h[at], sums, np.diff(np.append(at, len(h)))


def sample(h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sample fingerprints, one row of SAMPLES per row that has shingles."""
    some = np.flatnonzero(np.diff(first) > 0)
    starts, n = first[some], np.diff(first)[some]
    ln_w = np.log(weight).astype(np.float32)
    out = np.zeros((len(some), SAMPLES), U)
    for k in range(SAMPLES):
        z = (h ^ _SEEDS[k]) * U(0xBF58476D1CE4E5B9)
        z ^= z >> U(32)
        z *= U(0x94D049BB133111EB)
        r = _R[z >> U(48)]
        b = ((z >> U(16)) & U(0xFFFF)).astype(np.float32) * np.float32(1 / 65536)
        t = np.floor(ln_w / r + b)
        a = _LN_C[(z >> U(32)) & U(0xFFFF)] - r * (t - b + 1)
        least = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), n))
        pick = least[np.searchsorted(least, starts)]  # ties: the smallest hash
        out[:, k] = mix(h[pick] ^ (t[pick].astype(np.int64).astype(U) * _SEEDS[0]) ^ _SEEDS[k])
    return out


def in_blocks(docs: DataFrame) -> DataFrame:
    """``docs`` (id, key, text) as a written table with a block number, and the text's bytes."""
    kind = docs.schema["id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, off = utf8(batch.column("text"))
            for i, j in slices(off, BLOCK_BYTES):
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("key"), part.column("text"), pa.array(np.full(j - i, block)),
                     pa.array(np.diff(off[i:j + 1]))], names=["id", "key", "text", "block", "size"])
                block += 1
    return materialise(text_batches(docs).select("id", "key", "text").mapInArrow(
        releasing(deal), f"id {kind}, key binary, text string, block bigint, size bigint"), "blocks")


def shared_shingles(blocks: DataFrame) -> DataFrame:
    """(block, h, n): the shingles of a block, packed, that stand in several documents, and in how many of all documents. A
    block has several rows."""
    shards = 1 + (blocks.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            ids = batch.column("block").to_numpy()
            for first, last in _runs(ids):
                found = [np.zeros(0, U)]
                for i, j in slices(off[first:last + 1]):
                    found.append(bags(data, off[first + i:first + j + 1])[0])
                h = np.concatenate(found)
                _, h, n, _ = _add_up(h, np.ones(len(h), np.uint32))
                shard = ((h >> U(32)) * U(shards)) >> U(32)
                cuts = np.array([0] + [j for _, j in _runs(shard)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[cuts[:-1]].astype(np.int64)), pa.array(np.full(len(cuts) - 1, ids[first])), _planes(h, cuts),
                     _planes(n.astype(np.uint32), cuts)], names=["shard", "block", "h", "n"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            parts = _from_planes(rows.column("h"), U)
            block = np.repeat(rows.column("block").to_numpy(), [len(x) for x in parts])
            h, counts = np.concatenate(parts), np.concatenate(_from_planes(rows.column("n"), np.uint32))
            order, _, total, times = _add_up(h, counts.astype(np.int64))
            n = np.empty(len(h), np.uint32)
            n[order] = np.repeat(total, times)
            several = np.flatnonzero(n > 1)
            several = several[np.argsort(block[several], kind="stable")]
            cuts = np.array([0] + [j for _, j in _runs(block[several])])
            return pa.RecordBatch.from_arrays([pa.array(block[several][cuts[:-1]]), _planes(h[several], cuts), _planes(n[several], cuts)],
                                              names=["block", "h", "n"])

        for batch in batches:
            ids = batch.column("shard").to_numpy()
            for i, j in _runs(ids):
                if held and held[-1].column("shard")[0].as_py() != ids[i]:
                    yield done()
                    held.clear()
                held.append(batch.slice(i, j - i))
        if held:
            yield done()

    sent = blocks.select("block", "text").mapInArrow(releasing(send), "shard bigint, block bigint, h binary, n binary")
    return materialise(sent.repartition(shards, "shard").sortWithinPartitions("shard")
                       .mapInArrow(releasing(answer), "block bigint, h binary, n binary"), "shared-shingles", drop_shuffles=True)


def weighted_jaccard(left: pa.Array, right: pa.Array, left_n: pa.Array, right_n: pa.Array, n_docs: int) -> np.ndarray:
    """Exact weighted Jaccard similarity of text pairs, with the frequencies of their shingles."""
    out = np.zeros(len(left))
    (ld, lo), (rd, ro) = utf8(left), utf8(right)
    (ln, lb), (rn, rb) = _frequencies(left_n), _frequencies(right_n)
    for i, j in slices(lo + ro):
        lh, lw, lf = weighted(ld, lo[i:j + 1], ln[lb[i]:lb[j]], n_docs)
        rh, rw, rf = weighted(rd, ro[i:j + 1], rn[rb[i]:rb[j]], n_docs)
        for k in range(j - i):
            a, b = slice(lf[k], lf[k + 1]), slice(rf[k], rf[k + 1])
            total = lw[a].sum() + rw[b].sum()
            if total:
                _, x, y = np.intersect1d(lh[a], rh[b], assume_unique=True, return_indices=True)
                both = np.minimum(lw[a][x], rw[b][y]).sum()
                out[i + k] = both / (total - both)
    return out


def signatures(docs: DataFrame) -> tuple[DataFrame, int]:
    """``docs`` (id, key, text) -> id, key, bands (one hash per band), samples (SAMPLES ints), n (in how many documents
    each distinct shingle stands, packed in the order of their hashes), and the number of documents; texts without
    words have null bands."""
    blocks = in_blocks(docs)
    n_docs = blocks.count()
    none, id_type = F.lit(None), docs.schema["id"].dataType
    rows = blocks.select("block", F.lit(1).alias("kind"), "id", "key", "text", none.cast("binary").alias("h"), none.cast("binary").alias("n"))
    answers = shared_shingles(blocks).select("block", F.lit(0).alias("kind"), none.cast(id_type).alias("id"), none.cast("binary").alias("key"),
                                             none.cast("string").alias("text"), "h", "n")

    def signed(batch: pa.RecordBatch, known: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        data, off = utf8(batch.column("text"))
        for i, j in slices(off):
            h, tf, first = bags(data, off[i:j + 1])
            n = np.ones(len(h), np.uint32)
            if len(known):
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                n = np.where(known[at] == h, times[at], n)
            some = np.diff(first) > 0
            bands = np.zeros((j - i, BANDS), np.int64)
            short = np.zeros((j - i, SAMPLES), np.int32)
            if some.any():
                s = sample(h, tf * idf(n, n_docs), first)
                z = np.zeros((len(s), BANDS), U)
                for k in range(ROWS):
                    z = mix(z + s[:, k::ROWS] * U(0x9E3779B97F4A7C15))
                bands[some] = (z + np.arange(BANDS, dtype=U)).view(np.int64)
                short[some] = (s >> U(32)).astype(np.uint32).view(np.int32)
            empty = pa.array(~some)
            lists = lambda x, kind: pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel(), kind), mask=empty)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(i, j - i), batch.column("key").slice(i, j - i),
                 lists(bands, pa.int64()), lists(short, pa.int32()), _packed(n, first)], names=["id", "key", "bands", "samples", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, known = None, [], None
        for batch in batches:
            ids, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            for i, j in _runs(ids, kinds):
                if ids[i] != block:
                    block, held, known = ids[i], [(np.zeros(0, U), np.zeros(0, np.uint32))], None
                part = batch.slice(i, j - i)
                if kinds[i] == 0:
                    held += zip(_from_planes(part.column("h"), U), _from_planes(part.column("n"), np.uint32))
                    continue
                if known is None:
                    h, n = (np.concatenate(c) for c in zip(*held))
                    order = np.argsort(h)
                    held, known = [], (h[order], n[order])
                yield from signed(part, *known)

    met = rows.unionByName(answers).repartition("block").sortWithinPartitions("block", "kind")
    return materialise(met.mapInArrow(releasing(run), f"id {id_type.simpleString()}, key binary, bands array<bigint>, samples array<int>, n binary"),
                       "signatures", drop_shuffles=True), n_docs


def links_across(members: DataFrame, signed: DataFrame, texts: DataFrame, n_docs: int, threshold: float) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different components so far.

    The members outside a bucket's main component (left) meet all members (right), in blocks of about
    BLOCK by BLOCK: a task gets the texts of two blocks once and returns only links that join components,
    so neither a pair list nor a large bucket ever comes together. A pair is compared in the first band
    that it shares, if its samples, weights and components leave it open.
    """
    blocks = lambda n: F.greatest(F.ceil(n / F.lit(float(BLOCK))), F.lit(1)).cast("int")
    outside = F.col("component") != F.col("main")
    d = members.select("bucket", "band", "key", "component", outside.alias("outside"),
                       blocks(F.col("n") - F.col("most")).alias("nl"), blocks(F.col("n")).alias("nr"))
    deal = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["bucket", "band", "key", "component", "outside"]
    # one block on either side: the right rows serve as left rows too
    right = d.select(*cols, (F.col("nl") * F.col("nr") == 1).alias("left"), F.lit(True).alias("right"), deal("nr").alias("r"),
                     every("nl").alias("l"))
    left = d.where("outside and nl * nr > 1").select(*cols, F.lit(True).alias("left"), F.lit(False).alias("right"),
                                                     every("nr").alias("r"), deal("nl").alias("l"))
    dealt = (right.unionByName(left).join(signed.select("key", "bands", "samples"), "key").join(texts, "key")
             .withColumn("task", F.xxhash64("bucket", "l", "r")))

    def compare(rows: dict) -> list[tuple[bytes, bytes]]:
        key, component = rows["key"], rows["component"]
        lists = lambda c, kind: np.array(rows[c], kind)
        samples, bands = lists("samples", np.int32), lists("bands", np.int64)
        lefts = np.flatnonzero(lists("left", bool) & lists("outside", bool))
        rights = np.flatnonzero(lists("right", bool))
        kinds = {c: n for n, c in enumerate(dict.fromkeys(component))}
        part = np.array([kinds[c] for c in component])
        parent = list(range(len(kinds)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        data, off = utf8(pa.array(rows["text"], pa.large_string()))
        bags = [None] * len(key)
        for i, j in slices(off):
            n = np.frombuffer(b"".join(rows["n"][i:j]), np.uint32)
            h, w, f = weighted(data, off[i:j + 1], n, n_docs)
            for r in range(j - i):
                bags[i + r] = h[f[r]:f[r + 1]], w[f[r]:f[r + 1]]
        weight = np.array([b[1].sum() for b in bags])
        out = []
        for x in lefts.tolist():
            same = bands[rights] == bands[x]
            open_ = ((samples[rights] == samples[x]).sum(axis=1) >= LEAST_EQUAL) & (part[rights] != part[x])
            open_ &= same.argmax(axis=1) == rows["band"][x]
            open_ &= np.minimum(weight[rights], weight[x]) >= threshold * np.maximum(weight[rights], weight[x]) - 1e-9
            for y in rights[open_].tolist():
                if rows["outside"][y] and key[y] <= key[x] or find(part[x]) == find(part[y]):
                    continue
                (hx, wx), (hy, wy) = bags[x], bags[y]
                _, p, q = np.intersect1d(hx, hy, assume_unique=True, return_indices=True)
                both = np.minimum(wx[p], wy[q]).sum()
                if both / (weight[x] + weight[y] - both) >= threshold - 1e-12:
                    parent[find(part[x])] = find(part[y])
                    out.append((key[x], key[y]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            found = compare(pa.Table.from_batches(held).to_pydict())
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

        for batch in batches:
            ids = batch.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for i, j in zip(cuts, cuts[1:]):
                if held and held[-1].column("task")[0].as_py() != ids[i]:
                    yield done()
                    held.clear()
                if j > i:
                    held.append(batch.slice(i, j - i))
        if held:
            yield done()

    return (dealt.select("task", *cols, "left", "right", "bands", "samples", "text", "n").repartition("task")
            .sortWithinPartitions("task").mapInArrow(releasing(run), "a binary, b binary"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                           threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id and class_id, the smallest id among the documents linked to it."""
    base = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text))).alias("key"), F.col(text).alias("text"))
    signed, n_docs = signatures(base)

    worded = signed.where(F.col("bands").isNotNull())
    # equal texts: one node, named by its smallest id; samples are equal within it
    nodes = materialise(worded.groupBy("key").agg(F.min("id").alias("node")), "nodes")
    named = worded.join(nodes, "key")
    first = materialise(named.where("id = node").dropDuplicates(["key"])
                        .select("node", "key", "bands", "samples"), "named")
    members = first.select("node", "key", F.posexplode("bands").alias("band", "bucket"))

    buckets = materialise(members.groupBy("bucket").agg(F.min(F.struct("node", "key")).alias("head"),
                                                        F.count("*").alias("n")).where("n > 1"), "buckets")
    met = materialise(members.join(buckets, "bucket"), "met")
    star = (met.where(F.col("key") != F.col("head.key"))
            .select(F.col("head.key").alias("a"), F.col("key").alias("b")).distinct())
    star = materialise(star, "star")

    asked = materialise(met.select(F.col("key").alias("k"), "node").distinct(), "asked")
    candidates = lambda d, c: d.join(
        broadcast_checked(asked), (F.col("id") == F.col("node")) & (F.col("key") == F.col("k")), "left_semi").groupBy("key").agg(F.min(c).alias(c))
    texts = materialise(candidates(base, "text").join(candidates(signed, "n"), "key"), "candidate-texts")

    similarity = F.arrow_udf(lambda a, b, m, n: pa.array(weighted_jaccard(a, b, m, n, n_docs)), "double")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        two = (pairs.join(texts.select(F.col("key").alias("b"), F.col("text").alias("tb"), F.col("n").alias("nb")), "b")
               .join(texts.select(F.col("key").alias("a"), F.col("text").alias("ta"), F.col("n").alias("na")), "a"))
        return materialise(two.select("a", "b", similarity("ta", "tb", "na", "nb").alias("similarity"))
                           .where(F.col("similarity") >= threshold - 1e-12).select("a", "b"), name)

    links = verified(star, "star-links")
    comp = connected_components(links)

    # buckets that hold more than one component
    placed = met.select("bucket", "band", "key").join(comp.withColumnRenamed("node", "key"), "key", "left") \
        .withColumn("component", F.coalesce("component", "key"))
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"),
                                        F.max_by("component", F.struct("n", "component")).alias("main")).where("parts > 1")
    mixed = materialise(mixed, "mixed")
    if not mixed.isEmpty():
        more = materialise(links_across(placed.join(mixed, "bucket"), first, texts, n_docs, threshold), "across-links")
        if not more.isEmpty():
            comp = connected_components(links.union(more))

    # components are named by a text key; name them by the smallest id instead
    owner = nodes.join(comp.withColumnRenamed("node", "key"), "key")
    smallest = owner.groupBy("component").agg(F.min("node").alias("class_id"))
    classes = owner.join(smallest, "component").select("key", "class_id")
    classes = materialise(nodes.join(classes, "key", "left")
                          .select("key", F.coalesce("class_id", "node").alias("class_id")), "classes")
    keyed = signed.select("id", F.when(F.col("bands").isNotNull(), F.col("key")).alias("key"))
    return keyed.join(classes, "key", "left").select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"))


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that name their class, columns unchanged. Rows that repeat an id count as one
    document: the one with the smallest text stays."""
    gone = near_duplicate_classes(docs, id_col, text).where(F.col(id_col) != F.col("class_id"))
    gone = materialise(gone.select(F.col(id_col).alias("_gone")).distinct(), "near-duplicates")
    again = materialise(docs.groupBy(F.col(id_col).alias("_again")).count().where("count > 1").select("_again"), "again")
    kept = docs.join(broadcast_checked(gone), docs[id_col] == F.col("_gone"), "left_anti")
    if again.isEmpty():
        return kept
    repeated = kept.join(broadcast_checked(again), kept[id_col] == F.col("_again"), "left_semi")
    place = fresh(repeated, "_place")
    one = (repeated.withColumn(place, F.row_number().over(Window.partitionBy(id_col).orderBy(text)))
           .where(F.col(place) == 1).drop(place))
    return kept.join(broadcast_checked(again), kept[id_col] == F.col("_again"), "left_anti").unionByName(one)
