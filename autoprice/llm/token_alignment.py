"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by their full content to one row a distinct text with its multiplicity. Each distinct text is
encoded by both vocabularies and aligned on byte offsets: the ends of A's and B's tokens cut it into segments, and
each segment is the overlap of exactly one A token with one B token, a link; offsets where both end cut it into
groups. Links are counted by id pair over the corpus, weighted by multiplicity, and a text's measures need
the corpus-wide counts of its own pairs, so:

1. A task aligns its distinct texts in blocks of BLOCK bytes. A block is one row: its texts' keys and counts, its
   distinct id pairs with their weighted counts, and numbers of units and pairs (below) by which to find a text's links again.
2. (block, pair, count) is summed by pair; a join with the highest count by B id marks the best pairs.
3. The sums go back to the blocks that asked for them by a join on the pair. A block has a pair once, so
   a frequent pair weighs no more than the number of blocks. Each block meets its own pairs' counts (a cogroup by block)
   and gives one row a text.
4. Measures are joined to documents by the text's SHA-256. Texts of more than max(1000, N / 1000) documents are at
   most 1000 and are broadcast; the others have no hot key.

Nothing grows with the corpus in one place: no pair table is broadcast or collected.

Within a block, texts are cut into units at each single space between two characters that are surely no white space. Neither
vocabulary has a token across such a place, A's tokens keep the space in front of them, and B puts one there, so a text's tokens,
groups and links are those of its units in order. A unit that a block has several times is encoded and aligned once. New units are
encoded many at a time, joined by spaces, and their tokens dealt by byte offsets. A unit that begins or ends otherwise (with white space, or a
character that might be) is encoded alone.

Defined cases: null and empty texts, and those whose tokens' bytes do not join to a space and the text (as for a
text with U+2581), have zeros and the digest ''; rows that repeat an id are rows of their own; an empty table gives
no rows; other columns are ignored. A text without any cutting place is one unit, whatever its length.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autoprice.llm.common import materialise, release_memory
from autoprice.llm.textcore import utf8

BLOCK = 4 << 20   # bytes of text to a block, at least one text
JOIN = 1 << 16    # bytes of units to one call of a library
HOT = 1000        # texts of more than N / HOT documents are broadcast: fewer than HOT of them

_MEASURES = ("n_a", "n_b", "n_groups", "n_links")

# Bytes that begin a character that is no white space under any definition: printable ASCII, two-byte letters and
# signs from U+00C0, and three-byte characters from U+4000 to U+DFFF.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = _SOLID[0xC3:0xE0] = _SOLID[0xE4:0xEE] = True


def _solid_before(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place (not at a text's begin) is surely no white space."""
    one, two, three = (buf[np.maximum(at - k, 0)] for k in (1, 2, 3))
    tail = lambda b: (b & 0xC0) == 0x80
    return (one < 0x80) & _SOLID[one] | tail(one) & ((two >= 0xC3) & (two < 0xE0) | tail(two) & (three >= 0xE4) & (three < 0xEE))


def units(buf: np.ndarray, off: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of non-empty texts (bytes with row offsets from 0), and each text's first unit (and one more)."""
    at = np.flatnonzero(buf == 32)
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    at = at[~edge[at] & ~edge[at + 1]]
    cut = at[_SOLID[buf[at + 1]] & _solid_before(buf, at)]
    begin = np.union1d(off[:-1], cut + 1)
    kept = np.ones(len(buf), bool)
    kept[cut] = False
    first = np.append(begin - np.searchsorted(cut, begin), len(buf) - len(cut)).astype(np.int32)
    return (pa.StringArray.from_buffers(len(begin), pa.py_buffer(first), pa.py_buffer(np.ascontiguousarray(buf[kept]))),
            np.searchsorted(begin, off))


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else the next
    unused one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Side:
    """One vocabulary: ids of texts, and the bytes of each id."""

    def __init__(self, token_bytes: list[bytes]) -> None:
        self.length = np.array([len(t) for t in token_bytes], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(token_bytes), np.uint8)

    def encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def ids(self, words: list[str], size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, number of ids by unit). ``size``: bytes with the space before; ``plain``: may be joined."""
        runs, alone, n = [], np.flatnonzero(~plain).tolist(), np.zeros(len(words), np.int64)
        some = np.flatnonzero(plain)
        part = np.cumsum(size[some]) // JOIN
        runs = np.split(some, np.flatnonzero(np.diff(part)) + 1) if len(some) else []
        flat: list[np.ndarray] = []
        order: list[np.ndarray] = []
        for k in range(0, len(runs), 8):
            for run, got in zip(runs[k:k + 8], self.encode([" ".join([words[i] for i in r.tolist()]) for r in runs[k:k + 8]])):
                got = np.array(got, np.int64)
                ends = np.cumsum(self.length[got])
                want = np.cumsum(size[run])
                cut = np.searchsorted(ends, want)
                if len(ends) and ends[-1] == want[-1] and (ends[cut] == want).all():
                    n[run] = np.diff(cut + 1, prepend=0)
                    flat.append(got)
                    order.append(run)
                else:  # some unit's tokens have other bytes: which one shows when each is encoded alone
                    alone += run.tolist()
        for k in range(0, len(alone), 512):
            got = self.encode([words[i] for i in alone[k:k + 512]])
            n[alone[k:k + 512]] = [len(g) for g in got]
            flat += [np.array(g, np.int64) for g in got]
            order.append(np.array(alone[k:k + 512]))
        given = np.concatenate([*order, np.zeros(0, np.int64)]).astype(np.int64)
        ids = np.concatenate([*flat, np.zeros(0, np.int64)])
        first = np.zeros(len(words), np.int64)
        first[given] = np.cumsum(n[given]) - n[given]
        return ids[np.repeat(first - np.cumsum(n) + n, n) + np.arange(len(ids))], n

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, joined."""
        n = self.length[ids]
        return self.data[np.repeat(self.first[ids] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]


class ByteLevel(Side):
    """A byte-level vocabulary of the tokenizers library, applied to a space and the text."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        byte = byte_alphabet()
        vocabulary = {i: t for t, i in self._tokenizer.get_vocab().items()}
        super().__init__([bytes(byte[c] for c in vocabulary[i]) if i in vocabulary and all(c in byte for c in vocabulary[i])
                          else vocabulary.get(i, "").encode() for i in range(max(vocabulary) + 1)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Side):
    """A sentencepiece vocabulary, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor
        self._model = m = SentencePieceProcessor(model_file=path)
        super().__init__([bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                          for i in range(m.get_piece_size())])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class Aligner:
    """``align(words)``: of distinct units, which are good (their tokens' bytes join to a space and the unit), their measures, their groups as
    text, and their links in order as A id * (size of B) + B id."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b, self.size_b = a, b, len(b.length)
        self._written = [f"{i}{end}" for i in range(max(len(a.length), len(b.length))) for end in (",", "|", ";", "")]

    def align(self, words: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray], list[str], np.ndarray]:
        buf, off = utf8(words)
        buf, off = buf[off[0]:off[-1]], off - off[0]
        size, texts = np.diff(off) + 1, words.to_pylist()
        plain = _SOLID[buf[off[:-1]]] & _solid_before(buf, off[1:])
        ids, count, good = [], [], np.ones(len(words), bool)
        for side in (self.a, self.b):
            x, n = side.ids(texts, size, plain)
            good &= np.bincount(np.repeat(np.arange(len(n)), n), side.length[x], len(n)).astype(np.int64) == size
            ids.append(x)
            count.append(n)
        spaced = np.insert(buf, off[:-1], 32)
        for k, side in enumerate((self.a, self.b)):  # those of equal length are compared byte by byte
            if good.any():
                first = np.cumsum(size[good]) - size[good]
                differs = np.logical_or.reduceat(side.joined(ids[k][np.repeat(good, count[k])]) != spaced[np.repeat(good, size)], first)
                good[np.flatnonzero(good)[differs]] = False
        for k in (0, 1):
            ids[k] = ids[k][np.repeat(good, count[k])]
            count[k] = np.where(good, count[k], 0)
        (a, b), ends = ids, np.cumsum(np.where(good, size, 0))
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        cut = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, cut), np.searchsorted(end_b, cut)
        both = cut[(end_a[at_a] == cut) & (end_b[at_b] == cut)] if len(cut) else cut
        out = {"n_a": count[0], "n_b": count[1]}
        for name, where in (("n_links", cut), ("n_groups", both)):
            out[name] = np.diff(np.searchsorted(where, ends, side="right"), prepend=0)
        return good, out, self._groups(a, b, end_a, end_b, both, ends, count), a[at_a] * self.size_b + b[at_b]

    def _groups(self, a, b, end_a, end_b, both, ends, count) -> list[str]:
        """Each unit's groups, written ``a1,a2|b1;a3|b2,b3``."""
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        token = np.zeros(len(a) + len(b), np.int64)
        last_a, last_b = (both[g] == e if len(both) else g for g, e in ((group_a, end_a), (group_b, end_b)))
        token[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = 4 * a + last_a
        token[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = 4 * b + np.where(np.isin(end_b, ends), 3, 2 * last_b)
        text, written = token.tolist(), self._written
        bound = np.concatenate([[0], np.cumsum(count[0] + count[1])]).tolist()
        return ["".join([written[t] for t in text[i:j]]) for i, j in zip(bound, bound[1:])]


def _sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``n`` values (0 for none)."""
    out = np.zeros(len(n), np.int64)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(values.astype(np.int64), (np.cumsum(n) - n)[some])
    return out


def pack_codes(codes: np.ndarray) -> bytes:
    """Small integers as compressed byte planes."""
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(codes) else b""


def unpack_codes(data: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data, 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


_BLOCKS = ("block long, keys array<binary>, copies array<long>, digests array<string>, "
           + ", ".join(f"{m} array<long>" for m in _MEASURES)
           + ", text_units array<long>, units binary, unit_links array<long>, links binary, pairs array<long>, counts array<long>")


def _by_frequency(codes: np.ndarray, size: int) -> np.ndarray:
    """The new number of each code, frequent ones first: small numbers compress well."""
    place = np.empty(size, np.int64)
    place[np.argsort(-np.bincount(codes, minlength=size), kind="stable")] = np.arange(size)
    return place


def _block_row(aligner: Aligner, number: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row of _BLOCKS of some texts."""
    t = pa.Table.from_batches(batches).combine_chunks()
    buf, off = utf8(t.column("text"))
    copies = np.asarray(t.column("copies"))
    words, first = units(buf[off[0]:off[-1]], off - off[0])
    coded = words.dictionary_encode()
    code, n_units = np.asarray(coded.indices).astype(np.int64), np.diff(first)
    good, measures, groups, links = aligner.align(coded.dictionary)
    whole = np.logical_and.reduceat(good[code], first[:-1])
    sums = {m: np.where(whole, _sums(measures[m][code], n_units), 0) for m in _MEASURES}
    bound = first.tolist()
    digests = [hashlib.sha256(";".join([groups[u] for u in code[i:j].tolist()]).encode()).hexdigest() if ok else ""
               for i, j, ok in zip(bound, bound[1:], whole.tolist())]
    code, n_units = code[np.repeat(whole, n_units)], np.where(whole, n_units, 0)
    times = np.bincount(code, np.repeat(copies, n_units), len(good))
    pairs, link = np.unique(links, return_inverse=True)
    counts = np.bincount(link, np.repeat(times, measures["n_links"]), len(pairs)).astype(np.int64)
    unit_place, pair_place = _by_frequency(code, len(good)), _by_frequency(link, len(pairs))
    in_order = np.argsort(unit_place)
    n_links, start = measures["n_links"], np.cumsum(measures["n_links"]) - measures["n_links"]
    moved = n_links[in_order]
    link = link[np.repeat(start[in_order] - np.cumsum(moved) + moved, moved) + np.arange(len(link))]
    at = np.argsort(pair_place)
    lists = [(t.column("key").to_pylist(), pa.binary()), (copies, pa.int64()), (digests, pa.string()), *((sums[m], pa.int64()) for m in _MEASURES),
             (n_units, pa.int64()), (moved, pa.int64()), (pairs[at], pa.int64()), (counts[at], pa.int64())]
    columns = dict(zip(["keys", "copies", "digests", *_MEASURES, "text_units", "unit_links", "pairs", "counts"],
                       (pa.ListArray.from_arrays([0, len(x)], pa.array(x, k)) for x, k in lists)))
    columns |= {"block": pa.array([number]), "units": pa.array([pack_codes(unit_place[code])], pa.binary()),
                "links": pa.array([pack_codes(pair_place[link])], pa.binary())}
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def _align_texts(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        aligner, held, size = None, [], 0
        for batch in batches:
            ends, begin = np.cumsum(np.asarray(batch.column("size"))), 0
            while begin < batch.num_rows:
                aligner = aligner or Aligner(ByteLevel(path_a), Pieces(path_b))
                done = int(ends[begin - 1]) if begin else 0
                end = min(batch.num_rows, begin + 1 + int(np.searchsorted(ends[begin:], done + BLOCK - size)))
                held.append(batch.slice(begin, end - begin))
                size += int(ends[end - 1]) - done
                begin = end
                if size >= BLOCK:
                    yield _block_row(aligner, number, held)
                    number, held, size = number + 1, [], 0
                    release_memory()
        if held:
            yield _block_row(aligner, number, held)
        del aligner, held
        release_memory()
    return run


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """The corpus's distinct texts, aligned: a written table of blocks."""
    t = docs.select(F.col(text).alias("text")).where(F.col("text") != "")
    t = t.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    t = t.select("text", "copies", F.unhex(F.sha2("text", 256)).alias("key"), F.octet_length("text").cast("long").alias("size"))
    return materialise(t.mapInArrow(_align_texts(path_a, path_b), _BLOCKS), "aligned")


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """(pair, count, best): the weighted links of each id pair over the corpus, and whether no pair of the same B
    id has more. ``pair`` is A id * ``size_b`` + B id."""
    asked = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).select("p.*")
    counts = materialise(asked.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")), "pair-counts")
    b = F.pmod("pair", F.lit(size_b))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # one row per B id
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _measure(asked: pa.Table, blocks: pa.Table) -> pa.Table:
    """Measures of the texts of one block from its pairs' counts."""
    row = blocks.slice(0, 1).combine_chunks()
    value = lambda name: row.column(name).chunk(0).flatten()
    count, best = np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.asarray(asked.column("i"))
    count[at], best[at] = np.asarray(asked.column("count")), np.asarray(asked.column("best"))
    unit_links, text_units = np.asarray(value("unit_links")), np.asarray(value("text_units"))
    links = unpack_codes(row.column("links")[0].as_py(), int(unit_links.sum()))
    code = unpack_codes(row.column("units")[0].as_py(), int(text_units.sum()))
    n_best, total = (_sums(_sums(x[links], unit_links)[code], text_units) for x in (best, count))
    return pa.table([value("keys"), value("copies"), *[value(m) for m in _MEASURES], n_best, total, value("digests")],
                    ["key", "copies", *_MEASURES, "n_best", "count_sum", "groups_sha256"])


def text_measures(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, copies, measures) of each distinct text, as a written table."""
    asked = blocks.select("block", F.posexplode("pairs").alias("i", "pair")).join(counts, "pair").select("block", "i", "count", "best")
    own = blocks.select(F.col("block").alias("of"), "keys", "copies", "digests", *_MEASURES, "text_units", "units", "unit_links", "links")
    out = "key binary, copies long, " + ", ".join(f"{m} long" for m in _MEASURES) + ", n_best long, count_sum long, groups_sha256 string"
    return materialise(asked.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(_measure, out), "text-measures")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.
    ``path_a``: a byte-level vocabulary of the tokenizers library; ``path_b``: a sentencepiece model."""
    blocks = aligned_blocks(docs, path_a, path_b, text)
    measures = text_measures(blocks, pair_counts(blocks, len(Pieces(path_b).length)))
    total = measures.agg(F.sum("copies")).first()[0] or 0
    hot = F.col("copies") > max(HOT, total // HOT)
    keyed = materialise(docs.select(F.col(id_col).alias("id"), F.when(F.col(text) != "", F.unhex(F.sha2(F.col(text), 256))).alias("key")), "keyed")
    columns = [*_MEASURES, "n_best", "count_sum", "groups_sha256"]
    first = keyed.join(F.broadcast(measures.where(hot).select("key", F.struct(*columns).alias("m"))), "key", "left")
    served = F.col("key").isNull() | F.col("m").isNotNull()
    rest = first.where(~served).drop("m").join(measures.where(~hot).select("key", F.struct(*columns).alias("m")), "key", "left")
    both = first.where(served).select("id", "m").unionByName(rest.select("id", "m"))
    return both.select(F.col("id").alias(id_col), *[F.coalesce(F.col(f"m.{c}"), F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in columns])
