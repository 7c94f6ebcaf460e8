"""The operators of the pipeline against plain Python versions, on corpora with planted cases."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from corpus import SCHEMA, contained, corpus, kept_words, near_classes, quality, split

from autoprice.llm import decontaminate, near_dup, packing, quality_rules, substring_dedup
from autoprice.llm.components import connected_components
from autoprice.llm.suffix_automaton import SuffixAutomaton
from autoprice.llm.tokens import Encoder, encoder

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")
BYTE = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", params=[1, 2])
def made(spark, request):
    df, docs = corpus(spark, request.param, extra=request.param == 2)
    return df.cache(), docs


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_counts(made):
    df, docs = made
    got = {r.doc_id: r for r in quality_rules.quality_report(df).collect()}
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        r, want = got[i], quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_quality_fences_adapt(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        source = "code" if i % 2 else "prose"
        w = [f"{rng.getrandbits(40):x}" for _ in range(100)]
        n = 30 + i % 9 if source == "code" else (60 if i % 50 == 0 else 0)
        rows.append((i, " ".join(w[:100 - n] + ["#"] * 0 + [x + "#" for x in w[100 - n:]]), "en", source, 0))
    kept = {r.doc_id: r.kept for r in quality_rules.quality_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    # symbols are ordinary in one source and an outlier in the other
    assert all(kept[i] for i in range(1, 300, 2))
    assert [i for i in range(0, 300, 2) if not kept[i]] == [i for i in range(0, 300, 2) if i % 50 == 0]


def test_quality_filter_keeps_columns(made):
    df, _ = made
    kept = {r.doc_id for r in quality_rules.quality_report(df).where("kept").collect()}
    out = quality_rules.quality_filter(df)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == kept


def test_near_duplicates(made):
    df, docs = made
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicate_classes(df).collect()}
    assert got == near_classes(docs, near_dup.THRESHOLD, near_dup.IDF_SHARE)
    out = near_dup.keep_one_per_class(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, c in got.items() if i == c)


def test_near_duplicates_weigh_every_shingle(spark, monkeypatch):
    """Two texts that share what many documents hold and differ in what no other holds: alike by counts, not by TF-IDF."""
    common = [f"c{k}" for k in range(100)]
    rows = [(i, " ".join(common[:90] + [f"own{i}_{k}" for k in range(9)]), "en", "s", 0) for i in range(3)]
    rows += [(10 + i, " ".join(common[i % 9:91 + i % 7] + [f"more{i}_{k}" for k in range(60)]), "en", "s", 0) for i in range(9)]
    rows += [(100 + i, " ".join(f"x{i}_{k}" for k in range(40)), "en", "s", 0) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(near_dup, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 1 << 13)
    docs = {r[0]: r[1] for r in rows}
    want = near_classes(docs, near_dup.THRESHOLD, 0.0)
    assert want != near_classes(docs, near_dup.THRESHOLD, 0.05)
    assert {r.doc_id: r.class_id for r in near_dup.near_duplicate_classes(df).collect()} == want


def test_shingle_frequencies_are_exact(made, monkeypatch):
    import numpy as np
    df, docs = made
    monkeypatch.setattr(near_dup, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", 1 << 13)
    signed, n_docs = near_dup.signatures(df.selectExpr("doc_id AS id", "unhex(md5(text)) AS key", "text"))
    bags = {i: {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))} for i, w in ((i, split(t)) for i, t in docs.items())}
    count = Counter(s for b in bags.values() for s in b)
    got = {r.id: sorted(np.frombuffer(bytes(r.n), np.uint32).tolist()) for r in signed.collect()}
    assert n_docs == len(docs)
    assert got == {i: sorted(count[s] for s in b) for i, b in bags.items()}


def test_near_duplicates_repeated_rows(made):
    df, _ = made
    out = near_dup.keep_one_per_class(df.union(df))
    assert out.count() == near_dup.keep_one_per_class(df).count()


def test_samples_estimate_similarity():
    import numpy as np
    rng = np.random.default_rng(1)
    h = np.sort(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    weight = rng.choice([1.0, 2.5, 4.0], 4000)
    equal = []
    for k in range(40):
        pick = rng.random(4000)
        a, b = pick < .9, pick > .1
        s = [near_dup.sample(h[x], weight[x], np.array([0, x.sum()])) for x in (a, b)]
        equal.append((s[0] == s[1]).mean())
        want = weight[a & b].sum() / weight[a | b].sum()
    assert abs(np.mean(equal) - want) < .03


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(2000, 2000 + i) for i in range(1, 200)]
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_suffix_automaton():
    rng = random.Random(2)
    automaton, read = SuffixAutomaton(), []
    for _ in range(30):
        automaton.start()
        text = []
        for _ in range(40):
            text.append(rng.randrange(3))
            got = automaton.extend(text[-1])
            earlier = [t[k:] for t in read for k in range(len(t))] + [text[k:-1] for k in range(len(text) - 1)]
            n = len(text)
            want = next((m for m in range(n, 0, -1) if any(
                text[n - m:] == e[j:j + m] for e in read + [text[:-1]] for j in range(len(e) - m + 1))), 0)
            assert got == want and earlier is not None
        read.append(text)
        if len(read) > 6:
            break


@pytest.mark.parametrize("hot", [4096, 1])
def test_passages(made, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_SPANS", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    df, docs = made
    kept = kept_words(docs, substring_dedup.WINDOW)
    got = {r.doc_id: r for r in substring_dedup.passage_report(df).collect()}
    assert got.keys() == docs.keys()
    for i, w in kept.items():
        assert got[i].n_words == len(split(docs[i]))
        assert got[i].n_removed == got[i].n_words - len(w), i
        assert got[i].kept_sha256 == hashlib.sha256(" ".join(w).encode()).hexdigest()
    assert sum(r.n_removed for r in got.values()) > 1000
    cut = substring_dedup.remove_passages(df)
    assert cut.columns == df.columns
    for r in cut.collect():
        same = len(kept[r.doc_id]) == len(split(docs[r.doc_id]))
        assert r.text == (docs[r.doc_id] if same else " ".join(kept[r.doc_id]))
        assert r.n_chars == len(r.text or "")


def test_contained_items(spark, made):
    df, docs = made
    rng = random.Random(4)
    items = {j: t for j, t in enumerate(["", None, "one two three", "a b c d e", "One, TWO", "-- !"])}
    for j, t in enumerate(t for t in docs.values() if len(split(t)) > 60):
        w = split(t)
        at = rng.randrange(len(w) - 40)
        q = w[at:at + rng.randint(5, 40)]
        if j % 3 == 0 and len(q) > 12:
            q[0] = "changed"
        items[len(items)] = " ".join(q).upper() if j % 2 else " ".join(q)
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_found, r.n_item) for r in decontaminate.contained_items(df, table).collect()}
    want = contained(docs, items, decontaminate.THRESHOLD)
    assert got == want and len(want) > 30
    assert {i for i, j in want if j == 4} == {i for i, t in docs.items() if split(t or "") == ["one", "two"]} != set()
    out = decontaminate.remove_contaminated(df, table)
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == docs.keys() - {i for i, _ in want}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_encode_as_whole(name):
    path = P.path(name)
    plain = tokenizers.Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    rng = random.Random(6)
    parts = ["the", "there", "don't", "Ünïcode", "é", "12", "a1b", "!!", "...", "<|endoftext|>", "x y", "́e", "ΣΑΣ", "'s", "日本"]
    made = ["", " ", "a ", " a", "\n\na"]
    for _ in range(400):
        seps = [" "] * 8 + ["\n"] * 3 + (["  ", "\t", "\r\n", " ", "\x1c", "\x85 "] if rng.random() < .3 else [])
        made.append("".join(rng.choice(parts) + rng.choice(seps) for _ in range(rng.randint(1, 12))) + rng.choice(["", "end"]))
    made += [f"{a}{s}{b}{m}" for a in parts for b in parts for s in (" ", "\n") for m in ("", ".", "!?", "…")]
    encode = Encoder(path).encode
    import pyarrow as pa
    for t, ids in [*zip(made, encode(pa.array(made))), *zip(made[::-1], encode(pa.array(made[::-1])))]:
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_operators_encode_as_the_library(name):
    import pyarrow as pa
    plain = tokenizers.Tokenizer.from_file(P.path(name))
    made = ["see <|endoftext|> here", "a<|endoftext|>", "<|startoftext|> b c", "no token <|endof", "text|> at all", "", "see here"]
    for t, ids in zip(made, encoder(P.path(name)).encode(pa.array(made))):
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_displaced_units_keep_their_ids(name):
    import pyarrow as pa
    plain = tokenizers.Tokenizer.from_file(P.path(name))
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeéAB") for _ in range(rng.randint(1, 9))) + rng.choice(["", ".", ",!", "$$$"])
    words = [word() for _ in range(500)]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    few = Encoder(P.path(name), literal=False, units=16)  # fewer than a text has; its ids are dropped again and again
    for batch in (made[:100], made[100:200], made[200:], made[:100]):
        for t, ids in zip(batch, few.encode(pa.array(batch))):
            assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)


def test_byte_units_need_no_offsets():
    import pyarrow as pa
    made = [f"wörd{i}\n日本{i}, end{i}!" for i in range(50)]
    enc = Encoder(BYTE, literal=False)
    plain = enc._tokenizer

    class Ids:
        def __init__(self, x):
            self.ids = x.ids

    class Library:
        def encode_batch(self, texts, **kw):
            return [Ids(x) for x in plain.encode_batch(texts, **kw)]

        encode_batch_fast = encode_batch

        def encode(self, text, **kw):
            return Ids(plain.encode(text, **kw))
    enc._tokenizer = Library()
    for t, ids in zip(made, enc.encode(pa.array(made))):
        assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids


def test_encoder_memory_is_that_of_a_small_slice():
    import tracemalloc

    import pyarrow as pa
    made = pa.array([" ".join(f"w{i}x{j % 97}" for j in range(1000)) for i in range(300)])  # 2 MB
    enc = Encoder(BYTE, literal=False)
    tracemalloc.start()
    for _ in enc.encode(made):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10e6


def test_huffman_codes_few_ids_at_a_time(monkeypatch):
    import numpy as np

    from autoprice.llm import huffman
    seen = []
    plain, own = huffman.encode_documents, huffman.CODED

    def counted(documents, *book):
        n = [len(x) for x in documents]
        seen.append(len(n) > 1 and sum(n) > own)
        return plain(documents, *book)
    monkeypatch.setattr(huffman, "encode_documents", counted)
    rng = np.random.default_rng(3)
    docs = [np.append(rng.integers(2, 900, n), 1) for n in (30_000, 5, 40_000, 0, 70_000, 9, 60_000)]
    lengths = huffman.code_lengths(np.bincount(np.concatenate(docs)))
    book = lengths, huffman.canonical_codes(lengths)
    whole = plain(docs, *book)
    parts = list(huffman.coded(docs, *book))
    assert len(seen) > 1 and not any(seen) and len(parts) == len(whole)
    assert all(a[0] == b[0] and a[1].tolist() == b[1].tolist() for a, b in zip(parts, whole))


def test_packing(made):
    import numpy as np
    df, docs = made
    plain = tokenizers.Tokenizer.from_file(BYTE)
    rows = packing.packed_documents(df, BYTE).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == docs.keys()
    total = 0
    for i, t in docs.items():
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        at = 0
        own = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        for k, r in enumerate(own):
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            assert len(own) == 1 and r.length <= 2048 or r.length == 2048 or k == 0
            at += r.length
        assert at == len(ids)
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by_sequence) <= -(-total // 2048) + 1


def test_sum_of_squares_rule():
    import numpy as np
    rng = random.Random(1)
    sizes = [rng.randint(1, 10) for _ in range(500)]
    sequence, offset = packing.sum_of_squares(np.array(sizes), 10)
    gaps: dict[int, int] = {}
    for size, s, o in zip(sizes, sequence.tolist(), offset.tolist()):
        count = lambda g: sum(x == g for x in g_now.values() if x)
        options = {}
        for g in {x for x in gaps.values() if x >= size} or {10}:
            g_now = dict(gaps)
            g_now["new" if g == 10 else next(k for k, x in gaps.items() if x == g)] = g - size
            options[g] = sum(count(x) ** 2 for x in set(g_now.values()) if x)
        assert options[10 - o] == min(options.values())
        gaps[s] = 10 - o - size
        assert gaps[s] >= 0


def test_empty_tables(spark, empty):
    items = spark.createDataFrame([], "item_id long, text string")
    assert quality_rules.quality_report(empty).count() == 0
    assert quality_rules.quality_filter(empty).count() == 0
    assert near_dup.keep_one_per_class(empty).count() == 0
    assert substring_dedup.passage_report(empty).count() == 0
    assert decontaminate.remove_contaminated(empty, items).count() == 0
    assert packing.packed_documents(empty, BYTE).count() == 0


def test_null_ids(spark):
    t = " ".join(f"v{k}" for k in range(60))
    df = spark.createDataFrame([(None, t, None, None, None), (1, t, None, None, None), (2, t, "en", "x", 0)], SCHEMA)
    items = spark.createDataFrame([(None, t), (7, t)], "item_id long, text string")
    assert quality_rules.quality_report(df).where("kept").count() == 3
    assert near_dup.near_duplicate_classes(df).count() == 3
    assert {(r.doc_id, r.n_removed) for r in substring_dedup.passage_report(df).collect()} == {(None, 0), (1, 0), (2, 60)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contained_items(df, items).collect()} == {(1, 7), (2, 7)}
    assert packing.packed_documents(df, BYTE).count() == 3
