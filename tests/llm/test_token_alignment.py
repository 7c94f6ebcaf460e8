"""Alignment of two vocabularies against a plain version that encodes every document whole."""

import hashlib
import random
import re
from collections import Counter

import pytest
from corpus import SCHEMA, corpus

from autoprice.llm import token_alignment as A

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")
PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")

ODD = ["see <|endoftext|> here", "<s> x </s> <0x41> <unk>", "a▁b", "▁", " ", "  two  spaces ", "\ttab\n\nlines\r\n", "\x00 nul", "naïve ﬁ   ½",
       "日本語 テキスト 👩‍👩‍👧 é", "x" * 3000, "it's can't  we'll 12345 6.7", "　wide", "end ", "ab", "ab", "ab", "﻿bom", "​", "�"]


def plain(rows):
    """Rows (id, text) -> {id: measures}; every document encoded whole, links from byte ranges."""
    t = tokenizers.Tokenizer.from_file(PATHS[0])
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    from tokenizers.pre_tokenizers import ByteLevel
    chars = sorted(ByteLevel.alphabet())
    # the printable bytes stand for themselves, the others in order from U+0100
    byte = {c: ord(c) for c in chars if ord(c) < 256}
    left = [b for b in range(256) if b not in byte.values()]
    byte |= {c: left[ord(c) - 256] for c in chars if ord(c) >= 256}
    docs, counts = [], Counter()
    for i, text in rows:
        want, a, b = (" " + (text or "")).encode(), [], []
        if text:
            a = [(x, bytes(byte[c] for c in t.id_to_token(x))) for x in t.encode(" " + text, add_special_tokens=False).ids]
            for x in sp.encode(text):
                p = sp.id_to_piece(x)
                b.append((x, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
            if b"".join(y for _, y in a) != want or b"".join(y for _, y in b) != want:
                a, b = [], []
        spans = []
        for side in (a, b):
            at, out = 0, []
            for x, y in side:
                out.append((x, at, at + len(y)))
                at += len(y)
            spans.append(out)
        links, j = [], 0
        for x, s, e in spans[0]:
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    links.append((x, spans[1][j][0]))
                j += 1
        counts.update(links)
        stops = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, before = [], 0
        for stop in stops:
            groups.append("|".join(",".join(str(x) for x, s, e in side if before < e <= stop) for side in spans))
            before = stop
        docs.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(((i, na, nb, ng, len(l), sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l), d) for i, na, nb, ng, l, d in docs), key=str)


def got(df):
    return sorted((tuple(r) for r in A.align_documents(df, *PATHS).collect()), key=str)


def test_documents_equal_whole_encoding(spark, monkeypatch):
    df, docs = corpus(spark, 9, 60, extra=True)
    rows = [*docs.items(), *((1000 + k, t) for k, t in enumerate(ODD)), (5, "repeated id"), (None, "null id"), (7, "ab")]
    rng = random.Random(3)
    rows += [(2000 + k, "one text in many rows") for k in range(400)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("key", "id", "m", "block", "pair", "count", "n_a", "copies"):
        df = df.selectExpr("*", f"'z' AS {c}")
    want = plain(rows)
    for block, join, hot in ((8 << 20, 1 << 16, 1000), (3000, 200, 5)):
        for name, v in (("BLOCK", block), ("JOIN", join), ("HOT", hot)):
            monkeypatch.setattr(A, name, v)
        assert got(df) == want


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table_and_only_empty_texts(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    df = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert got(df) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


def test_no_piece_crosses_a_cutting_place():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    assert all("▁" not in p.lstrip("▁") for p in pieces)


def test_units_cut_at_single_spaces_between_solid_characters():
    import numpy as np
    texts = ["one two", "a  b", " x y ", "é ü 日 本", "a\u3000 b", "a \u3000b", "x. y, (z) w", "a\n b c", "\u00a0 d e", "▁ f g", "no"]
    raw = [t.encode() for t in texts]
    words, first = A.units(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = [words.to_pylist()[i:j] for i, j in zip(first, first[1:])]
    assert got == [["one", "two"], ["a  b"], [" x", "y "], ["é", "ü", "日", "本"], ["a\u3000 b"], ["a \u3000b"], ["x.", "y,", "(z)", "w"],
                   ["a\n b", "c"], ["\u00a0 d", "e"], ["▁ f", "g"], ["no"]]


def test_codes_round_trip():
    import numpy as np
    x = np.random.default_rng(1).integers(0, 1 << 20, 1000)
    assert (A.unpack_codes(A.pack_codes(x), 1000) == x).all() and len(A.unpack_codes(b"", 0)) == 0
