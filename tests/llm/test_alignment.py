"""Alignment of two tokenizers against loops over their tokens."""

from collections import Counter, defaultdict

import pytest

from lexloom.llm import alignment
from tests.llm import brute


@pytest.fixture(scope="module")
def pair():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = {chr(k): k for k in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    for k, x in enumerate(k for k in range(256) if chr(k) not in letters):
        letters[chr(256 + k)] = x
    return a, b, letters


def plain(texts, pair, names=None):
    """Rows of the contract, token by token; names: the documents of texts, each its own by default."""
    a, b, letters = pair
    found = []
    for text in texts:
        text, row = text or "", ([], [], [], [])
        whole = (" " + text).encode()
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ib)]
        if text and b"".join(ba) == whole == b"".join(bb):
            spans = []
            for tokens in (ba, bb):
                at, s = 0, []
                for t in tokens:
                    s.append((at, at + len(t)))
                    at += len(t)
                spans.append(s)
            sa, sb = spans
            cuts = sorted({e for _, e in sa} & {e for _, e in sb})
            groups, i, j = [], 0, 0
            for c in cuts:
                left, right = [], []
                while i < len(sa) and sa[i][1] <= c:
                    left.append(ia[i])
                    i += 1
                while j < len(sb) and sb[j][1] <= c:
                    right.append(ib[j])
                    j += 1
                groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            links, low = [], 0
            for (s, e), x in zip(sa, ia, strict=True):
                while sb[low][1] <= s:
                    low += 1
                k = low
                while k < len(sb) and sb[k][0] < e:
                    links.append((x, ib[k]))
                    k += 1
            row = (ia, ib, groups, links)
        found.append(row)
    held = {(k if names is None else names[n], p) for n, (k, r) in enumerate(enumerate(found)) for p in r[3]}
    count = Counter(p for _, p in held)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(len(x), len(y), len(g), len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls), brute.sha(";".join(g)) if g else "") for x, y, g, ls in found]


@pytest.fixture(scope="module")
def rows(spark, sf):
    odd = [*brute.ODD, "a  b   c", " led", "trail ", "▁x", "<0x41> <s> <unk> <|endoftext|>", "x" * 40_000, "naïve café ½ ﬁ Å Å", "​﻿", "हिन्दी मिश्रित text", brute.ODD[5], brute.ODD[5], "token\r\n\ttoken"]
    real = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    return [*real, *((10**6 + k // 2, t) for k, t in enumerate(odd)), (None, "the same"), (None, "the same")]


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


@pytest.mark.parametrize("hot", [alignment.HOT, 40, 0])
def test_alignment_equals_loops_over_tokens(spark, rows, pair, hot, monkeypatch):
    if hot == 40:
        monkeypatch.setattr(alignment, "HELD", 50)
        monkeypatch.setattr(alignment, "BATCH", 1000)
    want = Counter((k, *r) for (k, _), r in zip(rows, plain([t for _, t in rows], pair, [t if k is None else k for k, t in rows]), strict=True))
    docs = spark.createDataFrame([(k, t, 1, 2, "c", 3) for k, t in rows], "doc_id long, text string, pair int, _row int, _id string, n_a int")
    got = alignment.Alignment(docs, hot=hot).rows().collect()
    assert Counter((r._id, *(r[c] for c in COLUMNS)) for r in got) == want


def test_links_of_a_table(spark, pair):
    texts = ["hello world", "hello there", None, "unhelpful antidisestablishment"]
    docs = spark.createDataFrame([(f"k{k}", t) for k, t in enumerate(texts)], "doc_id string, text string")
    found = alignment.Alignment(docs)
    links = found.links().collect()
    want = plain(texts, pair)
    for k, w in enumerate(want):
        own = [r for r in links if r._id == f"k{k}"]
        assert sum(r.links for r in own) == w[3] and sum(r.links * r.docs for r in own) == w[5] and sum(r.links for r in own if r.best) == w[4]
    assert all(r.a < 50257 and r.b < 32000 for r in links)


def test_no_rows(spark):
    assert alignment.Alignment(spark.createDataFrame([], "doc_id long, text string")).rows().count() == 0
    got = alignment.Alignment(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).rows().collect()
    assert [(r.n_a, r.n_links, r.count_sum, r.groups_sha256) for r in got] == [(0, 0, 0, "")] * 2
