"""Token alignment against tokens of whole texts and sets of bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from termspark.llm import alignment
from termspark.llm.queries import QUERIES
from termspark.llm.tokens import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
STRANGE = [
    "a  b   c", " lead", "trail ", "\ttab\tbetween ", "a▁b", "x ▁ y", "nul\0here and there", "\x1c \x85     x",
    "<s> </s> <|endoftext|> <0x41>", "l'été d'Œuvre 's 't", "日本語 の テキスト", "👩‍👩‍👧 family é́ x", "1 234.5 % $$ ##", "\r\n\r\n", "don't  can't",
]


def token_bytes():
    """Bytes of every id, from the published byte alphabet."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in keep}
    signs |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    vocab = Tokenizer.from_file(A).get_vocab()
    first = {n: bytes(signs[c] for c in t) for t, n in vocab.items() if all(c in signs for c in t)}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    second = {}
    for n in range(model.get_piece_size()):
        piece = model.id_to_piece(n)
        byte = len(piece) == 6 and piece.startswith("<0x")
        second[n] = bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()
    return first, second


def slow_report(texts):
    first, second = token_bytes()
    tool = Tokenizer.from_file(A)
    tool.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    rows = []
    for text in texts:
        a = tool.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        want = b" " + (text or "").encode()
        if b"".join(first[n] for n in a) != want or b"".join(second[n] for n in b) != want:
            rows.append(([], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(first[n]) for n in a]), np.cumsum([len(second[n]) for n in b])
        at_a, at_b = dict(zip(ends_a.tolist(), range(len(a)))), dict(zip(ends_b.tolist(), range(len(b))))
        both = sorted(set(at_a) & set(at_b))
        links = [(a[at_a[e]], b[at_b[e]]) for e in both]
        groups, i, k = [], 0, 0
        for e in both:
            j, m = at_a[e] + 1, at_b[e] + 1
            groups.append(f"{','.join(map(str, a[i:j]))}|{','.join(map(str, b[k:m]))}")
            i, k = j, m
        rows.append((a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(link for r in rows for link in r[2])
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [
        (len(a), len(b), len(ls), len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), d)
        for a, b, ls, d in rows
    ]


def sample_texts(spark):
    docs = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(9)
    shown = [t[:1500] for t in docs[:60] if t]
    signs = [" ", " ", "  ", "\n", "\t", ".", "a", "the", "é", "ß", " ", "'s", "7", "中", "<|", "́", "Ａ"]
    return shown + STRANGE + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 60))) for _ in range(150)]


@pytest.mark.parametrize("block_pairs", [alignment.BLOCK_PAIRS, 300])
def test_brute_force(spark, clashing, block_pairs):
    texts = [*sample_texts(spark), None, "", "repeated row", "repeated row"]
    rows = [(n if n % 50 else None, t) for n, t in enumerate(texts)]
    docs = clashing(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4))
    made = alignment.alignment_report(docs, A, B, block_pairs).collect()
    got = sorted((r["doc_id"] or -1, *(r[n] for n in NAMES)) for r in made)
    assert got == sorted((d or -1, *values) for (d, _), values in zip(rows, slow_report(texts)))


def test_whole_table(spark, tables):
    """Every text's own columns, and the sums that hold over the table."""
    made = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in tables("documents").collect()}
    assert sorted(r["doc_id"] for r in made) == sorted(docs)
    tool = Tokenizer.from_file(A)
    tool.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    for r in made:
        text = docs[r["doc_id"]]
        if r["n_a"]:
            assert r["n_a"] == len(tool.encode(" " + text, add_special_tokens=False).ids)
            assert r["n_b"] == len(model.encode(text))
    assert sum(r["n_a"] > 0 for r in made) > 150


def test_odd_rows(spark, odd_docs, no_docs):
    made = alignment.alignment_report(odd_docs, A, B).collect()
    assert sorted(tuple(r[n] for n in NAMES) for r in made) == sorted(slow_report([r["text"] for r in odd_docs.collect()]))
    assert alignment.alignment_report(no_docs, A, B).count() == 0
    assert alignment.align_tokens(no_docs, A, B).count() == 0


def test_all_links(spark):
    """Overlaps, groups and shared groups by sets of bytes."""
    first, second = token_bytes()
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(sample_texts(spark)[40:])], "doc_id bigint, text string")
    for r in alignment.align_tokens(docs, A, B).collect():
        spans = []
        for ids, known in ((r["a_ids"], first), (r["b_ids"], second)):
            ends = np.cumsum([0, *(len(known[n]) for n in ids)]).tolist()
            spans.append([set(range(x, y)) for x, y in zip(ends, ends[1:])])
        shared = {(i, k): len(x & y) for i, x in enumerate(spans[0]) for k, y in enumerate(spans[1]) if x & y}
        assert {(o["a"], o["b"]): o["bytes"] for o in r["overlaps"]} == shared
        together = {p for p in shared if max(spans[0][p[0]]) == max(spans[1][p[1]])}
        assert {(o["a"], o["b"]) for o in r["together"]} == together
        for side, name in enumerate(("a_group", "b_group")):
            cuts = [max(spans[0][i]) for i, _ in sorted(together)]
            assert r[name] == [sum(c < min(s) for c in cuts) for s in spans[side]]
        groups = {(i, k) for i, g in enumerate(r["a_group"]) for k, h in enumerate(r["b_group"]) if g == h}
        assert {(o["a"], o["b"]) for o in r["shared_groups"]} == groups


def test_products():
    """Gustavson's product against dense matrices."""
    rng = np.random.default_rng(1)
    for rows, inner, width in [(3, 4, 5), (1, 1, 1), (7, 30, 2), (20, 9, 40), (2, 3, 0)]:
        x, y = rng.integers(0, 3, (rows, inner)), rng.integers(0, 3, (inner, width))
        made = sparse(x).times(sparse(y))
        dense = np.zeros((rows, width), np.int64)
        i, k, n = made.entries()
        dense[i, k] = n
        assert (dense == x @ y).all() and len(n) == np.count_nonzero(x @ y)
        back = sparse(x).transposed()
        assert (np.diff(back.starts) == np.count_nonzero(x, axis=0)).all()


def sparse(dense):
    rows, columns = np.nonzero(dense)
    starts = np.searchsorted(rows, np.arange(len(dense) + 1))
    return alignment.Csr(starts, columns, dense[rows, columns], dense.shape[1])


def test_words_that_come_once_do_not_fill_a_worker(monkeypatch):
    monkeypatch.setattr(alignment, "CACHED_WORDS", 10)
    tool, plain = alignment.Aligner(A, B), sentencepiece.SentencePieceProcessor(model_file=B)
    texts = [" ".join(f"w{n}x{m}" for m in range(50)) + " the end" for n in range(5)]
    for text, (first, second) in zip(texts, tool.ids(texts), strict=True):
        assert second.tolist() == plain.encode(text)
        assert first.tolist() == tool.a.tokenizer.encode(" " + text, add_special_tokens=False).ids
    kept = (tool.b.young, tool.b.old, tool.a.words, tool.a.words.old, tool.a.pieces, tool.a.pieces.old)
    assert max(map(len, kept)) <= 10


def test_digests_of_texts_aligned_in_parts(monkeypatch):
    tool = alignment.aligner(A, B)
    texts = [*STRANGE, "", "plain words " * 9] * 2
    whole = tool.digests(texts)
    monkeypatch.setattr(alignment, "ALIGNED_CHARS", 20)
    for one, other in zip(whole, tool.digests(texts), strict=True):
        assert one[:2] == other[:2] and one[3] == other[3] and one[2].tolist() == other[2].tolist()
