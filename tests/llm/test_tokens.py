"""Encoding, packing and token files: exact against the tokenizers library, and round trips."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pytest
from tokenizers import Tokenizer

from termspark.llm import packing, token_files, tokens
from termspark.llm.tokens import Encoder, tokenizer_path
from termspark.session import staging_path

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


@pytest.mark.parametrize("name", FILES)
def test_same_ids_as_the_library(name):
    pick = random.Random(1)
    letters = "ab AB'sdtrevml \n\n  12²½.,.,!?#éÉß«­\t\x85 <|>İ"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(4000)]
    texts += ["", " ", "\n", "<|endoftext|>", "it's DON'T we'll", "e.g., a.b,c ...", "x" * 3000, "ж 中文 🙂"]
    plain = Tokenizer.from_file(tokenizer_path(name))
    for text, ids in zip(texts, Encoder(tokenizer_path(name)).encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_same_ids_when_the_cache_turns_over(monkeypatch):
    monkeypatch.setattr("termspark.llm.tokens.CACHED_WORDS", 3)
    texts = ["a b c d e f g h", "h g f e d c b a", "a, b. c"] * 3
    known, plain = Encoder(tokenizer_path(FILES[0])), Tokenizer.from_file(tokenizer_path(FILES[0]))
    for text, ids in zip(texts, known.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def expected_ids(docs, name, end_id):
    plain = Tokenizer.from_file(tokenizer_path(name))
    rows = docs.select("doc_id", "text").collect()
    return [(r["doc_id"], [*plain.encode(r["text"] or "", add_special_tokens=False).ids, end_id]) for r in rows]


def check_packing(docs, sizes=packing.CONTEXT_SIZES):
    wanted = expected_ids(docs, FILES[0], 0)
    pieces = packing.pack_documents(docs, tokenizer_path(FILES[0]), sizes, with_ids=True).collect()
    # every document's ids, put together from its pieces (rows of one id in any order)
    per_doc, found = {}, []
    for p in sorted(pieces, key=lambda p: (p["doc_id"] is None, p["doc_id"] or 0, p["start"])):
        assert p["length"] == len(p["ids"]) > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        per_doc.setdefault((p["doc_id"], p["start"], p["length"], p["doc_tokens"]), []).append(p["ids"])
    assert sum(p["length"] for p in pieces) == sum(len(ids) for _, ids in wanted)
    once = {(d, tuple(i)) for d, i in wanted if sum(x == d for x, _ in wanted) == 1}
    for doc, ids in once:
        parts = sorted((k[1], v[0]) for k, v in per_doc.items() if k[0] == doc)
        assert [x for _, part in parts for x in part] == list(ids)
        found.append(doc)
    assert len(found) == len(once)
    # sequences have no gap and are of a power of two
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append(p)
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at & (at - 1) == 0 and at <= max(sizes)
        assert at == own[0]["tier"]
    return pieces


def test_packing_of_odd_rows(odd_docs, no_docs, clashing):
    check_packing(odd_docs)
    check_packing(clashing(odd_docs), (64, 16))
    assert packing.pack_documents(no_docs, tokenizer_path(FILES[0])).count() == 0


def test_packing_of_a_table(tables):
    pieces = check_packing(tables("documents"))
    cut = len(pieces) / len({p["doc_id"] for p in pieces})
    assert cut < 3.5
    steps = {}
    for p in pieces:
        if p["tier"] == 1024:
            steps.setdefault(p["step_group"], set()).add(p["sequence_id"])
    sizes = sorted(map(len, steps.values()))
    assert sizes[-1] <= packing.STEP_SEQUENCES


def test_steps_are_balanced():
    piece = lambda n: packing._Piece(0, np.zeros(n, np.uint32), 0, n)
    sequences = [(1024, [piece(1024)]) for _ in range(8)] + [(1024, [piece(64)] * 16) for _ in range(8)]
    steps = packing.step_numbers(sequences, 4)
    costs = {s: sum(sum(len(p.ids) ** 2 for p in q[1]) for q, x in zip(sequences, steps) if x == s) for s in steps}
    assert len(costs) == 4 and len(set(costs.values())) == 1


def test_only_powers_of_two():
    with pytest.raises(ValueError):
        packing.pack_documents(None, "", (1000,))


def check_files(spark, docs):
    wanted = sorted(expected_ids(docs, FILES[1], 1), key=lambda r: (r[0] is not None, r[0] or 0))
    folder = staging_path(spark, "test-files")
    index = token_files.write_token_files(docs, tokenizer_path(FILES[1]), folder)
    rows = token_files.read_token_files(index, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [d for d, _ in wanted]
    at = 0
    for row in rows:
        assert row["start"] == at
        at += row["n_tokens"]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted(
        (str(d), len(ids), crc(ids)) for d, ids in wanted
    )


def test_token_files(spark, odd_docs, no_docs, clashing, tables):
    check_files(spark, clashing(odd_docs))
    check_files(spark, no_docs)
    check_files(spark, tables("documents"))


def test_random_access_without_copies(tmp_path):
    path, random_ids = tmp_path / "a.arrows", np.random.default_rng(0).integers(0, 49_000, 12_345)
    with open(path, "wb") as sink:
        writer = token_files.StreamWriter(sink, 49_408, length=16, rows=4)
        for at in range(0, len(random_ids), 97):
            writer.add(random_ids[at : at + 97].astype(np.uint32))
        writer.close()
    reader = token_files.StreamReader(pyarrow.fs.LocalFileSystem(), str(path))
    before = pa.total_allocated_bytes()
    for n in (700, 3, 771, 0):
        ids, mask = reader.sequence(n)
        real = random_ids[n * 16 : n * 16 + 16]
        assert ids.to_numpy()[: len(real)].tolist() == real.tolist()
        assert mask.to_pylist() == [True] * len(real) + [False] * (16 - len(real))
    assert pa.total_allocated_bytes() - before < 100_000
    assert np.concatenate(list(reader.ids(100, 5000))).tolist() == random_ids[100:5100].tolist()
    with pa.memory_map(str(path)) as source:
        assert sum(b.num_rows for b in pa.ipc.open_stream(source)) == -(-len(random_ids) // 16)
    with pytest.raises((EOFError, OSError, pa.ArrowException)):
        list(reader.ids(len(random_ids), 5000))


def test_signs_beside_stops():
    """A stop or comma with a sign before or after it is found from the stop on, as by looking at every two characters."""
    import re
    from itertools import product

    sign = r"[^\sA-Za-z0-9ªµºÀ-ÖØ-öø-ſ²³¹¼-¾]"
    slow = re.compile(f"[.,]{sign}|{sign}[.,]")
    for letters in product("a.,!é 1\n", repeat=4):
        text = "".join(letters)
        assert bool(tokens._TOUCHING.search(text)) == bool(slow.search(text)), text


def test_listed_words():
    """Words come out as they stand in the Arrow array, empty ones and none at all too."""
    import pyarrow as pa

    for words in ([], [""], ["a"], ["", "é́", " b", "", "x" * 10**6, "\n"]):
        assert tokens._listed(pa.array(words, pa.large_string())) == words
    assert [tokens._uncertain(t) for t in ("plain é\n", "a<|b", "tab\t", "中")] == [False, True, True, True]
