"""The token store against the tokenizer itself, and single-document reads."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vigilcard.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "\n\n", "It's   we'LL 'S x's y", "áé ́x", "İSTANBUL ΣΑΣ ẞ", "<|endoftext|>",
    "x<|startoftext|>y <|endof text|>", "tab\tand\x0b\x0cvt\r\n", "漢字 かな 123 4.5", " line sep\x85next", "e ̈ ö", "🙂🙂 ok",
]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("seed", range(20))
def test_pieces_encode_like_whole_texts(seed):
    rng = random.Random(seed)
    alphabet = "aB c'sDé ñ\n\t ́ß1!.,<|>İΣ 漢 'll"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 200))) for _ in range(100)]
    tokenizer = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, token_store.Encoder(PATH)(texts), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], repr(text)


@pytest.mark.parametrize("frame", [4_000_000, 200])
def test_round_trip(spark, tmp_path, monkeypatch, frame):
    monkeypatch.setattr(token_store, "FRAME", frame)
    rng = random.Random(1)
    rows = [(rng.randrange(10**9), t) for t in ODD] + [(None, "no id"), (7, "same"), (7, "same"), (8, "long " * 50_000)]
    rows += [(k + 10, " ".join(rng.choice(["the", "quick", "fox", "straße"]) for _ in range(rng.randint(1, 80)))) for k in range(300)]
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, part int, frame string")
    path = str(tmp_path / "store")
    token_store.write_store(docs.repartition(5), path, PATH)
    found = [tuple(r) for r in token_store.digests(spark, path).orderBy("start").collect()]
    assert found == expected(rows)
    got = {r.doc_id: r.ids for r in token_store.read_documents(spark, path, [8, 11, 10**12]).collect()}
    want = {i: Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids + [1] for i, t in rows if i in (8, 11)}
    assert got == want


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert token_store.digests(spark, path).count() == 0


def test_frame_refuses_another_dictionary():
    with pytest.raises(ValueError):
        token_store.Frame(token_store.write_frame([1], [b""], [0], 2, b"a" * 32), b"", b"b" * 32)
