"""Pieces and counts against the tokenizers' library, character by character and on random and given texts."""

import os
import random

import pyarrow as pa
import pytest
from common import documents

from tidelog.llm.pretokens import PLAIN, Pieces, load
from tidelog.llm.queries import TOKENIZERS
from tidelog.llm.tokens import count_tokens, whole_tokens

SF_DIR = "/root/testdata/sf0.001"
WORD, BYTE = f"{TOKENIZERS}/word_bpe_49k.json", f"{TOKENIZERS}/byte_bpe_50k.json"
pytestmark = pytest.mark.skipif(not os.path.exists(BYTE), reason="tokenizers not there")

ODD = [
    "", "a<|endoftext|>b", "<|startoftext|>", "<|endoftext|><|endoftext|>", "漢字 test", "Σας ΣΑΣ", "é é", "'", "''s", "'x'", "s'", "I'll we're 'tis",
    "  two  spaces \n\n newline\t", "\x1c\x1d a\x85b\xa0c", "١٢ 12", "x" * 5000, " " * 3000 + "a", "İstanbul", "\U0001f600 smile", "can't've",
]


@pytest.fixture(scope="module")
def texts():
    plain = [chr(c) for c in range(0x3000) if PLAIN.fullmatch(chr(c))]
    out = [f.replace("{}", c) for c in plain for f in ("a{}b", "{}", " {} x{}{}", "1{}2'{}s")]
    draw = random.Random(1)
    some = plain + [" ", "\n", "a", "b", "'s", "'", " the", "\t", "'ll", "'re", "  "] * 40
    out += ["".join(draw.choice(some) for _ in range(draw.randrange(60))) for _ in range(1500)]
    return out + ODD


def test_ids_are_the_library_s(texts):
    library, pieces = load(WORD), Pieces(WORD, words=True)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in pieces.ids(pa.array(texts))] == want
    assert [x.tolist() for x in pieces.ids(pa.array(texts))] == want  # all known by now


def test_counts_are_the_library_s(texts, monkeypatch):
    import tidelog.llm.pretokens as pretokens

    want = [len(e.ids) for e in load(BYTE).encode_batch(texts, add_special_tokens=False)]
    for whole, memory in ((whole_tokens(BYTE), 2_000_000), ([], 100)):  # also when all is forgotten again and again
        monkeypatch.setattr(pretokens, "PIECES", memory)
        assert Pieces(BYTE, words=False, whole=whole).counts(pa.array(texts)).tolist() == want


def test_whole_tokens_are_proved():
    library, whole = load(BYTE), whole_tokens(BYTE)
    assert len(whole) > 40_000 and "<|endoftext|>" not in whole
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in whole[::97])


def test_query(spark, tmp_path):
    from tidelog.llm.queries import QUERIES

    some = [None, *ODD, "word " * 20000, ODD[4], ODD[4]]
    documents(spark, some, extra="row,n_tokens,n_bytes").write.parquet(f"{tmp_path}/documents.parquet")
    library = load(BYTE)
    want = []
    for i, t in enumerate(some):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert sorted(tuple(r) for r in QUERIES["op10_token_counts"](spark, str(tmp_path)).collect()) == want
    assert count_tokens(documents(spark, some).where("false"), "text", ["doc_id"], BYTE).collect() == []
