import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from skyfare.llm import packing
from skyfare.llm.queries import QUERIES, word_bpe

from .helpers import SF_SMALL, clashing, documents, ws


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_bpe())


@pytest.mark.parametrize("width", [1, 2, 7, 8, 13, 16, 17, 31, 32])
def test_pack_round_trip_and_random_access(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 1 << width, 1000, dtype=np.uint64).astype("<u4")
    data = packing.pack(ids, width)
    assert len(data) == (1000 * width + 7) // 8
    for start, count in [(0, 1000), (0, 0), (999, 1), (17, 301)]:
        assert (packing.unpack(data, width, start, count) == ids[start:start + count]).all()


def test_bits_are_the_fewest():
    assert [packing.bits_for(v) for v in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


ODD = ["", "  \n", "Hello, World's end", "<|endoftext|> x<|ENDOFTEXT|>", "a b c\x1cd\x85e\x0bf\x0cg", "ΟΔΥΣΣΕΥΣ ΣΑΣ",
       "İstanbul İ", "é ́x", "ﬁ ½ Ⅷ", "don't they'll 1234", "日本語 テキスト", "😀👍🏽 zwj👩‍👩‍👧", "\t\r\n tabs\t",
       "### $$$ %%% a.b,c", "ÄÖÜß ẞ", " line "]


def test_pieces_encode_like_whole_texts(tokenizer):
    rng = random.Random(5)
    alphabet = "aB é' ́Σσİ<|>1,.\n\t-日😀"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    got = packing.Encoder(word_bpe()).encode(texts)
    for t, g in zip(texts, got):
        assert np.frombuffer(g, dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def expected(tokenizer, rows):
    start, out = 0, []
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op6_pack_tokens"](spark, SF_SMALL).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(tokenizer, sorted((r["doc_id"], r["text"]) for r in docs))


def test_edges_and_random_access(spark, tokenizer):
    rows = [(None, "no id"), (-3, None), (0, ""), (7, "twice"), (7, "twice")] + list(enumerate(ODD, 10)) + \
           [(99, "long text " * 60_000), (100, "after")]
    d = clashing(documents(spark, rows)).repartition(3)
    path = ws(spark).path("tokens")
    packing.write_tokens(d, path, packing.Packing(word_bpe(), block_ids=64))
    got = sorted((tuple(r) for r in packing.document_digests(spark, path).collect()),
                 key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == expected(tokenizer, rows)
    whole = np.concatenate([tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for _, t in rows])
    assert (packing.read_range(spark, path, 0, len(whole)) == whole).all()
    for start, count in [(0, 1), (5, 200), (len(whole) - 3, 3), (1000, 4000)]:
        assert (packing.read_range(spark, path, start, count) == whole[start:start + count]).all()
    path = ws(spark).path("tokens")
    packing.write_tokens(d.where("doc_id = 12345"), path, packing.Packing(word_bpe()))
    assert packing.document_digests(spark, path).count() == 0
