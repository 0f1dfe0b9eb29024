import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from skyfare.llm import alignment
from skyfare.llm.minimal_hash import MinimalHash
from skyfare.llm.queries import QUERIES, tokenizer_pair

from .helpers import SF_SMALL, clashing, documents, ws

COLUMNS = ["doc_id", *alignment.FIELDS, "groups_sha256"]


class Plain:
    """Whole texts, one document at a time."""

    def __init__(self):
        cfg = tokenizer_pair()
        self.a, self.b = Tokenizer.from_file(cfg.a), sentencepiece.SentencePieceProcessor(model_file=cfg.b)
        self.a.encode_special_tokens = True
        spelt = {v: k for k, v in self._alphabet().items()}
        self.bytes_a = {i: bytes(spelt[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    @staticmethod
    def _alphabet():
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def bytes_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(self.bytes_a[i] for i in a) != raw or b"".join(map(self.bytes_b, b)) != raw:
            return None
        ends_a, ends_b = np.cumsum([len(self.bytes_a[i]) for i in a]), np.cumsum([len(self.bytes_b(i)) for i in b])
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        cut_a, cut_b = np.searchsorted(ends_a, both) + 1, np.searchsorted(ends_b, both) + 1
        return [(a[i:k], b[j:m]) for i, k, j, m in zip([0, *cut_a[:-1]], cut_a, [0, *cut_b[:-1]], cut_b)]


def plain_rows(rows):
    plain, cut, seen = Plain(), [], Counter()
    for doc_id, text in rows:
        g = plain.groups(text)
        links = [(p, q) for x, y in g or [] for p in x for q in y]
        seen.update(set(links))
        cut.append((doc_id, g, links))
    best = {}
    for (p, _), n in seen.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for doc_id, g, links in cut:
        if g is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((doc_id, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links),
                    sum(seen[x] == best[x[0]] for x in links), sum(seen[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


ODD = [None, "", " ", "  ", "a", " lead", "trail ", "two  spaces", "a\nb", "a \n b", "\ttab\tx", "a\r\nb;\r", "x\xa0y z", "!\x1cq \x1f.",
       "▁x", "word ▁ word", "<|endoftext|> </s> <0x41>", "日本語 テキスト 漢字", "\U0001f600\U0001f680 ok", "é é ﬁ ½", "don't we'll",
       "a\x00b", "-" * 700, "ab" * 500, " " * 70 + "x", "\n\n\n", "word, word. word; (word), x_, x_. 1, 2. it's, é. ²., word***\nword$$$ a,b,c ,a .b", ".", ",", ", x", "x   y　z", "1234567890 3.14", "Üñî çødé", "\x85a b\x0bc"]


def test_odd_texts_equal_plain_ones(spark):
    rows = list(enumerate(ODD)) + [(3, "repeated row"), (3, "repeated row"), (None, "null id"), (900, "long text of words " * 20_000)]
    got = alignment.align(clashing(documents(spark, rows)), ws(spark), tokenizer_pair())
    assert found(got) == plain_rows(rows)


def test_query_equals_plain_one(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op12_align_tokenizers"](spark, SF_SMALL)) == plain_rows([tuple(r) for r in docs])


def test_rare_pairs_are_joined(spark):
    """Few common pairs, several shards and branches: the same rows."""
    rng = random.Random(4)
    words = ["alpha", "beta's", "gamma", "été", "12", "x=1;", "naïve", "日本"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(80)]
    cfg = tokenizer_pair()
    for head in (0, 20):
        few = alignment.Alignment(cfg.a, cfg.b, shards=7, branches=3, head_pairs=head)
        assert found(alignment.align(documents(spark, rows), ws(spark), few)) == plain_rows(rows)


def test_units_equal_whole_texts():
    """Random strings over awkward characters: units one after another give the whole text's groups."""
    rng, plain, aligner = random.Random(9), Plain(), alignment.Aligner(tokenizer_pair())
    signs = list(" \n\t\r\xa0\x1c  ab'sé日1.;!-_") + ["  ", "the", " the", "\r\n", "\U0001f600"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 25)))
        ids = aligner.ids([" " + text])[0]
        expected = plain.groups(text)
        if expected is None:
            assert aligner.stats.array()[ids, 6].any(), repr(text)
            continue
        own = b";".join(aligner.groups[i] for i in ids).decode()
        assert own == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in expected), repr(text)


def test_long_texts_are_cut_alike(monkeypatch):
    plain, aligner = Plain(), alignment.Aligner(tokenizer_pair())
    text = "some words\nand more, 12 of them\tthen  two " * 40
    monkeypatch.setattr(alignment, "RUN", 100)
    parts = alignment.slabs(text)
    assert len(parts) > 5 and "".join(parts) == " " + text
    own = b";".join(aligner.groups[i] for p in aligner.ids(parts) for i in p).decode()
    assert own == ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain.groups(text))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_minimal_hash_numbers_its_keys(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n)).astype(np.uint64)
    mph = MinimalHash.load(MinimalHash.build(keys).dump())
    assert sorted(mph.index(keys).tolist()) == list(range(len(keys)))
    assert len(MinimalHash.build(keys).dump()) < len(keys) + 8 * 200


def test_empty_table(spark):
    assert alignment.align(documents(spark, []), ws(spark), tokenizer_pair()).count() == 0
