"""Token ids in fixed-width bit packing.

A token file is a folder of two Parquet tables:

``blocks``    one row per block: ``shard``, ``block``, ``first`` (tokens of the
              shard before it), ``n_ids``, ``width`` (bits per id: the fewest
              that hold the vocabulary), ``doc_ids`` and ``doc_tokens`` of the
              whole documents it holds, and ``payload``: the ids, each in
              ``width`` bits, lowest bit first.  A block closes at the first
              document end at or after ``block_ids`` ids.
``manifest``  one row per shard: ``shard``, ``base`` (tokens of the file before
              the shard), ``n_ids``.

Documents are in ascending id order over the shards (nulls first; rows that
repeat an id by the hash of their text).  Token p is in the block with
base + first <= p, at bit (p - base - first) * width of its payload, so a range
of tokens needs only the blocks that hold it and unpacks with numpy.

With a word tokenizer, encoding works on pieces between blanks, which no token
crosses, and looks up pieces it has seen; the result equals encoding the whole
text (tested).  Documents are range-partitioned and encoded where they are; a
shard's totals are summed by Spark, no id passes through the driver.

Defined cases: null and empty texts are one end id; null ids are kept, first;
an empty table gives an empty file; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import kept, release

_RUN = re.compile(r"[a-z]+|[0-9]|[^a-z0-9]+")
# letters that normalising keeps or lower-cases one for one (not the dotted capital I)
_LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+")
_LOWER = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
# byte alphabet of byte-level vocabularies: visible Latin-1 signs stand for themselves, the
# other bytes, in order, for the characters from 256 on
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
CACHE = 600_000      # pieces looked up
PARTS = 400_000      # parts of pieces, kept by a worker from task to task


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    end_id: int = 1
    block_ids: int = 1 << 16


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    octets = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if width % 8 == 0:
        return octets[:, :width // 8].tobytes()
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return np.packbits(bits[:, :width].reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from id ``start`` on; touches only their bytes."""
    low, high = start * width, (start + count) * width
    raw = np.frombuffer(payload, dtype=np.uint8, offset=low // 8, count=(high + 7) // 8 - low // 8)
    if width % 8 == 0:
        octets = np.zeros((count, 4), dtype=np.uint8)
        octets[:, :width // 8] = raw.reshape(count, width // 8)
        return octets.reshape(-1).view("<u4")
    bits = np.unpackbits(raw, bitorder="little")[low % 8:low % 8 + count * width].reshape(count, width)
    full = np.zeros((count, 32), dtype=np.uint8)
    full[:, :width] = bits
    return np.packbits(full.reshape(-1), bitorder="little").view("<u4")


#: Normalising and first cut of the tokenizers that parts_of knows.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
FIRST_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _state(component) -> dict:
    return json.loads(component.__getstate__()) if component is not None else {}


class Encoder:
    """Ids of whole texts, as little-endian 32-bit bytes.

    With a tokenizer that lower-cases and cuts words as above, a text is cut at
    blanks and a piece into parts where the tokenizer cuts too; parts and
    pieces are encoded once and looked up afterwards.  A part of plain letters
    is what normalising would leave, so it goes to the merge model directly.
    Any other tokenizer gets whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        cuts = _state(self.tokenizer.pre_tokenizer).get("pretokenizers", [])
        self.in_parts = (_state(self.tokenizer.normalizer) == NORMALIZER and len(cuts) == 2
                         and cuts[0].get("pattern") == {"Regex": FIRST_CUT} and cuts[1].get("type") == "ByteLevel"
                         and not cuts[1].get("use_regex") and not cuts[1].get("add_prefix_space"))
        self.known: dict[str, bytes] = {"": b""}   # pieces as they stand in texts
        self.parts: dict[str, bytes] = {"": b""}   # what the tokenizer was asked

    def begin(self) -> Encoder:
        """For a further task of the same worker: parts stay known, pieces do not."""
        self.known = {"": b""}
        return self

    def _ask(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, part: str) -> bytes:
        """A part of lower-case letters, spelt in the model's byte alphabet."""
        spelt = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(_ALPHABET)
        ids = [t.id for t in self.model.tokenize(spelt)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.in_parts:
            return self._ask([t or "" for t in texts])
        if len(self.known) > CACHE:
            self.known = {"": b""}
        if len(self.parts) > PARTS:
            self.parts = {"": b""}
        known, parts = self.known, self.parts
        split = [pieces_of(t or "") for t in texts]
        found = [list(map(known.get, pieces)) for pieces in split]
        open_ = [i for i, x in enumerate(found) if None in x]
        cut = {p: parts_of(p) for p in {p for i in open_ for p, e in zip(split[i], found[i]) if e is None}}
        words, other = [], []
        for x in {x for xs in cut.values() for x in xs if x not in parts}:
            (words if x.isascii() and x.isalpha() or _LOWER.fullmatch(x) else other).append(x)
        parts.update(zip(words, map(self._word, words)))
        for i in range(0, len(other), 10_000):
            parts.update(zip(other[i:i + 10_000], self._ask(other[i:i + 10_000])))
        for p, xs in cut.items():
            known[p] = parts[xs[0]] if len(xs) == 1 else b"".join([parts[x] for x in xs])
        for i in open_:
            found[i] = [known[p] if e is None else e for p, e in zip(split[i], found[i])]
        return list(map(b"".join, found))


def pieces_of(text: str) -> list[str]:
    """A text at its blanks, in Latin-1 in lower case (as the tokenizer will have it; letter
    by letter, so fewer different pieces)."""
    if _latin(text) and "<|" not in text:   # special tokens keep their case
        text = text.lower()
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def parts_of(piece: str) -> tuple[str, ...]:
    """A piece without blanks in parts that encode one after another like the whole.

    Plain Latin words are lower-cased, other printable ASCII is cut between
    letters, single digits and runs of other signs; elsewhere only marks after
    a last Latin letter are cut off.  Pieces with an apostrophe or the start of
    a special token stay whole."""
    if piece.isascii():
        core = piece.rstrip(".,;:!?")
        if core.isalpha():
            return (core.lower(), piece[len(core):]) if len(core) < len(piece) else (core.lower(),)
    if _LATIN.fullmatch(piece):
        return (piece.lower(),)
    if "'" in piece or "<|" in piece:
        return (piece,)
    if piece.isascii() and piece.isprintable():
        return tuple(_RUN.findall(piece.lower()))
    core = piece.rstrip(".,;:!?")
    if not _LATIN.fullmatch(core[-1:]):
        return (piece,)
    return (core.lower() if _LATIN.fullmatch(core) else core, piece[len(core):])


def _chunks(texts: list, size: int = 4 << 20) -> Iterator[list]:
    """Texts in runs of about ``size`` characters."""
    run, held = [], 0
    for t in texts:
        run.append(t)
        held += len(t or "")
        if held >= size:
            yield run
            run, held = [], 0
    if run:
        yield run


def write_tokens(docs: DataFrame, path: str, cfg: Packing) -> None:
    """Write the token file of ``docs`` (doc_id, text) into the folder ``path``."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.xxhash64("text").alias("__t"), "text")
    d = d.repartitionByRange("doc_id", "__t").sortWithinPartitions("doc_id", "__t").select("doc_id", "text")
    id_type = d.schema["doc_id"].dataType.simpleString()
    end = np.array([cfg.end_id], dtype="<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = None, TaskContext.get().partitionId()
        block = first = held = 0
        ids: list[bytes] = []
        names: list[pa.Array] = []
        sizes: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal block, first, held
            width = bits_for(encoder.vocabulary)
            row = {"shard": [shard], "block": [block], "first": [first], "n_ids": [held], "width": [width],
                   "doc_ids": [[n.as_py() for n in names]], "doc_tokens": [list(sizes)],
                   "payload": [pack(np.frombuffer(b"".join(ids), dtype="<u4"), width)]}
            block, first, held = block + 1, first + held, 0
            ids.clear(), names.clear(), sizes.clear()
            return pa.RecordBatch.from_pydict(row, schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int64()), ("first", pa.int64()),
                            ("n_ids", pa.int64()), ("width", pa.int32()),
                            ("doc_ids", pa.list_(pa.int64() if id_type == "bigint" else pa.int32()
                                                 if id_type == "int" else pa.string())),
                            ("doc_tokens", pa.list_(pa.int64())), ("payload", pa.binary())])
        for b in batches:
            encoder = encoder or kept("encoder", (cfg.tokenizer,), lambda: Encoder(cfg.tokenizer)).begin()
            at = 0
            for run in _chunks(b.column(1).to_pylist()):
                for e in encoder.encode(run):
                    ids.append(e + end)
                    names.append(b.column(0)[at])
                    sizes.append(len(e) // 4 + 1)
                    held += sizes[-1]
                    at += 1
                    if held >= cfg.block_ids:
                        yield close()
        if held:
            yield close()

    out = (f"shard int, block long, first long, n_ids long, width int, doc_ids array<{id_type}>, "
           "doc_tokens array<long>, payload binary")
    d.mapInArrow(blocks, out).write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    totals = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"), "n_ids") \
        .write.mode("overwrite").parquet(f"{path}/manifest")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``base``, the tokens of the file before their shard."""
    return (spark.read.parquet(f"{path}/blocks")
            .join(spark.read.parquet(f"{path}/manifest").select("shard", "base"), "shard"))


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, unpacked from the file."""
    b = read_blocks(spark, path)
    id_type = b.schema["doc_ids"].dataType.elementType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release("encoder")   # the file is written
        for batch in batches:
            for r in range(batch.num_rows):
                base, first, n, width = (batch.column(i)[r].as_py() for i in range(4))
                names, sizes = batch.column(4)[r].values, np.array(batch.column(5)[r].as_py(), dtype=np.int64)
                ids = unpack(batch.column(6)[r].as_py(), width, 0, n).tobytes()
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(ids[4 * (e - s):4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(base + first + ends - sizes), pa.array(sizes),
                     pa.array(crc, type=pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (b.select("base", "first", "n_ids", "width", "doc_ids", "doc_tokens", "payload")
            .mapInArrow(digests, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long"))


def read_range(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Random access: tokens start .. start + count of the file."""
    at = F.col("base") + F.col("first")
    rows = (read_blocks(spark, path).where((at < start + count) & (at + F.col("n_ids") > start))
            .select(at.alias("at"), "n_ids", "width", "payload").orderBy("at").collect())
    parts = []
    for r in rows:
        low, high = max(start, r["at"]), min(start + count, r["at"] + r["n_ids"])
        parts.append(unpack(bytes(r["payload"]), r["width"], low - r["at"], high - low))
    return np.concatenate(parts) if parts else np.zeros(0, dtype="<u4")
