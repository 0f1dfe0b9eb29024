"""Cross-tokenizer alignment with corpus-wide pair counts.

Tokenizer A (byte-level BPE) encodes a space and the text, tokenizer B (pieces with
byte fallback) the text, to which it adds that space itself.  Byte offsets where a
token of both ends cut the tokens into groups; all A and B tokens of a group are
linked.  A pair of ids counts the documents that hold it linked.

First pass: documents are aligned and every task sums up the documents of its
pairs.  The distinct pairs are dealt into ``shards`` by hash, each of which gets a
minimal perfect hash (``minimal_hash``) and its pairs in the order of their numbers.
Partial counts are then added into dense vectors, one per shard and branch, and the
branches' vectors are summed block by block: a tree of tasks, branches and shards.
Second pass: documents are aligned again and look their pairs up in a minimal hash
of the commonest pairs, at most ``head_pairs`` of them, the only data broadcast; the
stored key verifies each hit.  Occurrences of rarer pairs, if there are any, meet
their counts in a join.

Texts are cut into units before blanks that no token of A or B crosses (checked for
the vocabularies at hand, else a text is one unit).  Both tokenizers end a token
there, so a unit is encoded and aligned once and then looked up; tasks that a worker
runs one after another share their units.

Defined cases: a text that is null, empty, or not given back byte for byte by both
tokenizers (U+2581 in it) has no tokens: counts 0, ``groups_sha256`` ''; repeated
rows are documents of their own; ties for an A id's highest count all count as
best; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Numbered, Workspace, kept
from .minimal_hash import MinimalHash

_UNIT = re.compile(r"[ \n\t]\s*\S+|\S+|\s+")
_CUT = re.compile(r"(?<=\S)(?=[ \n\t])")
RUN = 1 << 20        # characters aligned together
CACHE = 800_000      # units kept
BLOCK = 1 << 16      # counts of a vector's block
# bytes as byte-level vocabularies spell them: visible Latin-1 signs stand for themselves, the
# others, in order, for the characters from 256 on
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SPELT = {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*_VISIBLE}))}


@dataclass(frozen=True)
class Alignment:
    a: str                         # tokenizers file
    b: str                         # sentencepiece model
    shards: int = 256              # of the distinct pairs: at most |A| x |B| / shards in one task
    branches: int = 4              # partial vectors of a shard
    head_pairs: int = 4_000_000    # pairs broadcast (16 bytes each and 3 bits)


class Rows:
    """Rows of whole numbers that grow by doubling."""

    def __init__(self, width: int):
        self.held, self.n = np.zeros((1024, width), dtype=np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.held):
            grown = np.zeros((2 * (self.n + len(rows)), self.held.shape[1]), dtype=np.int64)
            grown[:self.n] = self.held[:self.n]
            self.held = grown
        self.held[self.n:self.n + len(rows)] = rows
        self.n += len(rows)

    def room(self, n: int) -> None:
        """``n`` more rows of zeros."""
        self.add(np.zeros((n, self.held.shape[1]), dtype=np.int64))

    def array(self) -> np.ndarray:
        return self.held[:self.n]


class Aligner:
    """Units of texts with their groups (as ``texts``, if they are asked for) and links;
    keeps those it has seen."""

    def __init__(self, cfg: Alignment, counts: PairCounts | None = None, texts: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(cfg.a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=cfg.b)
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.n_b = self.b.get_piece_size()
        bytes_a = [bytes(_SPELT[c] for c in names[i]) if i in names and all(c in _SPELT for c in names[i])
                   else names.get(i, "").encode() for i in range(max(names) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.len_a, self.len_b = [len(x) for x in bytes_a], [len(x) for x in self.bytes_b]
        self.size_a, self.size_b = np.array(self.len_a, dtype=np.int64), np.array(self.len_b, dtype=np.int64)
        self.name = [str(i) for i in range(max(len(bytes_a), self.n_b))]
        state = json.loads(self.a.pre_tokenizer.__getstate__()) if self.a.pre_tokenizer else {}
        self.cut = (self.a.normalizer is None and state.get("type") == "ByteLevel" and state.get("use_regex", True)
                    and not state.get("add_prefix_space")
                    and not any("\n" in p or "\t" in p or ("▁" in p[1:] and p.strip("▁")) for p in pieces))
        self.prefix = self.b.piece_to_id("▁")
        self.counts, self.texts = counts, texts
        self.forget()

    def forget(self) -> None:
        self.known = Numbered()
        self.groups: list[bytes] = []
        self.stats = Rows(7)       # n_a, n_b, n_groups, n_links, n_best, count_sum, not given back
        self.codes = Rows(1)       # of all units' links, end to end
        self.start = Rows(1)       # of a unit's codes
        self.rare: dict[int, list[int]] = {}
        self.held = 0

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return _UNIT.findall(text) if self.cut else [text]

    def codes_of(self, units: np.ndarray) -> np.ndarray:
        """Codes of the links of units, end to end."""
        start, n = self.start.array()[units, 0], self.stats.array()[units, 3]
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return self.codes.array()[at, 0]

    @staticmethod
    def _joined(units: list[str]) -> list[str]:
        """Units that start with other white space, or behind it, belong to the one before."""
        out: list[str] = []
        for u in units:
            if out and u[0] not in " \n\t":
                out[-1] += u
            else:
                out.append(u)
        return out

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Unit numbers of texts that start with a blank where both tokenizers cut."""
        if len(self.known) > CACHE or self.held > 64 * CACHE:
            self.forget()
        known, split = self.known, [self.units(t) for t in texts]

        def numbers() -> list[np.ndarray]:
            return [np.fromiter(map(known.__getitem__, us), dtype=np.int64, count=len(us)) for us in split]

        out = numbers()
        odd = {u for u in known.new if u[0] not in " \n\t"}
        if odd and self.cut:
            for u in known.new:     # the last that were numbered
                del known[u]
            known.new = []
            split = [self._joined(us) if not odd.isdisjoint(us) else us for us in split]
            out = numbers()
        new, known.new = known.new, []
        self.groups += [b""] * len(new)
        self.stats.room(len(new))
        self.start.room(len(new))
        self._learn(new)
        return out

    def _learn(self, units: list[str]) -> None:
        """Align new units: end to end where that leaves each as it is, else one by one."""
        joined, single = [], []
        for u in units:
            (joined if self.cut and not u[-1].isspace() and "▁" not in u else single).append(u)
        if joined and not self._learn_joined(joined):
            single += joined
        if single:
            self._learn_single(single)

    def _learn_joined(self, units: list[str]) -> bool:
        """Units start with a blank and end without one, so both tokenizers cut between them."""
        text, raw = "".join(units), [u.encode() for u in units]
        a = np.array(self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int64)
        # B puts a blank in front: a text that has none there gets rid of it again
        b = np.array(self.b.encode(text[1:] if text[0] == " " else text, num_threads=1), dtype=np.int64)
        b = b if text[0] == " " else b[1:]
        until = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        if b"".join(map(self.bytes_b.__getitem__, b.tolist())) != b"".join(raw) or end_a[-1] != until[-1]:
            return False
        both = np.zeros(int(until[-1]) + 1, dtype=np.int8)     # 3 where a token of both ends
        both[end_a] = 1
        both[end_b] += 2
        both = both == 3
        if not both[until].all():
            return False
        upto = np.cumsum(both)                                   # groups that end up to a byte
        of_a, of_b = upto[end_a] - both[end_a], upto[end_b] - both[end_b]            # groups of tokens
        n_groups = int(upto[-1])
        n_a, n_b = np.bincount(of_a, minlength=n_groups), np.bincount(of_b, minlength=n_groups)
        from_a, from_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        # every A token meets the B tokens of its group
        times = n_b[of_a]
        partner = np.repeat(from_b[of_a] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
        codes = np.repeat(a, times) * self.n_b + b[partner]
        firsts = np.concatenate([[0], upto[until]])              # groups before a unit
        groups = self._group_texts(a, b, n_a, n_b, from_a, from_b, firsts.tolist()) if self.texts else [b""] * len(units)
        stats = np.zeros((len(units), 7), dtype=np.int64)
        stats[:, 2] = firsts[1:] - firsts[:-1]
        for column, n in ((0, n_a), (1, n_b), (3, n_a * n_b)):
            stats[:, column] = np.add.reduceat(n, firsts[:-1])
        self._keep(units, groups, stats, codes)
        return True

    def _group_texts(self, a, b, n_a, n_b, from_a, from_b, cuts: list[int]) -> list[bytes]:
        name_a, name_b = list(map(self.name.__getitem__, a.tolist())), list(map(self.name.__getitem__, b.tolist()))
        i_a, i_b, k_a, k_b = from_a.tolist(), from_b.tolist(), n_a.tolist(), n_b.tolist()
        texts = [f"{name_a[i]}|{name_b[j]}" for i, j in zip(i_a, i_b)]
        for g in np.flatnonzero((n_a > 1) | (n_b > 1)).tolist():
            i, j = i_a[g], i_b[g]
            texts[g] = ",".join(name_a[i:i + k_a[g]]) + "|" + ",".join(name_b[j:j + k_b[g]])
        return [";".join(texts[x:y]).encode() for x, y in zip(cuts, cuts[1:])]

    def _learn_single(self, units: list[str]) -> None:
        found_a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        bare = [u[0] != " " for u in units]
        found_b = self.b.encode([u if x else u[1:] for u, x in zip(units, bare)], num_threads=1)
        groups, stats, flat = [], [], []
        for u, a, b, x in zip(units, found_a, found_b, bare):
            if x:
                b = b[1:] if b and b[0] == self.prefix else b
            elif u == " ":
                b = [self.prefix]   # nothing is left to put a blank in front of
            raw = u.encode()
            if b"".join([self.bytes_b[i] for i in b]) != raw or sum([self.len_a[i] for i in a]) != len(raw):
                groups.append(b"")
                stats.append((0, 0, 0, 0, 0, 0, 1))
                continue
            text, codes, n_groups = self._groups(a, b)
            groups.append(text)
            stats.append((len(a), len(b), n_groups, len(codes), 0, 0, 0))
            flat += codes
        self._keep(units, groups, np.array(stats, dtype=np.int64), np.array(flat, dtype=np.int64))

    def _keep(self, units: list[str], groups: list[bytes], stats: np.ndarray, codes: np.ndarray) -> None:
        at = np.fromiter(map(self.known.__getitem__, units), dtype=np.int64, count=len(units))
        self.held += sum(map(len, units))
        for i, text in zip(at.tolist(), groups):
            self.groups[i] = text
        if self.counts is not None and len(codes):
            n, top = self.counts.look_up(codes)
            of = np.repeat(np.arange(len(stats)), stats[:, 3])
            stats[:, 4] = np.bincount(of, weights=top, minlength=len(stats))
            np.add.at(stats[:, 5], of, n)
            for i, c in zip(at[of[n == 0]].tolist(), codes[n == 0].tolist()):
                self.rare.setdefault(i, []).append(c)
        self.start.array()[at, 0] = self.codes.n + np.cumsum(stats[:, 3]) - stats[:, 3]
        self.stats.array()[at] = stats
        self.codes.add(codes.reshape(-1, 1))

    def _groups(self, a: list[int], b: list[int]) -> tuple[bytes, list[int], int]:
        """Groups as text, the codes of all links, the number of groups."""
        name, len_a, len_b, n_b = self.name, self.len_a, self.len_b, self.n_b
        texts, codes = [], []
        i = j = 0
        while i < len(a):
            i0, j0, x, y = i, j, len_a[a[i]], len_b[b[j]]
            i, j = i + 1, j + 1
            while x != y:
                if x < y:
                    x += len_a[a[i]]
                    i += 1
                else:
                    y += len_b[b[j]]
                    j += 1
            own, other = a[i0:i], b[j0:j]
            if len(own) == len(other) == 1:
                texts.append(f"{name[own[0]]}|{name[other[0]]}")
                codes.append(own[0] * n_b + other[0])
            else:
                texts.append(",".join([name[k] for k in own]) + "|" + ",".join([name[k] for k in other]))
                codes += [p * n_b + q for p in own for q in other]
        return ";".join(texts).encode(), codes, len(texts)


def slabs(text: str | None) -> list[str]:
    """A blank and the text, cut where both tokenizers cut into stretches of about RUN characters."""
    if not text:
        return []
    text, out, at = " " + text, [], 0
    while len(text) - at > 2 * RUN:
        found = _CUT.search(text, at + RUN)
        if not found:
            break
        out.append(text[at:found.start()])
        at = found.start()
    out.append(text[at:])
    return out


def _documents(texts: Iterator[str | None], aligner: Aligner) -> Iterator[list[tuple[int, np.ndarray, bool]]]:
    """Runs of (document number, unit numbers, last stretch); numbers hold within the run."""
    run: list[tuple[int, str, bool]] = []
    held = 0
    for n, text in enumerate(texts):
        parts = (slabs(text) if aligner.cut else [" " + text] if text else []) or [""]
        for k, part in enumerate(parts):
            run.append((n, part, k == len(parts) - 1))
            held += len(part)
            if held >= RUN:
                yield _numbered(run, aligner)
                run, held = [], 0
    if run:
        yield _numbered(run, aligner)


def _numbered(run: list[tuple[int, str, bool]], aligner: Aligner) -> list[tuple[int, np.ndarray, bool]]:
    ids = aligner.ids([part for _, part, _ in run])
    return [(n, i, last) for (n, _, last), i in zip(run, ids)]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[str | None]:
    for at in range(0, batch.num_rows, 256):
        yield from batch.column(column).slice(at, 256).to_pylist()


# ---- counting ------------------------------------------------------------------


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, n
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(n, first)


def partial_counts(docs: DataFrame, cfg: Alignment, flush: int = 2_000_000) -> DataFrame:
    """(part, code, n): per task and pair the documents that hold it linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, aligner = TaskContext.get().partitionId(), None
        nothing = np.zeros(0, dtype=np.int64)
        held = (nothing, nothing)
        new: list[np.ndarray] = []
        size = 0

        def rows(codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(codes), 50_000):
                c = codes[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), part, dtype=np.int32)), pa.array(c),
                                                  pa.array(n[at:at + 50_000])], names=["part", "code", "n"])

        for b in batches:
            aligner = aligner or kept("aligner", (cfg.a, cfg.b), lambda: Aligner(cfg, texts=False))
            whole, broken = nothing, False
            for run in _documents(_texts(b, 0), aligner):
                for _, ids, last in run:
                    units = np.unique(ids)
                    broken = broken or bool(aligner.stats.array()[units, 6].any())
                    # what a text of many stretches has so far, and this stretch's
                    whole = np.unique(np.concatenate([whole, aligner.codes_of(units)]))
                    if last:
                        if len(whole) and not broken:
                            new.append(whole)
                            size += len(whole)
                        whole, broken = nothing, False
                if size > flush:
                    codes = np.concatenate([held[0], *new])
                    held = _summed(codes, np.concatenate([held[1], np.ones(size, dtype=np.int64)]))
                    new, size = [], 0
                    if len(held[0]) > flush:
                        yield from rows(*held)
                        held = (nothing, nothing)
        codes = np.concatenate([held[0], *new])
        yield from rows(*_summed(codes, np.concatenate([held[1], np.ones(size, dtype=np.int64)])))

    return docs.select("text").mapInArrow(count, "part int, code long, n long")


def hashed_pairs(partial: DataFrame, cfg: Alignment) -> DataFrame:
    """(shard, block, keys, hash): the distinct pairs of a shard in the order of their
    minimal hash, in blocks; the hash itself stands in block 0."""

    def build(table: pa.Table) -> pa.Table:
        keys = table.column("code").to_numpy().astype(np.uint64)
        mph = MinimalHash.build(keys)
        ordered = np.zeros(len(keys), dtype=np.int64)
        ordered[mph.index(keys)] = keys.astype(np.int64)
        blocks = range(0, len(keys), BLOCK)
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()] * len(blocks), type=pa.int32()),
                         "block": pa.array(range(len(blocks)), type=pa.int32()),
                         "keys": pa.array([ordered[at:at + BLOCK] for at in blocks], type=pa.list_(pa.int64())),
                         "hash": pa.array([mph.dump()] + [None] * (len(blocks) - 1), type=pa.binary())})

    shard = F.pmod(F.xxhash64("code"), F.lit(cfg.shards)).cast("int")
    return (partial.select("code").distinct().select(shard.alias("shard"), "code")
            .groupBy("shard").applyInArrow(build, "shard int, block int, keys array<long>, hash binary"))


def dense_counts(partial: DataFrame, hashed: DataFrame, cfg: Alignment) -> DataFrame:
    """(shard, block, counts): dense vectors of document counts, summed as a tree."""
    shard = F.pmod(F.xxhash64("code"), F.lit(cfg.shards)).cast("int")
    none = F.lit(None)
    rows = partial.select(shard.alias("shard"), F.pmod("part", F.lit(cfg.branches)).alias("branch"), none.cast("binary").alias("hash"),
                          "code", "n")
    heads = (hashed.where(F.col("hash").isNotNull())
             .select("shard", F.explode(F.sequence(F.lit(0), F.lit(cfg.branches - 1))).alias("branch"), "hash",
                     none.cast("long").alias("code"), none.cast("long").alias("n")))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, mph, vector = None, None, None

        def close() -> pa.RecordBatch:
            blocks = range(0, len(vector), BLOCK)
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(blocks), type=pa.int32()), pa.array(range(len(blocks)), type=pa.int32()),
                 pa.array([vector[i:i + BLOCK] for i in blocks], type=pa.list_(pa.int64()))],
                names=["shard", "block", "counts"])

        for b in batches:
            shards, branches = b.column(0).to_numpy(), b.column(1).to_numpy()
            cuts = np.flatnonzero((shards[1:] != shards[:-1]) | (branches[1:] != branches[:-1])) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
                own = (int(shards[low]), int(branches[low]))
                if own != at:
                    if vector is not None and vector.any():
                        yield close()
                    at, mph = own, MinimalHash.load(b.column(2)[low].as_py())   # sorts before its rows
                    vector, low = np.zeros(mph.n, dtype=np.int64), low + 1
                if low < high:
                    codes = b.column(3).slice(low, high - low).to_numpy().astype(np.uint64)
                    np.add.at(vector, mph.index(codes), b.column(4).slice(low, high - low).to_numpy())
        if vector is not None and vector.any():
            yield close()

    def summed(table: pa.Table) -> pa.Table:
        vectors = [np.asarray(x.values) for x in table.column("counts")]
        return pa.table({"shard": table.column("shard").slice(0, 1), "block": table.column("block").slice(0, 1),
                         "counts": pa.array([sum(vectors[1:], vectors[0])], type=pa.list_(pa.int64()))})

    partly = (rows.unionByName(heads).repartition("shard", "branch")
              .sortWithinPartitions("shard", "branch", F.col("code").asc_nulls_first())
              .mapInArrow(add, "shard int, block int, counts array<long>"))
    return partly.groupBy("shard", "block").applyInArrow(summed, "shard int, block int, counts array<long>")


def pair_counts(docs: DataFrame, ws: Workspace, cfg: Alignment) -> DataFrame:
    """(code, n): every linked pair of ids (A id x |B| + B id) and the documents that hold it."""
    partial = ws.table(partial_counts(docs, cfg), "partial")
    hashed = ws.table(hashed_pairs(partial, cfg), "hashed")
    counts = ws.table(dense_counts(partial, hashed, cfg), "counts")
    both = hashed.select("shard", "block", "keys").join(counts, ["shard", "block"])
    flat = both.select(F.explode(F.arrays_zip("keys", "counts")).alias("x")).select(F.col("x.keys").alias("code"), F.col("x.counts").alias("n"))
    return ws.table(flat, "pairs")


# ---- lookup --------------------------------------------------------------------


class PairCounts:
    """Counts of the commonest pairs behind a minimal hash, and the highest count of every A id."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, best: np.ndarray, n_b: int):
        self.mph, self.best, self.n_b = MinimalHash.build(codes.astype(np.uint64)), best, n_b
        self.keys, self.n = np.full(max(len(codes), 1), -1, dtype=np.int64), np.zeros(max(len(codes), 1), dtype=np.int64)
        at = self.mph.index(codes.astype(np.uint64))
        self.keys[at], self.n[at] = codes, n

    def look_up(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents of each pair, 0 if it is not held; whether that is its A id's highest)."""
        at = self.mph.index(codes.astype(np.uint64))
        n = np.where(self.keys[at] == codes, self.n[at], 0)
        return n, (n > 0) & (n == self.best[codes // self.n_b])


def common_pairs(pairs: DataFrame, cfg: Alignment, n_b: int) -> tuple[PairCounts, int]:
    """The pairs of the highest counts, as many as ``head_pairs`` allows, and how many are left out."""
    bits = F.length(F.bin("n"))
    sizes = {r["bits"]: r["c"] for r in pairs.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("c")).collect()}
    least, held = 65, 0
    for b in sorted(sizes, reverse=True):
        if held + sizes[b] > cfg.head_pairs:
            break
        least, held = b, held + sizes[b]
    top = pairs.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.max("n").alias("n")).toPandas()
    best = np.zeros(int(top["a"].max()) + 1 if len(top) else 1, dtype=np.int64)
    best[top["a"].to_numpy(dtype=np.int64)] = top["n"].to_numpy(dtype=np.int64)
    head = pairs.where(bits >= least).select("code", "n").toArrow()
    return (PairCounts(head.column("code").to_numpy(), head.column("n").to_numpy(), best, n_b),
            sum(sizes.values()) - held)


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def align(docs: DataFrame, ws: Workspace, cfg: Alignment) -> DataFrame:
    """One row per document: doc_id, FIELDS and groups_sha256."""
    spark = docs.sparkSession
    pairs = pair_counts(docs, ws, cfg)
    n_b = Aligner(cfg).n_b
    common, left_out = common_pairs(pairs, cfg, n_b)
    shared, run_id = spark.sparkContext.broadcast(common), uuid.uuid4().hex
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, " + ", ".join(f"{f} long" for f in FIELDS) + ", groups_sha256 string, "
              "rare array<struct<code: long, times: long>>")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for b in batches:
            aligner = aligner or kept("aligner", (cfg.a, cfg.b, run_id), lambda: Aligner(cfg, shared.value))
            sums, sha, rare = np.zeros((b.num_rows, 7), dtype=np.int64), [""] * b.num_rows, [None] * b.num_rows
            digest, times = None, Counter()
            for run in _documents(_texts(b, 1), aligner):
                table = aligner.stats.array()
                for n, ids, last in run:
                    if len(ids):
                        sums[n] += table[ids].sum(axis=0)
                        text = b";".join(list(map(aligner.groups.__getitem__, ids.tolist())))
                        if digest is None:
                            digest = hashlib.sha256(text)
                        else:
                            digest.update(b";" + text)
                        if aligner.rare:
                            for i in ids.tolist():
                                times.update(aligner.rare.get(i, ()))
                    if last:
                        if digest is not None and not sums[n, 6]:
                            sha[n] = digest.hexdigest()
                            rare[n] = [{"code": c, "times": k} for c, k in times.items()] or None
                        else:
                            sums[n] = 0
                        digest, times = None, Counter()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(sums[:, i]) for i in range(6)], pa.array(sha),
                 pa.array(rare, type=pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())])))],
                names=["doc_id", *FIELDS, "groups_sha256", "rare"])

    out = docs.select("doc_id", "text").mapInArrow(label, schema)
    if not left_out:
        return out.drop("rare")
    out = ws.table(out.withColumn("row", F.monotonically_increasing_id()), "common")
    best = pairs.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.max("n").alias("top"))
    more = (out.select("row", F.explode("rare").alias("x")).select("row", F.col("x.code").alias("code"), F.col("x.times").alias("times"))
            .join(pairs, "code").withColumn("a", F.expr(f"code div {n_b}")).join(best, "a")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("n")).alias("more_sum"),
                                F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best")))
    plus = {"n_best": "more_best", "count_sum": "more_sum"}
    return (out.join(more, "row", "left")
            .select("doc_id", *[(F.col(f) + F.coalesce(F.col(plus[f]), F.lit(0))).alias(f) if f in plus else F.col(f)
                                for f in FIELDS], "groups_sha256"))
