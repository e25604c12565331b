"""Best-two-fit packing of tokenised documents into fixed-length sequences.

Tokens are counted in Arrow tasks. Packing then works on the histogram of
piece lengths, which has at most ``capacity`` rows however large the corpus
is: a bin is filled greedily with the longest lengths that fit, its smallest
member is replaced by two unpacked lengths that fill the widened gap more
tightly, and the resulting pattern is used as many times as the counts
allow. Every piece gets a rank among the pieces of its length (numbered in
hashed sub-groups whose sizes are summed first, so one frequent length is
spread over tasks); rank intervals of the patterns give its sequence and
offset.

Defined results: a NULL or empty text is one piece holding only the closing
id; repeated rows are packed once each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from customer360.llm.textnum import SPACE, chunks, span_hashes, utf8
from customer360.plans import cut_lineage

CAPACITY = 2048
CLOSING_ID = 0
#: Pieces numbered by one window partition.
RANK_GROUP = 100_000
#: Distinct pieces whose ids a worker keeps before it starts afresh (some 40 bytes each).
WORD_CACHE = 800_000

_TOKENIZERS: dict[str, "WordTokenizer"] = {}


def default_tokenizer() -> str:
    """Place of the public byte-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Classes of ASCII bytes that the vocabulary's split pattern keeps apart: 1
#: letters, 2 digits, 3 white space other than the space, 4 the rest.
KIND = np.full(256, 4, np.uint8)
KIND[[*range(65, 91), *range(97, 123)]] = 1
KIND[48:58] = 2
KIND[9:14] = 3


class WordTokenizer:
    """Ids of whole texts, encoding each distinct piece once.

    The vocabulary's split pattern starts a new piece at every single space
    between two non-spaces, and inside a word where letters, digits, white space
    and other characters meet. So a text without runs of white space (and without
    non-ASCII white space) can be encoded piece by piece; a word with an
    apostrophe (which may begin a contraction) or a non-ASCII character stays one
    piece. Any other text, and one that holds an added token of the vocabulary, is
    encoded whole. Pieces are looked up by a 64-bit hash of their bytes in an
    open-addressing table."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values() if t.content]
        self._clear()

    def _clear(self) -> None:
        self.slot = np.full(4 * WORD_CACHE, -1, np.int32)
        self.key = np.zeros(0, np.uint64)
        self.at = np.zeros(1, np.int64)
        self.flat = np.zeros(1 << 20, np.uint32)

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Number of each word, -1 for a new one."""
        out = np.full(len(h), -1, np.int64)
        todo, place = np.arange(len(h)), (h % np.uint64(len(self.slot))).astype(np.int64)
        while len(todo):
            got = self.slot[place[todo]]
            full = got >= 0
            same = full & (self.key[np.where(full, got, 0)] == h[todo]) if len(self.key) else full & False
            out[todo[same]] = got[same]
            todo = todo[full & ~same]
            place[todo] = (place[todo] + 1) % len(self.slot)
        return out

    def _learn(self, h: np.ndarray, words: list[str]) -> None:
        """Add the distinct new words."""
        ids = []
        for i in range(0, len(words), 5_000):
            ids += [x.ids for x in self.tok.encode_batch_fast(words[i : i + 5_000], add_special_tokens=False)]
        ends = self.at[-1] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(ends[-1], len(self.flat)), np.uint32)])
        self.flat[self.at[-1] : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32)
        number = np.arange(len(self.key), len(self.key) + len(h))
        self.key, self.at = np.concatenate((self.key, h)), np.concatenate((self.at, ends))
        if len(self.key) * 2 > len(self.slot):
            self.slot = np.full(4 * len(self.key), -1, np.int32)
            h, number = self.key, np.arange(len(self.key))
        place, todo = (h % np.uint64(len(self.slot))).astype(np.int64), np.arange(len(h))
        while len(todo):
            free = todo[self.slot[place[todo]] < 0]
            self.slot[place[free]] = number[free]
            todo = todo[self.slot[place[todo]] != number[todo]]
            place[todo] = (place[todo] + 1) % len(self.slot)

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of every text (uint32, no special tokens); NULL is empty."""
        if len(self.key) > WORD_CACHE:
            self._clear()
        raw, off = utf8(column)
        n = len(raw)
        follow, third = np.append(raw[1:], 0), np.append(raw[2:], [0, 0])[:n]
        odd = (SPACE[raw] & SPACE[follow]) | ((raw == 0xC2) & ((follow == 0x85) | (follow == 0xA0))) | ((raw == 0xE1) & (follow == 0x9A))
        odd |= (raw == 0xE2) & (((follow == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF))) | ((follow == 0x81) & (third == 0x9F)))
        odd |= (raw == 0xE3) & (follow == 0x80) & (third == 0x80)
        whole = np.zeros(len(column) + 1, bool)
        whole[np.searchsorted(off, np.flatnonzero(odd), "right") - 1] = True
        data = raw.tobytes()
        for t in self.added:  # found across two texts, it only encodes the first one whole
            i = data.find(t)
            while i >= 0:
                whole[np.searchsorted(off, i, "right") - 1] = True
                i = data.find(t, i + 1)
        if not n:
            return [np.zeros(0, np.uint32)] * len(column)
        # Every byte belongs to one piece. Words begin at a text's start and at every
        # space; those without apostrophes and non-ASCII bytes break where two kinds meet.
        word = raw == 32
        word[off[:-1][np.diff(off) > 0]] = True
        starts = np.flatnonzero(word)
        length = np.diff(np.append(starts, n))
        plain = np.repeat(np.add.reduceat((raw == 39) | (raw >= 128), starts, dtype=np.int64) == 0, length)
        kind = KIND[raw]
        word[1:] |= (kind[1:] != kind[:-1]) & (raw[:-1] != 32) & plain[1:]
        begin = np.flatnonzero(word)
        stop = np.append(begin[1:], n)
        row = np.searchsorted(off, begin, "right") - 1
        use = ~whole[row]
        begin, stop, row = begin[use], stop[use], row[use]
        h = span_hashes(raw, begin, stop, fold=False)
        which = self._find(h)
        lost = np.flatnonzero(which < 0)
        if len(lost):
            fresh, at = np.unique(h[lost], return_index=True)
            self._learn(fresh, [data[a:b].decode("utf-8", "replace") for a, b in zip(begin[lost[at]].tolist(), stop[lost[at]].tolist(), strict=True)])
            which[lost] = self._find(h[lost])
        size = self.at[which + 1] - self.at[which]
        end = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(self.at[which] - end[:-1], size) + np.arange(end[-1])]
        cut = end[np.searchsorted(row, np.arange(len(column) + 1))]
        return [
            np.asarray(self.tok.encode(column[i].as_py(), add_special_tokens=False).ids, np.uint32) if w else ids[a:b]
            for i, (w, a, b) in enumerate(zip(whole[:-1].tolist(), cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        ]


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and the ids).

    A document is its ids and the closing id. Only one longer than
    ``capacity`` is cut: all its pieces are full, but for the first one."""
    path = tokenizer or default_tokenizer()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = WordTokenizer(path)
        for b in chunks(batches):
            keys = b.column("doc_id")
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, ids in enumerate(_TOKENIZERS[path].encode(b.column("text"))):
                ids = np.append(ids, np.uint32(CLOSING_ID)).astype("<u4")
                first = len(ids) % capacity or capacity
                for p, a in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[a : first if p == 0 else a + capacity]
                    row.append(i)
                    piece.append(p)
                    start.append(a)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype(np.int32))
            cols = [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def plan_bins(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-two-fit over a histogram: ``counts[l]`` pieces of length l, capacity
    ``len(counts) - 1``. Returns (times used, [(length, copies), ...]) patterns."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    cap = len(left) - 1
    order = np.arange(cap + 1)
    out = []
    while left.any():
        used: dict[int, int] = {}
        gap = cap
        have = np.flatnonzero(left)
        while len(have) and gap >= have[0]:
            i = int(np.searchsorted(have, gap, "right")) - 1
            size = int(have[i])
            n = min(gap // size, int(left[size]))
            used[size] = n
            gap -= n * size
            have = have[:i]
        if gap:
            small = min(used)
            used[small] -= 1
            room = gap + small
            spare = left.copy()
            for k, n in used.items():
                spare[k] -= n
            # The largest spare length up to each x; then the best partner of every a.
            below = np.maximum.accumulate(np.where(spare > 0, order, 0))
            a = order[1 : room + 1]
            b = below[np.minimum(a, room - a)]
            b = np.where((b == a) & (spare[a] < 2), below[np.maximum(b - 1, 0)], b)
            pair = np.where((spare[a] > 0) & (b > 0), a + b, 0)
            best = int(np.argmax(pair))
            if pair[best] > small:
                for x in (int(a[best]), int(b[best])):
                    used[x] = used.get(x, 0) + 1
            else:
                used[small] += 1
            used = {k: n for k, n in used.items() if n}
        times = min(int(left[k]) // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= times * n
        out.append((times, sorted(used.items(), reverse=True)))
    return out


def _intervals(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies in a sequence, offset)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, members in plan:
        offset = 0
        for size, copies in members:
            rows.append((size, taken.get(size, 0), sequence, copies, offset))
            taken[size] = taken.get(size, 0) + times * copies
            offset += size * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rank_group: int = RANK_GROUP) -> DataFrame:
    """``pieces`` (with doc_id, piece, length) plus sequence_id and offset."""
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    counts = np.zeros(capacity + 1, np.int64)
    for k, n in hist.items():
        counts[k] = n
    table = _intervals(plan_bins(counts))
    groups = max(1, -(-max(hist.values(), default=1) // rank_group))
    part = pieces.withColumn("_sub", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    sizes = part.groupBy("length", "_sub").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("length", "_sub").orderBy("doc_id", "piece")) - 1
    ranked = part.withColumn("_own", own).join(base, ["length", "_sub"])
    ranked = ranked.select(*pieces.columns, (F.col("_base") + F.col("_own")).alias("_rank"))
    names = pieces.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id bigint, offset bigint"
    wide = 1 << 44  # ranks of one length stay below it

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = table[:, 0] * wide + table[:, 1]
        for b in batches:
            size = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = b.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            _, first, sequence, copies, offset = table[np.searchsorted(key, size * wide + rank, "right") - 1].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(sequence + nth // copies), pa.array(offset + nth % copies * size)],
                [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text); see the module text."""
    return pack_pieces(cut_lineage(token_pieces(docs, tokenizer, capacity, with_ids)), capacity)
