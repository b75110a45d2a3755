"""Packing of tokenised documents into sequences of at most ``CAPACITY`` tokens.

A document's ids are its tokens and one end id; only documents longer than a sequence are cut, into
full pieces and a last shorter one. Whole pieces are packed:

1. Pieces go by a hash to groups of about ``GROUP`` pieces; a full piece is a sequence of its own.
2. Each group starts from best fit, longest first, and is bettered by swap-based local search: the
   emptiest bin gives to another underfull bin by moving a piece there, by exchanging one piece for
   a smaller one, two for a smaller one, or one for two smaller ones. Each step raises the sum of squared fills; a bin that
   has given all is gone. The search ends at the lower bound of total length / capacity, or
   when ``TRIES`` bins in a row have no step left, or after ``STEPS`` steps.
3. The underfull bins of all groups are dealt anew by a hash of the bin, into fewer groups, and
   bettered alike, until one group held them all or a round empties no bin.

A task holds one group: sizes and numbers of its pieces, never texts or ids. Pieces are written once
before they are dealt out, so that all later steps see the same numbers.

Words between ASCII white space, without stops and commas at their ends, are tokenised once and looked
up from then on: the tokenizer drops white space and cuts there too, no rule of it reaches across, so a text's ids are those of its words in a row (the
tests compare). Strings of special tokens become what the tokenizer's file makes of them.

Defined cases: null and empty texts are the end id alone, a piece of one token; rows that repeat an
id or a text, or have a null id, are packed each for itself; very long texts become many pieces;
pieces of equal length are interchangeable and taken by number; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, table
from .runs import split_words
from .words import CHUNK_BYTES, SEPARATORS, column_bytes

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Pieces in one group, about.
GROUP = 20_000
#: Donor bins without a step after which a group's search ends.
TRIES = 32
#: Steps of a group's search at most.
STEPS = 5_000
#: Words of a generation whose ids a process remembers (about 120 MB).
KNOWN_WORDS = 600_000
_BYTE = np.arange(256)
STOP = np.isin(_BYTE, list(b".,;:!?"))
ALNUM = ((_BYTE >= 0x30) & (_BYTE <= 0x39)) | ((_BYTE >= 0x41) & (_BYTE <= 0x5A)) | ((_BYTE >= 0x61) & (_BYTE <= 0x7A))
LOWER = np.where((_BYTE >= 0x41) & (_BYTE <= 0x5A), _BYTE + 0x20, _BYTE).astype(np.uint8)
#: What the tokenizer's special tokens begin with: they are told from other text before it is lower-cased.
SPECIAL = b"<|"

class Words:
    """A tokenizer and the ids of the words that it met lately, in two generations: a word that is met
    again moves to the young one, which becomes the old one when it is full."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.encoder = Tokenizer.from_file(path)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of the distinct ``words`` as little-endian 32-bit integers."""
        if len(self.young) > KNOWN_WORDS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = []
        for w in words:
            if w not in young:
                held = old.get(w)
                if held is None:
                    new.append(w)
                else:
                    young[w] = held
        for w, e in zip(new, self.encoder.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)):
            young[w] = np.array(e.ids, "<u4").tobytes()
        return [young[w] for w in words]


def _tokenizer(path: str | None) -> Words:
    """The words of this process. They are held by the tokenizers module, since this one is sent to the
    tasks anew and its own variables with it."""
    import tokenizers
    known = tokenizers.__dict__.setdefault("_met_words", {})
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    if path not in known:
        known[path] = Words(path)
    return known[path]


def _stops(buf: np.ndarray) -> np.ndarray:
    """Where stops and commas at a word's end follow a letter or digit: the tokenizer's rules cut there
    too, and fewer distinct words are left."""
    out, stop = np.zeros(len(buf), bool), STOP[buf]
    at = np.flatnonzero(stop)
    at = at[at > 0]
    at = at[~stop[at - 1] & ALNUM[buf[at - 1]]]
    other = np.flatnonzero(~stop)
    after = np.searchsorted(other, at)
    inside = after < len(other)
    last = at[~inside]
    at = at[inside]
    out[at[SEPARATORS["space"][buf[other[after[inside]]]]]] = True
    out[last] = True
    return out


def token_ids(buf: np.ndarray, offsets: np.ndarray, tokenizer: str | None = None, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets by row) of the texts in ``buf``, each with its end id."""
    if not ((buf[:-1] == SPECIAL[0]) & (buf[1:] == SPECIAL[1])).any():
        buf = LOWER[buf]  # as the tokenizer does after its special tokens
    first, words, _, _ = split_words(buf, offsets, _stops(buf))
    code = words.indices.to_numpy(zero_copy_only=False)
    each = _tokenizer(tokenizer).ids(words.dictionary.to_pylist())
    each.append(np.array([end_id], "<u4").tobytes())
    size = np.fromiter(map(len, each), np.int64, len(each)) // 4
    start = np.cumsum(size) - size
    flat = np.frombuffer(b"".join(each), "<u4")
    code = np.insert(code, first[1:], len(each) - 1)
    count = size[code]
    to = np.cumsum(count)
    ids = flat[np.repeat(start[code] - (to - count), count) + np.arange(to[-1] if len(to) else 0)]
    ends = first[1:] + np.arange(1, len(first))  # words and ends up to each row's end
    return ids, np.concatenate([[0], to[ends - 1]])


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                 tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, and ids if wanted): the pieces of each document."""
    fields = [docs.schema[id_col], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = column_bytes(batch.column(text))
            at = 0
            while at < len(batch):
                to = max(at + 1, int(np.searchsorted(off, off[at] + CHUNK_BYTES, "right")) - 1)
                ids, ends = token_ids(buf[off[at]:off[to]], off[at:to + 1] - off[at], tokenizer, end_id)
                total = np.diff(ends)
                n = -(-total // capacity)
                row = np.repeat(np.arange(to - at), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(total[row] - start, capacity)
                begin = ends[:-1][row] + start
                crc = [zlib.crc32(ids[b:b + k].astype("<u4").tobytes()) for b, k in zip(begin.tolist(), length.tolist())]
                cols = [batch.column(id_col).slice(at, to - at).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start),
                        pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])
                at = to

    return docs.select(id_col, text).mapInArrow(work, T.StructType(fields))


def best_fit(size: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """A bin for each piece: longest first, each to the bin that it leaves the least room in."""
    out = np.empty(len(size), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room
    rooms, bins = 0, 0  # rooms: a bit for each room that some bin has
    for i in np.argsort(-size, kind="stable").tolist():
        n = int(size[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b, bins = capacity, bins, bins + 1
        out[i] = b
        if room > n:
            open_bins[room - n].append(b)
            rooms |= 1 << (room - n)
    return out


class Search:
    """Local search over the underfull bins of one group."""

    def __init__(self, size: np.ndarray, bins: np.ndarray, capacity: int = CAPACITY):
        self.size, self.bin, self.capacity = size, bins.copy(), capacity
        self.fill = np.bincount(bins, size, int(bins.max()) + 1 if len(bins) else 0).astype(np.int64)
        self.held: list[set[int]] = [set() for _ in self.fill]
        for i, b in enumerate(bins.tolist()):
            self.held[b].add(i)

    def _place(self, i: int, b: int) -> None:
        a = self.bin[i]
        self.held[a].discard(i)
        self.held[b].add(i)
        self.fill[a] -= self.size[i]
        self.fill[b] += self.size[i]
        self.bin[i] = b

    def _gain(self, d: np.ndarray, b: np.ndarray, donor: int) -> np.ndarray:
        """Rise of the squared fills if ``donor`` gives d more than it takes to bins ``b``; 0 if it
        can't be."""
        f = self.fill[b]
        ok = (d > 0) & (d <= self.capacity - f) & (b != donor) & (f > 0)
        return np.where(ok, 2 * d * (f - self.fill[donor] + d), 0)

    def _step(self, donor: int) -> bool:
        """The best move, or else exchange of one, or else of two for one, or else of one for two; False
        if none raises the squared fills."""
        mine = sorted(self.held[donor])
        by_size = {int(self.size[i]): (i,) for i in mine}
        under = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
        best, do = 0, None
        for x, got in by_size.items():
            gain = self._gain(np.int64(x), under, donor)
            k = int(np.argmax(gain)) if len(gain) else 0
            if len(gain) and gain[k] > best:
                best, do = gain[k], (got, None, int(under[k]))
        if do is None:
            items = np.flatnonzero(self.fill[self.bin] < self.capacity)
            size, at = self.size[items], self.bin[items]
            pairs: dict[int, tuple[int, ...]] = {}
            for options in (by_size, pairs):
                if options is pairs:  # made only if no single piece helps
                    for k, i in enumerate(mine):
                        for j in mine[k + 1:]:
                            pairs.setdefault(int(self.size[i] + self.size[j]), (i, j))
                for x, got in options.items():
                    gain = self._gain(x - size, at, donor)
                    k = int(np.argmax(gain))
                    if gain[k] > best:
                        best, do = gain[k], (got, (int(items[k]),), int(at[k]))
                if do:
                    break
            if do is None and by_size:  # one for two smaller ones of another bin
                first, second = self._pairs(under, max(by_size))
                if len(first):
                    size, at = self.size[first] + self.size[second], self.bin[first]
                    for x, got in by_size.items():
                        gain = self._gain(x - size, at, donor)
                        k = int(np.argmax(gain))
                        if gain[k] > best:
                            best, do = gain[k], (got, (int(first[k]), int(second[k])), int(at[k]))
        if do is None:
            return False
        gives, takes, b = do
        for i in takes or ():
            self._place(i, donor)
        for i in gives:
            self._place(i, b)
        return True

    def _pairs(self, bins: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
        """Two pieces of one bin that are smaller together than ``below``, one for each sum in a bin."""
        out: list[tuple[int, int]] = []
        for b in bins.tolist():
            mine = sorted((i for i in self.held[b] if self.size[i] < below), key=lambda i: (self.size[i], i))
            sums = {}
            for k, i in enumerate(mine):
                for j in mine[k + 1:]:
                    both = int(self.size[i] + self.size[j])
                    if both >= below:
                        break
                    sums.setdefault(both, (i, j))
            out += sums.values()
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]

    def run(self, tries: int = TRIES, steps: int = STEPS) -> np.ndarray:
        """The bins of the pieces at the end."""
        least = -(-int(self.size.sum()) // self.capacity)
        stuck: set[int] = set()
        while np.count_nonzero(self.fill) > least and len(stuck) < tries and steps:
            open_bins = [b for b in np.flatnonzero((self.fill > 0) & (self.fill < self.capacity)).tolist() if b not in stuck]
            if len(open_bins) + len(stuck) < 2 or not open_bins:
                break
            donor = min(open_bins, key=lambda b: (self.fill[b], b))
            before = steps
            while self.fill[donor] and steps and self._step(donor):
                steps -= 1
            if steps < before:
                stuck.clear()  # others may have a step again
            if self.fill[donor]:
                stuck.add(donor)
        return self.bin


def _in_group(capacity: int, fresh: bool):
    """The Arrow function that packs one group: (grp, uid, length, bin) -> (uid, length, bin, fill, offset)."""
    def work(t: pa.Table) -> pa.Table:
        uid, size = t["uid"].to_numpy(), t["length"].to_numpy()
        order = np.argsort(uid)
        uid, size = uid[order], size[order]
        if fresh:
            start = best_fit(size, capacity)
            name = (t["grp"][0].as_py() << 32) + np.arange(int(start.max()) + 1)
        else:
            name, start = np.unique(t["bin"].to_numpy()[order], return_inverse=True)
        at = Search(size, start, capacity).run()
        by = np.lexsort((uid, at))
        total = np.cumsum(size[by]) - size[by]
        new = np.append(True, np.diff(at[by]) != 0)
        offset = total - np.repeat(total[new], np.diff(np.append(np.flatnonzero(new), len(by))))
        fill = np.bincount(at, size).astype(np.int64)
        return pa.table({"uid": uid[by], "length": size[by], "bin": name[at[by]], "fill": fill[at[by]], "offset": offset})
    return work


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(uid, sequence_id, offset) for ``pieces`` (uid: long, unique and stable; length: long)."""
    own = pieces.where(F.col("length") >= capacity).select("uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.where(F.col("length") < capacity).select("uid", F.col("length").cast("long").alias("length"), F.lit(0).cast("long").alias("bin"))
    items, bins, rounds = todo.count(), None, []
    while items:
        groups = -(-items // group)
        deal = F.xxhash64("uid") if bins is None else F.xxhash64("bin", F.lit(len(rounds)))
        dealt = todo.withColumn("grp", F.pmod(deal, F.lit(groups)).cast("long"))
        done = keep(dealt.groupBy("grp").applyInArrow(_in_group(capacity, bins is None), "uid long, length long, bin long, fill long, offset long"), "packing-round")
        rounds.append(done)
        open_rows = done.where(F.col("fill") < capacity)
        items, left = open_rows.agg(F.count("*"), F.countDistinct("bin")).first()
        every = done.agg(F.countDistinct("bin")).first()[0]
        if groups == 1 or (bins is not None and every >= bins):
            break
        todo, bins = open_rows.select("uid", "length", "bin"), left
    out = own
    for i, done in enumerate(rounds):
        last = i == len(rounds) - 1
        rows = done if last else done.where(F.col("fill") >= capacity)
        out = out.union(rows.select("uid", F.col("bin").alias("sequence_id"), "offset"))
    return out


def best_fit_packing(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                     tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """The pieces of ``token_pieces`` with sequence_id and offset."""
    pieces = token_pieces(docs, id_col, text, capacity, tokenizer, end_id, with_ids)
    pieces = keep(pieces.withColumn("uid", F.monotonically_increasing_id()), "packing-pieces")
    return pieces.join(pack(pieces.select("uid", "length"), capacity, group), "uid").drop("uid")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing made with ids: at most a capacity of ids in each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def op13_best_fit_packing(spark, sf_dir):
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return best_fit_packing(table(spark, sf_dir, "documents"))
