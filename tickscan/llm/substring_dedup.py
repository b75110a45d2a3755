"""Substring dedup: passages that stand in several documents are cut from all but the first.

Two searches find what repeats:

* paragraphs (lines of at least ``MIN_PARAGRAPH`` words; several shorter lines in a row with as many; and, in texts
  with blank lines, whatever stands between them): MinHash of their five-word shingles in bands;
  ``tune_bands`` picks bands and rows for the wanted recall at the wanted similarity. Paragraphs equal
  in text are one class. Classes that collide in a band are joined and compared by their exact
  shingle sets, a bucket in cells of bounded size: a class is a repeat if the Jaccard similarity with an
  earlier one reaches the threshold;
* passages anywhere: every run of ``RUN`` words of every text goes by its hash to the shard that finds
  the first document (smallest doc_id) holding it. A word is cut if some run over it stands in
  an earlier document. Runs that many documents of one batch share go to their shard once for the batch
  and get its answer by a join, so that a passage held by a third of all documents is no hot key.

Every run and paragraph is looked up for itself, whatever else its document shares: there are no rounds,
and work grows with the text. Runs are taken in ``SLICES`` by their hash, each of which reads the texts again,
so that only a part of them is on disk at a time. A repeat is cut from the later document only, so its first
occurrence always stays. The removals are clustered by connected components of the verified links:
document and first holder of each run, and all paragraphs that are alike.

Defined cases: null or empty text is returned as it is; rows equal in id and text count as one
document and stay alike; other rows that repeat an id count as documents of their own; a null id is
last in order; repeats inside one document stay; extra columns are kept; empty tables are harmless.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import connected_components, drop, free_name, keep, table
from .words import Words, chunks, lists, mix, rolling

#: Words of a run that must be equal.
RUN = 25
MIN_PARAGRAPH = 50
SHINGLE = 5
PERCENT = 80
RECALL = 0.99
#: Shingles on each side of a cell in which paragraphs of one bucket are compared.
CELL = 65536
#: Added to the line number of a block of lines.
BLOCK_LINE = 1 << 30
LAST = (1 << 63) - 1
SLICES = 3
#: Runs gathered in a task before they are sent, at least; with many shards so many for each.
GATHER, GATHER_SHARD = 1_000_000, 64
#: Runs that one shard holds, about (one word in so many bytes).
SHARD, WORD_BYTES = 1_000_000, 6
#: Documents of a batch that share a run before it is sent once for all.
MANY = 64


def tune_bands(percent: int = PERCENT, recall: float = RECALL, most: int = 12) -> tuple[int, int]:
    """(bands, rows): of the choices within ``most`` bands that reach ``recall`` at the similarity,
    the one with most rows (fewest chance collisions), then fewest bands."""
    s = percent / 100
    good = [(-r, b) for r in range(1, 9) for b in range(1, most + 1) if 1 - (1 - s ** r) ** b >= recall]
    r, b = min(good)
    return b, -r


def lines_of(w: Words) -> np.ndarray:
    """Number of line ends before each word, over the whole buffer."""
    return np.searchsorted(np.flatnonzero(w.buf == 10), w.start)


def paragraphs(w: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, end word), by row: the lines of at least ``least`` words, the several shorter
    lines in a row that have as many, and the blocks between blank lines that hold both kinds."""
    if not len(w.start):
        z = np.zeros(0, np.int64)
        return z, z, z
    line, row = lines_of(w), w.row()
    new = np.flatnonzero(np.r_[True, (line[1:] != line[:-1]) | (row[1:] != row[:-1])])
    end = np.r_[new[1:], len(line)]
    big = end - new >= least
    other = np.r_[True, row[new[1:]] != row[new[:-1]]]
    gap = ~other & np.r_[False, line[new[1:]] - line[new[:-1]] > 1]
    blank = np.zeros(len(w.first), bool)
    blank[row[new[gap]]] = True

    def groups(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first line, lines, end word) of the groups of lines that begin at ``starts``."""
        at = np.flatnonzero(starts)
        stop = np.r_[at[1:], len(new)]
        return at, stop - at, end[stop - 1]

    at, lines, last = groups(other | gap | big | np.r_[False, big[:-1]])
    short = ~big[at] & (lines > 1) & (last - new[at] >= least)
    of, rows_, stop = groups(other | gap)
    both = np.logical_or.reduceat(big, of) & (rows_ > 1) & blank[row[new[of]]]
    first = np.r_[new[big], new[at][short], new[of][both]]
    end = np.r_[end[big], last[short], stop[both]]
    order = np.argsort(row[first], kind="stable")
    first = first[order]
    return row[first], first, end[order]


def minhash(w: Words, first: np.ndarray, end: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each paragraph and band."""
    out = np.empty((len(first), bands), np.uint64)
    if not len(first):
        return out
    h = rolling(w.hash, SHINGLE)
    cut = np.stack([first, np.minimum(end - SHINGLE + 1, len(h))], 1).ravel()
    grown = np.append(h, np.uint64(0))
    for b in range(bands):
        key = np.full(len(first), b + 1, np.uint64)
        for r in range(rows):
            salt = np.uint64((2 * (b * rows + r) + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)
            key = mix(key + np.minimum.reduceat(mix(grown ^ salt), cut)[::2])
        out[:, b] = key
    return out


# -- runs of equal words ------------------------------------------------------------------------

SENT = "shard long, hashes binary, places binary, docs binary, firsts binary, hot long"
FOUND = "bucket long, rids binary, prids binary, places binary, hash long, docs binary, holder long"
REPEATS = "rid long, prids array<long>, places binary"


def _batch_rows(hashes: np.ndarray, row: np.ndarray, at: np.ndarray, ords: np.ndarray, rids: np.ndarray, shards: int):
    """Messages of one batch: runs (hash, row, place) sorted to their shards; and the runs that many
    documents share, each with its places, to be answered later, of which the shard sees the first holder."""
    order = np.argsort(hashes, kind="stable")
    h, r, p = hashes[order], row[order], at[order]
    rank = np.empty(len(ords), np.int64)
    rank[np.lexsort((rids, ords))] = np.arange(len(ords))
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[new, len(h)])
    rows, kept = [], np.ones(len(h), bool)
    bid = np.zeros(len(h), bool)
    for g in np.flatnonzero(size > MANY):
        a, z = new[g], new[g] + size[g]
        if len(np.unique(r[a:z])) <= MANY:
            continue
        kept[a:z] = False
        lead = a + int(np.argmin(rank[r[a:z]]))
        kept[lead], bid[lead] = True, True
        rows.append({"shard": int(h[a] % np.uint64(shards)) ^ int(rids[r[lead]] & 0xFFFF) % max(1, shards), "hot": int(h[a].view(np.int64)),
                     "places": p[a:z].astype(np.uint32).tobytes(), "docs": rids[r[a:z]].tobytes()})
    h, r, p, bid = h[kept], r[kept], p[kept], bid[kept]
    shard = ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)  # grows with the hash
    edge = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(h) else np.zeros(1, int)
    for a, z in zip(edge[:-1], edge[1:]):
        mine, inside = np.unique(r[a:z], return_inverse=True)
        place = p[a:z].astype(np.uint32) << np.uint32(1) | bid[a:z].astype(np.uint32)
        rows.append({"shard": int(shard[a]), "hashes": h[a:z].tobytes(), "places": np.stack([place, inside.astype(np.uint32)]).tobytes(),
                     "docs": rids[mine].tobytes(), "firsts": ords[mine].tobytes()})
    return rows


def _runs_sent(run: int, part: int, of: int, shards: int):
    """Texts (ord, rid, text) to the messages of the runs of one slice."""
    enough = max(GATHER, GATHER_SHARD * shards)
    schema = pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("hashes", "places", "docs", "firsts")), ("hot", pa.int64())])

    def go(batches):
        held, ids, tokens, rows = [], [], 0, 0

        def sent():
            ords, rids = (np.concatenate(x) for x in zip(*ids))
            return pa.RecordBatch.from_pylist(_batch_rows(*(np.concatenate(x) for x in zip(*held)), ords, rids, shards), schema)

        for batch in batches:
            for texts, w in chunks(batch, "text", "space"):
                h = rolling(w.hash, run)
                row = w.row()[:len(h)]
                at = np.arange(len(h)) - w.first[row]
                mine = np.flatnonzero((at + run <= w.counts()[row]) & (h % np.uint64(of) == np.uint64(part)))
                held.append((mix(h[mine] + np.uint64(1)), row[mine] + rows, at[mine]))
                ids.append((texts.column("ord").to_numpy(), texts.column("rid").to_numpy()))
                tokens, rows = tokens + len(mine), rows + len(texts)
                if tokens >= enough:
                    yield sent()
                    held, ids, tokens, rows = [], [], 0, 0
        if held:
            yield sent()
    return go


def _bucketed(rid: np.ndarray, prid: np.ndarray, place: np.ndarray, buckets: int) -> list[dict]:
    """Repeats dealt to the buckets of their documents, a row for each bucket."""
    of = (mix(rid.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    of, rid, prid, place = of[order], rid[order], prid[order], place[order].astype(np.uint32)
    edge = np.flatnonzero(np.r_[True, of[1:] != of[:-1], True]) if len(of) else np.zeros(1, int)
    return [{"bucket": int(of[a]), "rids": rid[a:z].tobytes(), "prids": prid[a:z].tobytes(), "places": place[a:z].tobytes()}
            for a, z in zip(edge[:-1], edge[1:])]


_FOUND_ARROW = pa.schema([("bucket", pa.int64()), ("rids", pa.binary()), ("prids", pa.binary()), ("places", pa.binary()),
                          ("hash", pa.int64()), ("docs", pa.binary()), ("holder", pa.int64())])


def _first_holders(buckets: int):
    """One shard: the runs that stand in an earlier document; the first holder of each run that a batch
    sent once; rows of shared runs pass."""
    def go(t: pa.Table) -> pa.Table:
        shared = t.filter(t.column("hot").is_valid())
        out = [{"hash": h, "places": p, "docs": d} for h, p, d in zip(*(shared.column(c).to_pylist() for c in ("hot", "places", "docs")))]
        sent = t.filter(t.column("hashes").is_valid())
        if len(sent):
            parts = []
            for h, p, d, o in zip(*(sent.column(c).to_pylist() for c in ("hashes", "places", "docs", "firsts"))):
                place, inside = np.frombuffer(p, np.uint32).reshape(2, -1)
                parts.append((np.frombuffer(h, np.uint64), place, np.frombuffer(d, np.int64)[inside], np.frombuffer(o, np.int64)[inside]))
            h, place, rid, first = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            s = h[order]
            again = np.r_[False, s[1:] == s[:-1]] if len(s) else np.zeros(0, bool)
            some = order[again | np.r_[again[1:], False] | (place[order] & 1 == 1)]  # of more than one holder, or asked for
            h, place, rid, first = h[some], place[some], rid[some], first[some]
            order = np.lexsort((rid, first, h))
            h, place, rid = h[order], place[order], rid[order]
            new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
            holder = np.repeat(rid[new], np.diff(np.r_[new, len(h)]))
            repeat = (rid != holder) & (place & 1 == 0)
            out += _bucketed(rid[repeat], holder[repeat], place[repeat] >> 1, buckets)
            asked = np.flatnonzero(place & 1)
            answer, at = np.unique(h[asked], return_index=True)
            out += [{"hash": x, "holder": p} for x, p in zip(answer.view(np.int64).tolist(), holder[asked[at]].tolist())]
        return pa.Table.from_pylist(out, _FOUND_ARROW)
    return go


def _shared_places(buckets: int):
    """The repeats of runs (holder, docs, places) that many documents of a batch share."""
    def go(batches):
        for b in batches:
            parts = [(np.zeros(0, np.int64),) * 3]
            for holder, d, p in zip(*(b.column(c).to_pylist() for c in ("holder", "docs", "places"))):
                rid, place = np.frombuffer(d, np.int64), np.frombuffer(p, np.uint32)
                later = rid != holder
                parts.append((rid[later], np.full(int(later.sum()), holder), place[later]))
            rows = _bucketed(*(np.concatenate(x) for x in zip(*parts)), buckets)
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(_FOUND_ARROW)[:4]))
    return go


def _by_document(t: pa.Table) -> pa.Table:
    """One bucket: a row for each document, with the first holders and places of its repeats."""
    kinds = {"rids": np.int64, "prids": np.int64, "places": np.uint32}
    rid, prid, place = (np.concatenate([np.frombuffer(x, k) for x in t.column(c).to_pylist()]) for c, k in kinds.items())
    order = np.argsort(rid, kind="stable")
    rid, prid, place = rid[order], prid[order], place[order]
    edge = np.flatnonzero(np.r_[True, rid[1:] != rid[:-1], True])
    rows = [{"rid": int(rid[a]), "prids": np.unique(prid[a:z]), "places": np.unique(place[a:z]).tobytes()} for a, z in zip(edge[:-1], edge[1:])]
    return pa.Table.from_pylist(rows, pa.schema([("rid", pa.int64()), ("prids", pa.list_(pa.int64())), ("places", pa.binary())]))


def equal_runs(texts: DataFrame, run: int = RUN) -> list[DataFrame]:
    """Written tables (rid, prids, places) for ``texts`` (ord, rid, text), a row for each document with
    repeats: the places of its runs of words whose first holder is another, earlier document, and those
    documents."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // (WORD_BYTES * SLICES * SHARD)))
    done = []
    for k in range(SLICES):
        sent = texts.mapInArrow(_runs_sent(run, k, SLICES, shards), SENT)
        found = keep(sent.groupBy("shard").applyInArrow(_first_holders(shards), FOUND), "repeat-runs")
        answers = found.where("holder is not null").select("hash", "holder")
        shared = found.where("docs is not null").select("hash", "docs", "places").join(answers, "hash").select("holder", "docs", "places")
        own = found.where("bucket is not null").select("bucket", "rids", "prids", "places")
        dealt = own.union(shared.mapInArrow(_shared_places(shards), "bucket long, rids binary, prids binary, places binary"))
        done.append(keep(dealt.groupBy("bucket").applyInArrow(_by_document, REPEATS), "repeat-places"))
        drop(found)
    return done


# -- paragraphs -----------------------------------------------------------------------------------

def _paragraph_rows(bands: int, rows: int, least: int):
    def go(batches):
        for batch in batches:
            for part, w in chunks(batch, "text", "space"):
                row, first, end = paragraphs(w, least)
                key = minhash(w, first, end, bands, rows)
                at = w.start[first] if len(first) else np.zeros(0, np.int64)
                cls = w.piece_hash(at, w.end[end - 1] - at) if len(first) else np.zeros(0, np.uint64)
                base = w.first[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls.view(np.int64)), part.column("ord").take(pa.array(row)), part.column("rid").take(pa.array(row)),
                     pa.array(first - base), pa.array(end - base), lists(list(key.view(np.int64)))], ["cls", "ord", "rid", "start", "end", "bands"])
    return go


def _paragraph_sets(batches):
    """The shingle sets of the wanted paragraphs, sorted."""
    for batch in batches:
        for part, w in chunks(batch, "text", "space"):
            out = []
            for i, wanted in enumerate(part.column("wanted").to_pylist()):
                a = w.first[i]
                for x in wanted:
                    held = np.unique(rolling(w.hash[a + x["start"]:a + x["end"]], SHINGLE))
                    out.append({"cls": x["cls"], "size": len(held), "words": held.tobytes()})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("cls", pa.int64()), ("size", pa.int64()), ("words", pa.binary())]))


def _alike(sets: list[list[np.ndarray]], percent: int) -> np.ndarray:
    """Which sets of the second list (rows) are as similar as ``percent`` to which of the first."""
    flat = [np.concatenate(x) for x in sets]
    size = [np.array([len(v) for v in x]) for x in sets]
    row = [np.repeat(np.arange(len(x)), x) for x in size]
    common = np.intersect1d(*flat)
    both = np.zeros((len(size[1]), len(size[0])), np.float32)
    at = [np.searchsorted(common, x) for x in flat]
    at = [np.where(common[np.minimum(a, len(common) - 1)] == x, a, -1) if len(common) else np.full(len(x), -1) for a, x in zip(at, flat)]
    for low in range(0, len(common), 2048):
        grid = []
        for k in (1, 0):
            mine = (at[k] >= low) & (at[k] < low + 2048)
            grid.append(np.zeros((len(size[k]), 2048), np.float32))
            grid[-1][row[k][mine], at[k][mine] - low] = 1
        both += grid[0] @ grid[1].T
    return 100 * both >= percent * (size[1][:, None] + size[0][None, :] - both)


def _cell(percent: int):
    """For each class asked for, the earliest class of the cell that is alike and earlier; and for all
    classes of the cell one that stands for those linked with it there."""
    def go(t: pa.Table) -> pa.Table:
        sides = [t.filter(pa.array(t.column("asked").to_numpy() == x)) for x in (0, 1)]
        sets = [[np.frombuffer(x, np.uint64) for x in side.column("words").to_pylist()] for side in sides]
        out = []
        if sets[0] and sets[1]:
            alike = _alike(sets, percent)
            names = [list(zip(*(side.column(c).to_pylist() for c in ("cls", "ord", "rid")))) for side in sides]
            label = np.arange(len(names[0]))  # of the classes asked about; linked ones get the same
            while True:
                low = np.where(alike, label[None, :], len(label)).min(1)
                new = np.minimum(label, np.where(alike, low[:, None], len(label)).min(0))
                if (new == label).all():
                    break
                label = new
            for i, (cls, *own) in enumerate(names[1]):
                hits = np.flatnonzero(alike[i])
                least = min((names[0][j][1:] for j in hits if names[0][j][1:] < tuple(own) and names[0][j][2] != own[1]), default=(None, None))
                if len(hits):
                    out.append({"cls": cls, "pord": least[0], "prid": least[1], "root": names[0][label[hits[0]]][0]})
            for j in np.flatnonzero(alike.any(0)):
                out.append({"cls": names[0][j][0], "pord": None, "prid": None, "root": names[0][label[j]][0]})
        return pa.Table.from_pylist(out, pa.schema([(c, pa.int64()) for c in ("cls", "pord", "prid", "root")]))
    return go


def near_paragraphs(texts: DataFrame, percent: int = PERCENT, least: int = MIN_PARAGRAPH, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(rid, prid, start, end) of the paragraphs that repeat one of an earlier document, and (a, b):
    documents whose paragraphs are alike, enough of them for the components. Written tables."""
    bands, rows = tune_bands(percent, recall)
    paras = keep(texts.mapInArrow(_paragraph_rows(bands, rows, least), "cls long, ord long, rid long, start long, end long, bands array<long>"), "repeat-paragraphs")
    # equal paragraphs are one class, whose earliest document stands for it
    lead = keep(paras.groupBy("cls").agg(F.min(F.struct("ord", "rid", "start", "end")).alias("f"), F.first("bands").alias("bands"))
                .select("cls", "f.*", "bands"), "repeat-classes")
    keys = lead.select("cls", (F.col("end") - F.col("start")).alias("size"), F.explode("bands").alias("key"))
    # buckets of the same classes are compared once
    buckets = (keys.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("all"), F.min("cls").alias("low"),
                                       F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("sign"), F.sum(F.greatest("size", F.lit(256))).alias("w"))
               .where("n > 1").groupBy("n", "all", "low", "sign", "w").agg(F.min("key").alias("key")))
    buckets = buckets.select("key", F.expr(f"1 + w div {CELL}").alias("cells"))
    placed = keep(keys.join(buckets, "key").select("key", "cls", "cells", F.expr("pmod(xxhash64(cls), cells)").alias("own")), "repeat-open")
    wanted = placed.select("cls").distinct().join(lead, "cls").groupBy("rid").agg(F.collect_list(F.struct("cls", "start", "end")).alias("wanted"))
    sets = keep(texts.join(wanted, "rid").select("text", "wanted").mapInArrow(_paragraph_sets, "cls long, size long, words binary"), "repeat-sets")
    each = F.explode(F.expr("sequence(cast(0 as bigint), cast(cells - 1 as bigint))"))
    cell = (placed.select("key", "cls", F.lit(0).alias("asked"), F.col("own").cast("long").alias("i"), each.alias("j"))
            .union(placed.select("key", "cls", F.lit(1), each.alias("i"), F.col("own").cast("long").alias("j"))))
    words = lead.select("cls", "ord", "rid").join(sets, "cls")
    links = keep(cell.join(words, "cls").groupBy("key", "i", "j").applyInArrow(_cell(percent), "cls long, pord long, prid long, root long"), "repeat-links")
    best = links.where("prid is not null").groupBy("cls").agg(F.min(F.struct("pord", "prid")).alias("m"))
    spans = (paras.select("cls", "rid", "start", "end").join(lead.select("cls", F.col("rid").alias("f_rid")), "cls").join(best, "cls", "left")
             .select("rid", F.when(F.col("rid") != F.col("f_rid"), F.col("f_rid")).when(F.col("m.prid") != F.col("rid"), F.col("m.prid")).alias("prid"), "start", "end")
             .where("prid is not null"))
    spans = keep(spans, "repeat-spans")
    named = lead.select(F.col("cls").alias("c"), F.col("rid").alias("r"))
    alike = links.select("cls", "root").where("cls <> root").distinct()
    alike = alike.join(named, F.col("cls") == F.col("c")).select("root", F.col("r").alias("a")).join(named, F.col("root") == F.col("c")).select("a", F.col("r").alias("b"))
    edges = keep(alike.where("a <> b").distinct(), "repeat-edges")
    drop(paras, lead, placed, sets, links)
    return spans, edges


def _cut(run: int):
    def go(batches):
        for batch in batches:
            for part, w in chunks(batch, "_text", "space"):
                start, end, places = (part.column(c).to_pylist() for c in ("_start", "_end", "_places"))
                texts = part.column("_text").to_pylist()
                removed, base = np.zeros(len(part), np.int64), 0
                for i, t in enumerate(texts):
                    raw = (t or "").encode()
                    if start[i] or places[i]:
                        a, b = w.first[i], w.first[i + 1]
                        gone = np.zeros(b - a, bool)
                        for x, y in zip(start[i] or (), end[i] or ()):
                            gone[x:y] = True
                        over = np.zeros(b - a + 1, np.int32)
                        for p in places[i] or ():
                            at = np.frombuffer(p, np.uint32).astype(np.int64)
                            np.add.at(over, at, 1)
                            np.add.at(over, at + run, -1)
                        gone |= np.cumsum(over[:-1]) > 0
                        removed[i] = gone.sum()
                        at = np.append(w.start[a:b] - base, len(raw))
                        keep_bytes = [raw[:at[0]]]
                        edge = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))
                        keep_bytes += [raw[at[x]:at[y]] for x, y in zip(edge[::2], edge[1::2])]
                        texts[i] = b"".join(keep_bytes).decode("utf-8", "ignore")
                    base += len(raw)
                cols = [c if n not in ("_text",) else pa.array(texts, pa.string()) for n, c in zip(part.schema.names, part.columns)]
                drop_at = [part.schema.get_field_index(n) for n in ("_start", "_end", "_places")]
                cols = [c for j, c in enumerate(cols) if j not in drop_at]
                names = [n for j, n in enumerate(part.schema.names) if j not in drop_at]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(w.counts()), pa.array(removed)], [*names, "_n", "_gone"])
    return go


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    run: int = RUN, least: int = MIN_PARAGRAPH, recall: float = RECALL) -> DataFrame:
    """``docs`` with the repeats cut from the text, and the columns n_words, n_removed, component_id
    (smallest id linked by removals, the row's own id without any); a clash of names adds underscores."""
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    rid = F.xxhash64(F.col(id_col), F.col(text_col), F.lit(11))
    texts = docs.select(order.alias("ord"), rid.alias("rid"), F.col(text_col).alias("text")).where("text <> ''")
    # rows equal in id and text are one document
    again = keep(texts.groupBy("rid").count().where("count > 1").select("rid"), "repeat-equal")
    texts = texts.join(again, "rid", "left_anti").union(texts.join(again, "rid", "left_semi").dropDuplicates(["rid"])).select("ord", "rid", "text")
    spans, alike = near_paragraphs(texts, percent, least, recall)
    runs = equal_runs(texts, run)
    places = reduce(DataFrame.union, runs)
    edges = (spans.select(F.col("prid").alias("a"), F.col("rid").alias("b")).union(alike)
             .union(places.select(F.explode("prids").alias("a"), F.col("rid").alias("b"))).distinct())
    comp = keep(connected_components(edges), "repeat-comp")
    ids = docs.select(rid.alias("node"), F.col(id_col).cast("long").alias("id")).distinct().join(comp, "node")
    ids = keep(ids, "repeat-ids")
    named = ids.join(ids.groupBy("comp").agg(F.min("id").alias("least")), "comp").select("node", "least").dropDuplicates(["node"])
    by_row = (spans.groupBy("rid").agg(F.collect_list("start").alias("_start"), F.collect_list("end").alias("_end"))
              .join(places.groupBy("rid").agg(F.collect_list("places").alias("_places")), "rid", "full"))
    marks = keep(named.join(by_row.withColumnRenamed("rid", "node"), "node", "left"), "repeat-marks")
    drop(again, spans, alike, comp, ids, *runs)
    wide = docs.select(*[F.col(f"`{c}`").alias("_text" if c == text_col else f"c_{i}") for i, c in enumerate(docs.columns)],
                       rid.alias("node")).join(marks, "node", "left").drop("node")
    plain = [f for f in wide.schema.fields if f.name not in ("_start", "_end", "_places")]
    out = wide.mapInArrow(_cut(run), T.StructType([*plain, T.StructField("_n", T.LongType()), T.StructField("_gone", T.LongType())]))
    names = {n: free_name(docs, n) for n in ("n_words", "n_removed", "component_id")}
    at = docs.columns.index(id_col)
    return out.select(*[F.col("_text" if c == text_col else f"c_{i}").alias(c) for i, c in enumerate(docs.columns)],
                      F.col("_n").alias(names["n_words"]), F.col("_gone").alias(names["n_removed"]),
                      F.coalesce("least", F.col(f"c_{at}").cast("long")).alias(names["component_id"]))


def op1_substring_dedup(spark, sf_dir):
    """One row per document: doc_id, n_words, n_removed, component_id, text (without the repeats)."""
    out = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", "component_id", "text")
