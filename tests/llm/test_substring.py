"""Substring dedup: planted passages and near paragraphs, nothing else touched."""
import random

from llm_support import frame

from tickscan.llm import substring_dedup as S
from tickscan.llm.substring_dedup import substring_dedup, tune_bands


def corpus():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    fresh = lambda n: [word() for _ in range(n)]
    rows = [(i, " ".join(fresh(100)) + "\n" + " ".join(fresh(30))) for i in range(20)]
    passage, short, para = fresh(55), fresh(20), fresh(90)
    for i in range(20, 60):  # inside paragraphs, at any place
        rows.append((i, "\n".join([" ".join(fresh(rnd.randrange(1, 60)) + passage + fresh(rnd.randrange(1, 60))), " ".join(fresh(40))])))
    for i in range(60, 70):  # across a line end
        rows.append((i, " ".join(fresh(10) + passage[:30]) + "\n" + " ".join(passage[30:] + fresh(10))))
    for i in range(70, 80):  # too short a passage
        rows.append((i, " ".join(fresh(50) + short + fresh(50))))
    for i in range(80, 90):  # paragraphs with a word changed
        p = list(para)
        p[rnd.randrange(90)] = word()
        rows.append((i, "Éa " + " ".join(fresh(40)) + "\n" + " ".join(p) + "\n" + " ".join(fresh(30))))
    return rows, passage, para


def test_planted(spark):
    rows, passage, para = corpus()
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows)).collect()}
    text = dict(rows)
    for i in [*range(21), *range(70, 81)]:
        assert out[i]["text"] == text[i] and out[i]["n_removed"] == 0
    for i in range(21, 70):
        rest = out[i]["text"].split()
        assert not set(rest) & set(passage) and len(rest) + 55 == len(text[i].split()) and out[i]["n_removed"] == 55
        assert [w for w in text[i].split() if w not in passage] == rest
        assert out[i]["component_id"] == 20
    for i in range(81, 90):
        assert out[i]["n_removed"] >= 85 and out[i]["component_id"] == 80 and out[i]["text"].startswith("Éa ")


def test_odd_rows(spark):
    rows, passage, _ = corpus()
    p = " ".join(passage)
    odd = [(1, None, 1, "a"), (2, "", 2, "b"), (5, p, 3, "c"), (4, p, 4, None), (None, p, 5, "e"), (5, p, 6, "f"), (5, p + " more", 7, "g"),
           (6, "in " * 300, 8, "h"), (7, "in " * 200 + "x", 9, "i")]
    df = spark.createDataFrame(odd, "doc_id long, text string, n_words int, rid string")
    out = {r["n_words"]: r for r in substring_dedup(df).collect()}
    assert substring_dedup(df).columns == ["doc_id", "text", "n_words", "rid", "n_words_", "n_removed", "component_id"]
    assert out[4]["text"] == p and out[1]["text"] is None and out[2]["text"] == ""
    assert out[3]["text"] == out[6]["text"] == out[5]["text"] == out[7]["text"] == ""
    assert out[5]["component_id"] == 4 and out[8]["n_removed"] == 0 and out[9]["text"].strip() == "x"
    assert substring_dedup(frame(spark, [])).collect() == []


def test_bands():
    for percent in (70, 80, 90):
        b, r = tune_bands(percent, 0.99)
        assert 1 - (1 - (percent / 100) ** r) ** b >= 0.99


def words(seed):
    rnd = random.Random(seed)
    return lambda n: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n)]


def test_pairs_behind_unlike_pivots(spark):
    """A pair alike above the threshold, in buckets whose first holders are unlike templates."""
    fresh, rnd = words(3), random.Random(3)
    base = fresh(200)

    def near(p, n):  # every run of equal words stays short of a passage
        p = list(p)
        for k in range(n):
            p[(k * len(p)) // n + rnd.randrange(5)] = fresh(1)[0]
        return p
    own = near(base, 13)
    rows = [(i, " ".join(near(base, 13))) for i in range(40)] + [(50, " ".join(own)), (51, " ".join(near(own, 3)))]
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows), run=60).collect()}
    text = dict(rows)
    shingle = lambda t: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)}
    for i, t in rows:
        a = shingle(t)
        want = any(100 * len(a & b) >= 80 * len(a | b) for j, u in rows if j < i for b in [shingle(u)])
        assert (out[i]["n_removed"] == len(t.split())) == want, i
    assert out[51]["n_removed"] == 200 and text[50] == out[50]["text"]


def test_longer_passage_than_the_pivots(spark):
    """B and C share a long passage, the first document only a part of it."""
    fresh = words(5)
    for part in (30, 60):
        passage = fresh(160)
        rows = [(1, " ".join(fresh(40) + passage[50:50 + part] + fresh(40))), (2, " ".join(fresh(30) + passage + fresh(20))),
                (3, " ".join(fresh(60) + passage + fresh(45))), (4, " ".join(fresh(9) + passage[20:] + fresh(45)))]
        out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows)).collect()}
        assert out[3]["n_removed"] == 160 and out[4]["n_removed"] == 140 and not set(out[3]["text"].split()) & set(passage)


def test_blocks_between_blank_lines(spark):
    fresh = words(6)
    block = fresh(90)
    wrap = lambda x: "\n".join(" ".join(x[i:i + 9]) for i in range(0, len(x), 9))
    rows = []
    for i in range(4):
        p = list(block)
        for at in (0, 20, 44, 66):
            p[at] = p[at] if i == 0 or at != 20 * i else fresh(1)[0]
        rows.append((i, wrap(fresh(70)) + "\n\n" + wrap(p) + "\n\n" + wrap(fresh(60))))
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows), run=80).collect()}
    assert out[0]["n_removed"] == 0 and all(out[i]["n_removed"] == 90 for i in (1, 2, 3))


def runs_cut(rows, run):
    """Brute force: by row, which words lie in a run of ``run`` words that an earlier document holds."""
    order = sorted({(i is None, i or 0, t) for i, t in rows if t})
    first = {}
    for key in order:
        w = key[2].lower().split()
        for k in range(len(w) - run + 1):
            first.setdefault(tuple(w[k:k + run]), key)
    out = []
    for i, t in rows:
        w, gone = (t or "").lower().split(), set()
        for k in range(len(w) - run + 1):
            if first[tuple(w[k:k + run])][:2] != (i is None, i or 0) or first[tuple(w[k:k + run])][2] != t:
                gone |= set(range(k, k + run))
        out.append((i, t, len(gone)))
    return out


def test_passages_against_brute_force(spark, monkeypatch):
    """Runs of equal words of texts made of few passages, by shards, batches and shared runs of any size."""
    rnd = random.Random(12)
    fresh = words(12)
    pool = [fresh(rnd.randrange(4, 30)) for _ in range(12)]
    rows = [(i, " ".join(x for _ in range(rnd.randrange(1, 6)) for x in (rnd.choice(pool) if rnd.random() < 0.6 else fresh(9)))) for i in range(120)]
    rows += [(None, rows[3][1]), (None, rows[4][1] + " x"), (7, rows[9][1]), (500, ""), (501, None), (502, "la " * 40_000)]
    rows += [(600, " ".join(pool[0] + pool[1]))] * 20
    want = runs_cut(rows, 10)
    for gather, shard, many in ((S.GATHER, S.SHARD, S.MANY), (200, 100, 3)):
        monkeypatch.setattr(S, "GATHER", gather)
        monkeypatch.setattr(S, "SHARD", shard)
        monkeypatch.setattr(S, "MANY", many)
        monkeypatch.setattr(S, "GATHER_SHARD", 1)
        out = substring_dedup(frame(spark, rows), run=10, least=10**6)
        got = sorted(((r["doc_id"], r["text"], r["n_words"] and r["n_removed"]) for r in out.collect()), key=str)
        assert sorted((str(i), n) for i, _, n in want) == sorted((str(i), n or 0) for i, _, n in got)


def test_equal_rows_make_no_more_rows(spark):
    p = " ".join(words(4)(60))
    runs = S.equal_runs(frame(spark, [(1, 11, p), (2, 22, p)], "ord long, rid long, text string"))
    assert sum(r.count() for r in runs) <= S.SLICES
    out = substring_dedup(frame(spark, [(1, p)] + [(2, p)] * 20)).collect()
    assert sorted(r["n_removed"] for r in out) == [0] + [60] * 20 and {r["component_id"] for r in out} == {1}


def test_wrapped_block_beside_a_long_line(spark):
    fresh = words(15)
    block = fresh(90)
    wrap = lambda x: "\n".join(" ".join(x[i:i + 9]) for i in range(0, len(x), 9))
    changed = [*block[:40], *fresh(1), *block[41:]]
    rows = [(1, wrap(block) + "\n" + " ".join(fresh(60))), (2, " ".join(fresh(60)) + "\n" + wrap(changed))]
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows), run=80).collect()}
    assert out[1]["n_removed"] == 0 and out[2]["n_removed"] == 90


def test_components_join_all_alike_paragraphs(spark):
    """B is alike to A and to C, A and C are not: all three are one component."""
    fresh = words(16)
    a = fresh(200)
    b, c = list(a), list(a)
    for k in range(4):
        b[20 + k * 45] = c[20 + k * 45] = fresh(1)[0]
    for k in range(4):
        c[5 + k * 45] = fresh(1)[0]
    rows = [(1, " ".join(a)), (3, " ".join(b)), (2, " ".join(c)), (9, " ".join(fresh(100)))]
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows), run=150).collect()}
    assert [out[i]["component_id"] for i in (1, 2, 3, 9)] == [1, 1, 1, 9]
