"""N-gram Jaccard join against all pairs."""
import random
import re

from llm_support import SF, UPPER, frame

from tickscan.llm.ngram_jaccard import keep_first, ngram_jaccard_join


def brute(rows, k=4, percent=85):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(UPPER))
        sets.append((i, frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and sets[a][0] is not None and sets[b][0] is not None and 100 * len(x & y) >= percent * len(x | y):
                parent[find(a)] = find(b)
    comp = {}
    for a, (i, s) in enumerate(sets):
        if s and i is not None:
            comp[find(a)] = min(comp.get(find(a), i), i)
    return sorted(((i, len(s), comp[find(a)] if s and i is not None else i) for a, (i, s) in enumerate(sets)), key=str)


def got(spark, rows):
    out = ngram_jaccard_join(frame(spark, rows))
    return sorted(((r[0], r[1], r[2]) for r in out.collect()), key=str)


def corpus(seed=1):
    """Copies, chains of edits, a large group of copies near the threshold, a widespread passage."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows, n = [], 0

    def add(words):
        nonlocal n
        n += 1
        rows.append((n, " ".join(words)))

    base = [word() for _ in range(120)]
    for _ in range(60):  # far below to just above the threshold with one another
        w = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 6))):
            w[rnd.randrange(120)] = word()
        add(w)
    chain = [word() for _ in range(200)]
    for _ in range(12):  # each like the one before only
        chain = list(chain)
        for _ in range(3):
            chain[rnd.randrange(200)] = word()
        add(chain)
    passage = [word() for _ in range(40)]
    for _ in range(40):
        add([word() for _ in range(rnd.randrange(5, 60))] + passage + [word() for _ in range(rnd.randrange(5, 60))])
    for _ in range(30):
        add([word() for _ in range(rnd.randrange(1, 40))])
    rows += [(n + 1 + i, rows[i][1].upper()) for i in range(10)]
    return rows


def test_all_pairs(spark):
    rows = corpus()
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b c"), (7, "a b c d e f"), (None, "a b c d e f"),
            (8, "a b c d e f"), (8, "a b c d e f"), (9, "É b c d"), (10, "é b c d"),
            (11, " ".join(f"a{i}" for i in range(60))), (11, " ".join(f"b{i}" for i in range(60))), (12, " ".join(f"b{i}" for i in range(59)))]
    assert got(spark, rows) == brute(rows)
    assert ngram_jaccard_join(frame(spark, [])).collect() == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5, "x"), (2, "a b c d e", 6, "y")], "doc_id long, text string, cls long, id string")
    assert sorted(tuple(r) for r in keep_first(df).collect()) == [(1, "a b c d e", 5, "x")]


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(((r[0], r[1], r[2]) for r in ngram_jaccard_join(docs).collect()), key=str) == brute(rows)
