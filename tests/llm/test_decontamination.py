import re

from obralake.llm.decontamination import contamination, without_leaks

from .common import documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(rows, items):
    out = []
    for i, text in rows:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            m = min(10, len(v))
            for s in range(len(v) - m + 1 if m else 0):
                for p in range(len(w) - m + 1):
                    if w[p:p + m] == v[s:s + m]:
                        hit.update(range(p, p + m))
                        found.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def test_hits_match_brute_force(spark):
    items = [(1, prose(1, 30)), (2, prose(2, 12)), (3, "lone"), (4, "Über alles gut"), (5, prose(1, 30)), (6, None),
             (7, "..."), (8, "a a a a a a a a a a a a"), (10, "two words"), (None, prose(3, 11)), (2, prose(4, 15))]
    a = prose(1, 30).split()
    rows = [(1, "x " + " ".join(a[3:16]) + " y"), (2, " ".join(a[3:12])), (3, prose(9, 4) + " LONE. " + prose(9, 3)),
            (4, "über ALLES gut"), (5, "Über--alles, gut!"), (6, None), (7, ""), (8, "a " * 25), (9, "two, WORDS two"),
            (10, " ".join(a) + " z " + " ".join(a[10:25])), (10, " ".join(a) + " z " + " ".join(a[10:25])),
            (None, prose(3, 11)), (12, prose(4, 15)), (13, prose(50, 5000) + " " + " ".join(a[:10])),
            (14, " ".join(a[:9]) + " b " + a[9]), (15, prose(2, 12)[:-1])]
    bench = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, key string")
    got = contamination(documents(spark, rows, "key long, n string, item int"), bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=str) == brute(rows, items)
    clean = without_leaks(documents(spark, rows), bench).collect()
    assert sorted((r.doc_id for r in clean), key=str) == sorted((r[0] for r in brute(rows, items) if not r[4]), key=str)


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    docs = documents(spark, [(1, prose(1, 30))])
    assert contamination(documents(spark, []), bench).collect() == []
    assert [tuple(r) for r in contamination(docs, bench.limit(0)).collect()] == [(1, 30, 0, [], False)]
