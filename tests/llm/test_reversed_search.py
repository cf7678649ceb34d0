import math
import random
import re
from collections import Counter

from plumbline.llm.reversed_search import best_documents

DOCS = "doc_id long, text string, item_id long, score string, task long"
ITEMS = "item_id long, text string, doc_id long, block string"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_force(docs, items, k=20):
    split = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in split]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, c in split for t in c)
    out = Counter()
    for item, text in set(items):
        found = []
        for (i, c), n in zip(split, lengths):
            score = 0
            for t, times in Counter(terms(text)).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * ((10**9 * c[t]) // (1000 * c[t] + 12 * (100 - 25 + 25 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, i is None, i or 0))
        for rank, (score, unnamed, i) in enumerate(sorted(found)[:k], 1):
            out[item, rank, None if unnamed else i, -score] += 1
    return out


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], DOCS).repartition(5)
    b = spark.createDataFrame([(i, t, 1, "y") for i, t in items], ITEMS)
    return Counter(tuple(r) for r in best_documents(d, b, **options).collect())


def cases():
    draw = random.Random(9)
    word = lambda: f"w{int(draw.paretovariate(0.7)) % 400}"
    docs = [(i, " ".join(word().upper() if draw.random() < 0.2 else word() for _ in range(draw.randrange(80)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)]
    docs += [(2000, None), (2001, ""), (2002, "- !"), (None, docs[7][1]), (None, docs[7][1]), (7, docs[7][1]), (2003, "été ÉTÉ naïve w1 K"), (2004, "w5 " * 200_000)]
    items = [(k, " ".join(word() for _ in range(draw.randrange(1, 40)))) for k in range(30)]
    items += [(50, docs[7][1]), (51, None), (52, ""), (53, "nothing-here"), (54, "ÉTÉ w1 w1 w1"), (55, "W1, w2; w5_w5"), (0, "w3 w4"), (3, items[3][1]), (None, "w9 w8")]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = cases()
    want = brute_force(docs, items)
    assert found(spark, docs, items) == want
    assert found(spark, docs, items, block_terms=60) == want
    assert found(spark, docs, items, k=3) == brute_force(docs, items, 3)
    by_item = [r for r in want if r[0] == 50]
    assert len(by_item) == 20 and [r[2] for r in sorted(by_item, key=lambda r: r[1])][:3] == [7, 7, 1000]


def test_empty_tables(spark):
    docs, items = cases()
    assert not found(spark, [], items[:3]) and not found(spark, docs[:3], []) and not found(spark, docs[:3], [(1, None), (2, "?")])
