import random
import re
import time

from plumbline.llm.decontaminate import benchmark_overlaps, decontaminate

DOCS = "doc_id long, text string, item_id long, equal_words string"
ITEMS = "item_id long, text string, doc_id long"


def sentence(draw, n):
    return [f"v{draw.randrange(500)}" for _ in range(n)]


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def holds(doc, item, share=0.8, stretch=13):
    """Brute force: the item laid over the document at every place; most of its words stand there, or those of a stretch do."""
    for start in range(-len(item) + 1, len(doc)):
        same = [0 <= start + k < len(doc) and doc[start + k] == w for k, w in enumerate(item)]
        if sum(same) >= share * len(item) - 1e-9:
            return True
        inside = [s for k, s in enumerate(same) if 0 <= start + k < len(doc)]
        total = [0]
        for s in inside:
            total.append(total[-1] + s)
        if any(total[j] - total[i] >= share * (j - i) - 1e-9 for i in range(len(inside)) for j in range(i + stretch, len(inside) + 1)):
            return True
    return False


def cases():
    """Documents with passages whole, with a word in five replaced, with two in five replaced, and with half of one."""
    draw = random.Random(8)
    items = [sentence(draw, n) for n in (7, 10, 14, 20, 30, 59, 12, 25)]
    rows, dirty = [], set()
    for k, item in enumerate(items):
        for share in (0, 0.1, 0.2, 0.4, 0.5):
            copy = list(item)
            n = int(len(item) * share) if share else 0
            for at in draw.sample(range(len(item)), n):
                copy[at] = "other"
            i = len(rows)
            text = " ".join(sentence(draw, 60)) + ".\n" + ", ".join(copy).upper() + "! " + " ".join(sentence(draw, draw.randrange(50)))
            rows.append((i, text))
            if holds(words_of(text), item):
                dirty.add(i)
        if len(item) // 2 >= 13:
            dirty.add(len(rows))
        rows.append((len(rows), " ".join(sentence(draw, 9) + item[:len(item) // 2])))
    return rows, [(k, " ".join(x)) for k, x in enumerate(items)], dirty


def test_passages_are_found_and_others_left(spark):
    rows, items, dirty = cases()
    rows += [(900, None), (901, ""), (902, items[4][1]), (902, items[4][1]), (903, "a b c"), (904, "x " * 200_000 + items[5][1])]
    dirty |= {902, 904}
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS).repartition(3)
    bench = spark.createDataFrame([(k, t, 1) for k, t in [*items, (70, None), (71, ""), (72, "a b c"), (None, items[4][1])]], ITEMS)
    for words in (1 << 18, 40):
        got = benchmark_overlaps(docs, bench, block_words=words).collect()
        assert {r["doc_id"] for r in got} == dirty
        assert {(r["item_id"], r["equal_words"], r["item_words"], r["place"]) for r in got if r["doc_id"] == 902} == {(4, 30, 30, 0), (-1, 30, 30, 0)}
        kept = decontaminate(docs, bench, block_words=words)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in dirty)


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c d e f g", 1, "x")], DOCS), spark.createDataFrame([(1, "a b c d e f g", 1)], ITEMS)
    assert benchmark_overlaps(docs, bench).count() == 1
    assert benchmark_overlaps(docs.limit(0), bench).collect() == [] and decontaminate(docs, bench.limit(0)).count() == 1


def test_words_left_out_or_added_and_long_stretches(spark):
    draw = random.Random(4)
    items = [sentence(draw, n) for n in (12, 30, 59)]
    rows = []
    for k, item in enumerate(items):
        half = len(item) // 2
        copies = [item[:half] + item[half + 1:], item[:half] + ["more"] + item[half:], item[:half] + item[half + len(item) // 6:],
                  item[:half] + sentence(draw, 5) + item[half:], item[:4] + ["a"] + item[4:half + 2] + item[half + 3:]][:4 if k == 0 else 5]
        rows += [(10 * k + i, k, len(item) - (1, 0, len(item) // 6, 0, 1)[i], copy) for i, copy in enumerate(copies)]
    # 40 words of 59, and as many with one in five replaced.
    part = items[2][10:50]
    rows += [(90, 2, 40, part), (91, 2, 32, [w if i % 5 else "other" for i, w in enumerate(part)])]
    docs = spark.createDataFrame([(i, " ".join(sentence(draw, 40) + copy + sentence(draw, 30)), 1, "x") for i, _, _, copy in rows], DOCS)
    bench = spark.createDataFrame([(k, " ".join(x), 1) for k, x in enumerate(items)], ITEMS)
    got = {(r["doc_id"], r["item_id"]): (r["equal_words"], r["place"]) for r in benchmark_overlaps(docs, bench).collect()}
    assert got.keys() == {(i, k) for i, k, _, _ in rows}
    assert {i: got[i, k] for i, k, _, _ in rows} == {i: (n, 30 if i >= 90 else 40) for i, _, n, _ in rows}
    assert decontaminate(docs, bench).count() == 0


def test_quotes_of_every_length_at_every_end(spark):
    """Documents that begin or end inside a passage, or hold n words of it: found from 13 words on, whatever stands around them."""
    draw = random.Random(12)
    items = [sentence(draw, n) for n in (59, 30, 14)]
    rows, want = [], set()
    for k, item in enumerate(items):
        for n in range(5, len(item) + 1):
            for around in (0, 1, 2, 3):
                for part in (item[:n], item[-n:], item[(len(item) - n) // 2:][:n]):
                    text = sentence(draw, 20) * (around & 1) + part + sentence(draw, 20) * (around >> 1)
                    if n >= 0.8 * len(item) or n >= 13:
                        want.add((len(rows), k))
                    elif holds(text, item):
                        want.add((len(rows), k))
                    rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(k, " ".join(x), 1) for k, x in enumerate(items)], ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in benchmark_overlaps(docs, bench).collect()} == want


def test_equals_brute_force_aligner(spark):
    draw = random.Random(21)
    items = [sentence(draw, n) for n in (7, 12, 15, 24, 40)]
    rows = []
    for i in range(400):
        item = draw.choice(items)
        n = draw.randrange(1, len(item) + 1)
        at = draw.randrange(len(item) - n + 1)
        part = [w if draw.random() > draw.choice((0, 0.1, 0.2, 0.3)) else "other" for w in item[at:at + n]]
        rows.append((i, sentence(draw, draw.randrange(12)) + part + sentence(draw, draw.randrange(12))))
    want = {(i, k) for i, doc in rows for k, item in enumerate(items) if holds(doc, item)}
    docs = spark.createDataFrame([(i, " ".join(t), 1, "x") for i, t in rows], DOCS).repartition(4)
    bench = spark.createDataFrame([(k, " ".join(x), 1) for k, x in enumerate(items)], ITEMS)
    got = {(r["doc_id"], r["item_id"]) for r in benchmark_overlaps(docs, bench).collect()}
    assert got == want and 100 < len(want) < 400


def test_long_items_in_long_repetitive_documents(spark):
    """The work is in proportion to the document and the passage, and a very long passage is put together from parts."""
    draw = random.Random(2)
    item = [f"r{draw.randrange(9)}" for _ in range(1600)]
    long = sentence(draw, 1600)
    gaps = [w for k, w in enumerate(long) if k % 9]
    texts = [[f"r{draw.randrange(9)}" for _ in range(20_000)], sentence(draw, 50) + gaps + sentence(draw, 50), long[:800] + ["more"] * 3 + long[800:], sentence(draw, 3000)]
    docs = spark.createDataFrame([(i, " ".join(t), 1, "x") for i, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(0, " ".join(item), 1), (1, " ".join(long), 1)], ITEMS)
    began = time.time()
    got = {(r["doc_id"], r["item_id"]): r["equal_words"] for r in benchmark_overlaps(docs, bench).collect()}
    assert got[1, 1] == len(gaps) and got[2, 1] == 1600 and (3, 1) not in got
    assert time.time() - began < 60
