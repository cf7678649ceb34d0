import math
import re
import time
from collections import Counter

from plumbline.llm.license_scan import BASE, NEED, RARE, TEMPLATES, scan_licenses

SCHEMA = "doc_id long, text string, w string"


def brute_force(rows):
    """The same by going through every word of every text."""
    split = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for _, t in rows]
    df = Counter(w for ws in split for w in set(ws))
    idf = lambda w: math.log((len(rows) + 1) / (df[w] + 1)) + 1e-3
    out = []
    for (i, _), ws in zip(rows, split):
        base = [(p, label) for phrase, label in BASE for p in range(len(ws)) if ws[p:p + len(phrase.split())] == phrase.split()]
        held = []
        for label, notice, key in TEMPLATES:
            n, k = notice.split(), key.split()
            rare = sorted(set(k), key=lambda w: (-idf(w), w))[:RARE]
            at = next(j for j in range(len(n)) if n[j:j + len(k)] == k)
            word = lambda j: ws[j] if 0 <= j < len(ws) else None
            for o in range(-len(n), len(ws)):
                if sum(word(o + at + k.index(r)) == r for r in rare) >= min(NEED, len(rare)) and ws[max(0, o + at):max(0, o + at + len(k))] == k:
                    held.append((label, sum(idf(w) for j, w in enumerate(n) if word(o + j) == w) / sum(map(idf, n))))
        out.append((i, len(ws), len(base), min((p for p, _ in base), default=None), max((p for p, _ in base), default=None),
                    ",".join(sorted({x for _, x in base})), ",".join(sorted({x for _, x in base} | {x for x, _ in held})),
                    round(max((s for _, s in held), default=0.0), 9)))
    return out


def found(df):
    return [(*list(r)[:-1], round(r["score"], 9)) for r in scan_licenses(df).collect()]


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = found(docs)
    assert sorted(got) == sorted(brute_force(rows))
    assert any(r[2] for r in got)


def test_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "MIT License, mit-license; MIT\nLICENSE"), (4, "the Apache license apache license"),
        (5, "GENERAL PUBLIC LICENSE"), (6, "Redistribution and use in source and binary forms, with or without modification, are allowed"),
        (7, "Redistribution and some use in source and binary forms"), (8, "Licensed under CC BY-NC 4.0."), (9, "public license general"),
        (10, "mit license " * 3000), (11, "apache licen\u017fe mit wor\u212a the apache licen\u212ae"), (3, "MIT License, mit-license; MIT\nLICENSE"),
        (12, "charge to any person: permission is hereby granted free of charge to any person obtaining a copy"), (None, "MIT license"),
    ]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = found(df)
    assert sorted(got, key=str) == sorted(brute_force(rows), key=str)
    by_id = {r[0]: r for r in got}
    assert by_id[3][2:7] == (3, 0, 4, "mit", "mit") and by_id[4][2] == 1 and by_id[10][2] == 3000
    assert by_id[6][6] == "bsd" and by_id[7][6] == "" and by_id[8][6] == "cc-by-nc" and by_id[12][6] == "mit"
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_texts_take_time_in_proportion(spark):
    """A megabyte that is nothing but hits, and one that proposes many templates that do not hold."""
    rows = [(1, "mit license " * 90_000), (2, "general public mit license to any person obtaining " * 20_000), (3, "short")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    began = time.time()
    got = {r["doc_id"]: r for r in scan_licenses(docs).collect()}
    assert time.time() - began < 60
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["labels"]) == (90_000, 0, 179_998, "mit")
    assert (got[2]["n_base"], got[2]["last_word"], got[3]["n_base"], got[3]["labels"]) == (20_000, 159_994, 0, "")
