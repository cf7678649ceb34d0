import random

from plumbline.operators.parity import latency_gate


def p99(values):
    return sorted(values)[-(-99 * len(values) // 100) - 1]


def test_latency_gate_is_exact(spark):
    draw = random.Random(5)
    for sizes in ((20_000, 20_000), (1, 300), (100, 101), (99, 7)):
        old, new = ([round(draw.expovariate(1 / 50), 2) for _ in range(n)] for n in sizes)
        calls = spark.createDataFrame([("old", v) for v in old] + [("new", v) for v in new] + [("old", None), (None, 1e9)], "path string, ms double")
        # A coarse sketch moves the cuts, not the result.
        for accuracy in (100, 10_000):
            row = latency_gate(calls, "path", "ms", "old", "new", accuracy=accuracy).first()
            assert (row["old_p99"], row["new_p99"]) == (p99(old), p99(new))
            assert row["status"] == ("PASSED" if p99(new) < p99(old) * 1.1 else "FAILED")


def test_latency_gate_without_calls(spark):
    calls = spark.createDataFrame([("old", 3.0)], "path string, ms double")
    assert latency_gate(calls, "path", "ms", "old", "new").collect() == [(3.0, None, "FAILED")]
    assert latency_gate(calls.filter("false"), "path", "ms", "old", "new").collect() == [(None, None, "FAILED")]
