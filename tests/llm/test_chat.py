import hashlib
import random
import time

from pyspark.sql import functions as F

from groundshift.llm import chat

PARTS = ["\\", "### User: ", "### Assistant: ", "</turn>", "\n", "### Role 41: ", " ", "x", "é😀", "###", "$1", "Role ", "### ", "\n</turn>\n", "\\\\"]


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(1)
    rows = []
    for c in range(200):
        for t in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", "tool", "", "USER", "a: b\n"])
            rows.append((c, t, role, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8))), 1))
    rows += [(900, 0, None, None, 1), (901, 0, "assistant", "### User: " * 20_000, 1), (None, None, "user", "a", 1), (None, 3, "assistant", "b", 1)]
    rows += [(902, 0, "user", "same", 1)] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat.formatted(df).select("conv_id", chat.parse(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("spans")).alias("m"))
    want = {}
    for c, t, role, text, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == set(want)
    for c, r in got.items():
        assert [tuple(x) for x in r.t] == want[c]
        assert r.m == "".join(text for role, text in want[c] if role == "assistant")


def test_time_grows_with_the_turns(spark):
    """One conversation of 100,000 turns with code points of all sizes."""
    text = F.concat(F.lit("é😀 </turn> "), F.col("id"))
    df = spark.range(100_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    began = time.time()
    row = chat.formatted(df).select(F.size(chat.parse(F.col("formatted"))).alias("n"), F.sha2(chat.masked_text(F.col("formatted"), F.col("spans")), 256).alias("m"), F.element_at("spans", -1).alias("s"), "formatted").first()
    assert time.time() - began < 60
    assert row.n == 100_000 and row.m == hashlib.sha256("".join(f"é😀 </turn> {i}" for i in range(1, 100_000, 2)).encode()).hexdigest()
    assert row.formatted[row.s.start :][: row.s.length] == row.formatted.encode()[row.s.octet :][: row.s.octets].decode() == "é😀 \\</turn> 99999"


def test_malformed_text_is_no_conversation(spark):
    texts = ["### User: a\n</turn>\nrest", "### User: a", "a\n</turn>\n", "### User: a\n</turn>\nb\n</turn>\n"]
    df = spark.createDataFrame([(t,) for t in texts], "f string")
    assert [r.p for r in df.select(chat.parse(F.col("f")).alias("p")).collect()] == [None] * 4


def test_empty_table_and_plan(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.formatted(df)
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
