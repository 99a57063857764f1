import hashlib

import duckdb
from llm_fixtures import SF
from pyspark.sql import functions as F

from roadlens.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string, ts string, example int"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain(rows):
    """conv_id -> contract values, from (conv_id, turn, role, text)"""
    out = {}
    for c in {r[0] for r in rows}:
        ts = sorted(((t is not None, t or 0, r or "", x or "") for d, t, r, x in rows if d == c))
        said = "".join(x for *_, r, x in ts if r == "assistant")
        out[c] = (len(ts), digest("".join(f"{r}\n{x}\n" for *_, r, x in ts)), len(said), digest(said))
    return out


def read(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_chat(df)).collect()}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(chat.OP7_SQL).df()
    got = queries.op7_chat_format(spark, SF).toPandas()
    key = lambda d: sorted(d[sorted(d.columns)].astype(str).values.tolist())
    assert sorted(want.columns) == sorted(got.columns)
    assert key(want) == key(got)
    assert -7 in set(got.conv_id)


def test_examples(spark):
    df = spark.createDataFrame(
        [(1, 0, "system", "be"), (1, 1, "user", "hi"), (1, 2, "assistant", "yo"), (1, 3, "user", "b"), (1, 4, "assistant", "c"), (1, 5, "user", "d")],
        "conv_id long, turn long, role string, text string",
    )
    ex = chat.format_chat(df).orderBy("example").collect()
    assert [e.formatted for e in ex] == [
        "<s>system\nbe</s><s>user\nhi</s><s>assistant\nyo</s>",
        "<s>system\nbe</s><s>user\nhi</s><s>assistant\nyo</s><s>user\nb</s><s>assistant\nc</s>",
        "<s>system\nbe</s><s>user\nhi</s><s>assistant\nyo</s><s>user\nb</s><s>assistant\nc</s><s>user\nd</s>",
    ]
    assert [e.formatted[e.loss_start : e.loss_start + e.loss_len] for e in ex] == ["yo", "c", ""]


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\s>", "\\", "\\\\", "<s></s><s", "[[INST]INST]", "</s\\>", "a\nb", "<</s>/s>", "", "\U0001f600</s>"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("e", chat.escape(F.col("t")))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r.u == r.t
        assert not any(m in r.e for m in chat.CONTROL)


def test_edges(spark):
    rows = [
        (1, 0, None, None), (1, None, "assistant", "first"), (2, 0, "a\nb\\", "x</s>"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"),
        (None, 1, "assistant", "z" * 200_000), (3, 1, "user", "only"), (4, 1, "assistant", "<s>user\nfake</s>"),
    ]
    df = spark.createDataFrame([(*r, "clash", 9) for r in rows], SCHEMA)
    assert read(df) == plain(rows)
    assert read(df.limit(0)) == {}


def test_no_python_in_the_plan(spark):
    plan = queries.op7_chat_format(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExternalRDD"))
