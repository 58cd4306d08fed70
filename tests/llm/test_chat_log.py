"""The log that the chat query folds, against the rows it was made of."""

from pyspark.sql import functions as F

from marram.llm import chat
from marram.llm.queries import DELTA_CHARS, conversation_events

SF_DIR = "/root/testdata/sf0.001"


def test_the_log_has_all_kinds_and_folds_back_to_the_rows(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    odd = [(-1, 5, None, None), (-1, 6, "user", "a" * (3 * DELTA_CHARS)), (-1, 6, "user", ""), (-2, None, "assistant", "<turn \\ </turn>")]
    rows = rows.select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(odd, rows.select("conv_id", "turn", "role", "text").schema)
    )
    log = conversation_events(rows).cache()
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate", "delete"}
    # One number an event, and edits come behind later turns.
    assert log.groupBy("conv_id", "seq").count().where("count > 1").count() == 0
    edits = log.where("kind = 'edit'").alias("e").join(log.alias("l"), "conv_id").where("l.turn > e.turn AND l.seq < e.seq")
    assert edits.limit(1).count() == 1
    folded = chat.fold_events(log.repartition(5)).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("m")
    )
    found = {r.conv: [(m.role, m.text) for m in r.m] for r in folded.collect()}
    expected = {-7: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]}
    low = lambda v: (v is not None, v)
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, low(r.turn), low(r.role), low(r.text))):
        expected.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    log.unpersist()
    assert found == expected


def test_a_long_text_comes_back_from_its_deltas(spark):
    text = "".join(f"{i} </turn> \\ é " for i in range(60_000))
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    out = chat.format_log(conversation_events(rows)).where("conv = 1")
    read = out.select(chat.read_back(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("spans")).alias("loss")).first()
    assert [t.text for t in read.t] == ["q", text] and read.loss == text
