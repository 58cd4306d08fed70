"""The registered queries on the given tables, each next to its SQL counterpart where it has one."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marram.llm import (
    alignment,
    caps,
    chat,
    contamination,
    language,
    language_model,
    mixing,
    parsing,
    quality,
    ranking,
    secrets,
    simhash,
    spans,
)
from marram.llm.common import count_tokens, remainder, stored
from marram.sources.tables import read_table

# Conversations are logged as deltas of at most so many characters.
DELTA_CHARS = 200
# Where the driver finds the vocabulary files of public tokenizers.
TOKENIZERS = Path(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"))


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination.contamination(
        read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    labels = read_table(spark, sf, "labels").where(remainder(F.col("doc_id")) != 0)
    scored = quality.with_score(docs, quality.train(docs, labels))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "lang")
    filters = language.train(docs.where(remainder(F.col("doc_id")) != 0))
    return language.with_language(docs, filters).select(
        "doc_id",
        (remainder(F.col("doc_id")) == 0).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op4_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return caps.near_vectors(read_table(spark, sf, "embeddings"))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log from which a fold gives back the rows of conversations, numbered through each conversation.

    A row is written as a message and deltas. Of every three, by hash, one is
    written in its last form at once; one first as a draft that is regenerated
    before the next turn; and one as a draft that is edited after the last
    turn. One more turn at the end is written and deleted.
    """
    more = conversations.sparkSession.createDataFrame(
        [(-7, n, role, "\\### Assistant: </turn> ok") for n, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(more)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.withColumns(
        {
            "turn": F.row_number().over(order).cast("bigint"),
            "turns": F.count(F.lit(1)).over(Window.partitionBy("conv_id")),
        }
    )
    turn, turns, text = F.col("turn"), F.col("turns"), F.coalesce("text", F.lit(""))
    draft = F.concat(F.reverse(text), F.lit(" draft"))

    def version(of, at, kind: str, written):
        return F.struct(of.alias("turn"), at.alias("at"), F.lit(kind).alias("kind"), written.alias("text"))

    first, again, late = 2 * turn, 2 * turn + 1, 2 * (turns + turn)
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))
    versions = (
        F.when(style == 0, F.array(version(turn, first, "message", text)))
        .when(style == 1, F.array(version(turn, first, "message", draft), version(turn, again, "regenerate", text)))
        .otherwise(F.array(version(turn, first, "message", draft), version(turn, late, "edit", text)))
    )
    end = 4 * turns + 2
    withdrawn = F.array(
        version(turns + 1, end, "message", F.lit("withdrawn")), version(turns + 1, end + 1, "delete", F.lit(""))
    )
    versions = F.when(turn == 1, F.concat(versions, withdrawn)).otherwise(versions)
    written = numbered.select("conv_id", "role", F.explode(versions).alias("v")).select("conv_id", "role", "v.*")
    parts = F.sequence(F.lit(0), F.floor(F.char_length("text") / DELTA_CHARS).cast("int"))
    return written.withColumn("part", F.explode(parts)).select(
        "conv_id",
        "turn",
        (F.shiftleft("at", 32) + F.col("part")).alias("seq"),
        F.when(F.col("part") == 0, F.col("kind")).otherwise("delta").alias("kind"),
        "role",
        F.substr("text", F.col("part") * DELTA_CHARS + 1, F.lit(DELTA_CHARS)).alias("text"),
    )


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    out = chat.format_log(conversation_events(read_table(spark, sf, "conversations")))
    read = out.select(
        F.col("conv").alias("conv_id"),
        "formatted",
        chat.read_back(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op6_spans(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return spans.without_repeats(docs)


def op7_language_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id")) == 1
    model, counts = language_model.train(docs.where(~held_out))
    return language_model.score(docs, model, counts).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id"
    )


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    slim = stored(docs.select("doc_id", "source", count_tokens(F.col("text")).alias("size")), "slim")
    return mixing.mix(slim).select("doc_id", "size", "source_size", "target", "taken")


def op10_secrets(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    # The table comes in two parts, as a history grows: what the ledger of the
    # first part holds is not scanned again, its findings are taken over.
    later = remainder(F.col("doc_id")) == 0
    findings, scanned = secrets.scan(docs.where(~later))
    findings, _ = secrets.scan(docs.where(later), scanned=stored(scanned, "ledger"), findings=findings)
    found = secrets.attach(docs, findings)

    def counted(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["place"] < 3)
    return found.select(
        "doc_id",
        *[counted(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"),
    )


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    a, b = ((TOKENIZERS / name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.alignment(read_table(spark, sf, "documents"), a, b)


def op12_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    return parsing.without_repeats(read_table(spark, sf, "documents")).drop("removed")


def op13_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_documents(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_language": op3_language,
    "op4_embeddings": op4_embeddings,
    "op5_chat": op5_chat,
    "op6_spans": op6_spans,
    "op7_language_model": op7_language_model,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_secrets": op10_secrets,
    "op11_alignment": op11_alignment,
    "op12_suffixes": op12_suffixes,
    "op13_ranking": op13_ranking,
}

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TERMS = "regexp_extract_all(" + _LOWERED + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_CONTROL = "replace(replace(replace({}, '\\', '\\\\'), '</turn>', '<\\/turn>'), '<turn', '<\\turn')"


def _span_sql() -> str:
    """Spans of every rule: lengths of matches and of the texts between them, summed up."""
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.pattern.replace("'", "''")
        parts.append(f"""
        SELECT doc_id, '{rule.kind}' AS kind, {place} AS place, i,
               length(found[i]) AS len, length(gaps[i]) AS gap,
               length(regexp_extract(found[i], '{pattern}', {rule.group})) >= {rule.least} AS keep
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found,
                     string_split_regex(text, '{pattern}') AS gaps
              FROM docs WHERE regexp_matches(text, '{pattern}')) AS t, range(1, len(found) + 1) AS r(i)""")
    return " UNION ALL ".join(parts)


ORACLE = {
    "op1_decontamination": f"""
    WITH iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
    win AS (SELECT DISTINCT item, array_to_string(w[i:i + 12], ' ') AS phrase, len(w[i:i + 12]) AS n
            FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM iw WHERE len(w) > 0)),
    dw AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
    grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
              FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                    FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
    hits AS (SELECT g.doc_id, g.i, g.n, win.item FROM grams g JOIN win ON g.phrase = win.phrase AND g.n = win.n),
    places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)),
    nh AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
    ni AS (SELECT doc_id, count(DISTINCT item) AS n_items,
                  sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS s FROM hits GROUP BY doc_id)
    SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(s, sha256('')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM dw LEFT JOIN nh ON dw.doc_id = nh.doc_id LEFT JOIN ni ON dw.doc_id = ni.doc_id
    """,
    "op5_chat": f"""
    WITH rows_ AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum({len(chat.HEAD) + len(chat.AFTER_ROLE) + len(chat.FOOT)}
               + length(replace({_CONTROL.format("role")}, chr(10), '\\' || chr(10)))
               + length({_CONTROL.format("text")}))::BIGINT AS formatted_chars
    FROM rows_ GROUP BY conv_id
    """,
    "op9_mixing": """
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
               FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS z, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
          FROM d GROUP BY source),
    r AS (SELECT *, row_number() OVER (ORDER BY z * 2.0::DOUBLE / w, source NULLS LAST) AS k FROM s),
    c AS (SELECT *, (1.5::DOUBLE * sum(z) OVER () - 2.0::DOUBLE * coalesce(sum(z) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam FROM r),
    l AS (SELECT min_by(lam, k) AS lam FROM c WHERE z * 2.0::DOUBLE > w * lam),
    t AS (SELECT source, z, CASE WHEN l.lam IS NULL THEN z * 2.0::DOUBLE ELSE least(z * 2.0::DOUBLE, w * l.lam) END AS target
          FROM s, l),
    b AS (SELECT *, floor(target)::BIGINT AS budget FROM t),
    p AS (SELECT d.doc_id, d.size, b.z, b.target, b.budget,
                 CASE WHEN b.z > 0 THEN b.budget // b.z ELSE 0 END AS epochs,
                 sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.size) - d.size AS start
          FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
    SELECT doc_id, size, z AS source_size, target,
           (epochs * size + greatest(0, least(size, budget - epochs * z - start)))::BIGINT AS taken
    FROM p
    """,
    "op10_secrets": f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    each AS ({_span_sql()}),
    placed AS (SELECT *, sum(gap + len) OVER (PARTITION BY doc_id, kind ORDER BY i) AS fin FROM each),
    spans AS (SELECT doc_id, kind, place, fin - len AS start, kind || ':' || (fin - len) || ':' || fin AS span
              FROM placed WHERE keep),
    g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(span, ',' ORDER BY start, place) FILTER (place < 3) AS base,
                 string_agg(span, ',' ORDER BY start, place) AS spans FROM spans GROUP BY doc_id)
    SELECT docs.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN g ON docs.doc_id = g.doc_id
    """,
    "op13_ranking": f"""
    WITH dw AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS.format("coalesce(text, '')")} AS w FROM documents),
    size AS (SELECT r, doc_id, len(w)::HUGEINT AS n FROM dw WHERE len(w) > 0),
    total AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS terms FROM size),
    asked AS (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark),
    iw AS (SELECT item_id, text, unnest({_TERMS.format("text")}) AS term FROM asked),
    it AS (SELECT item_id, text, term, count(*) AS k FROM iw GROUP BY ALL),
    tf AS (SELECT r, term, count(*)::HUGEINT AS tf FROM (SELECT r, unnest(w) AS term FROM dw)
           WHERE term IN (SELECT term FROM it) GROUP BY ALL),
    wt AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::HUGEINT AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
    imp AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)) AS v
            FROM tf JOIN size USING (r), total),
    sc AS (SELECT item_id, text, r, doc_id, sum(k * w * v)::BIGINT AS score
           FROM it JOIN wt USING (term) JOIN imp USING (term) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
               FROM sc WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {ranking.TOP}
    """,
}
