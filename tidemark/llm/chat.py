r"""Chat formatting in budgeted windows, with a mask of the text to learn.

Template. A turn is `<turn>role<text>text</turn>`. In role and text a backslash becomes `\b` and `<` becomes
`\l`, so an unescaped text never holds a control string, and the way back is two replacements.

Windows. A turn costs its words plus 4 tokens. The first turn of a conversation is retained in every window
if its role is system. The others lie along the prefix sum of their tokens; with
`room = (budget - system - history) / 2`, at least 1, a window starts at the first turn, where the
prefix passes a multiple of room, and before and after a turn longer than room. A window so keeps within
the budget unless one turn alone, or the system turn, doesn't fit. Before its own turns a later window repeats
the system turn and the turns that start at most `history` tokens before it.

Mask. `loss` holds start and length, in code points, of the texts of the window's own assistant turns; repeated
turns are never in it, so each assistant text is learned once.

Cases. Null text and role count as empty. Turns go by number (null first), then role, then text; repeated rows are
separate turns. A turn of any length stays whole, in a window of its own if it has to. A conversation of a system turn alone is one
window. A null conv_id is a conversation.
Other columns are not read. An empty table gives no windows.

Plan. One exchange by conversation serves the prefix sums, the windows and the history, a range frame over
the prefix sum; the digest of the query needs whole conversations in a row by its definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import load, text_of, words_in

BUDGET, HISTORY, OVERHEAD = 512, 96, 4
TURN, TEXT, CLOSE = "<turn>", "<text>", "</turn>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def formatted(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, n_repeated (turns repeated at its start) and loss of every window."""
    talk = Window.partitionBy("conv_id")
    order = talk.orderBy("turn", "role", "body")
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("body")).withColumns(
        {"rank": F.row_number().over(order), "tokens": words_in(F.col("body")) + OVERHEAD}
    )
    system = (F.col("rank") == 1) & (F.col("role") == "system")
    shown = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT), escaped(F.col("body")), F.lit(CLOSE))
    head = F.lit(len(TURN + TEXT)) + F.char_length(escaped(F.col("role")))
    room = F.greatest(F.lit(1), F.floor((budget - F.col("kept_tokens") - history) / 2)).cast("bigint")
    inner = talk.orderBy("rank")
    rows = (
        rows.withColumns({
            "system": system,
            "cost": F.when(system, 0).otherwise(F.col("tokens")),
            "shown": shown,
            "head": head,
            "size": F.char_length(shown),
        })
        .withColumns({
            "kept_tokens": F.coalesce(F.max(F.when(F.col("system"), F.col("tokens"))).over(talk), F.lit(0)),
            "before": F.coalesce(F.sum("cost").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        })
        .withColumns({"room": room, "long": F.col("cost") > room})
        .withColumn("cell", F.floor(F.col("before") / F.col("room")))
        .withColumn(
            "first",
            (F.col("rank") == 1) | F.col("long") | F.lag("long").over(inner)
            | (F.col("cell") != F.lag("cell").over(inner)),
        )
        .withColumn("window", F.sum(F.col("first").cast("int")).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "past",
            F.collect_list(F.when(~F.col("system"), F.col("shown"))).over(talk.orderBy("before").rangeBetween(-history, -1)),
        )
        .withColumn("kept", F.max(F.when(F.col("system"), F.col("shown"))).over(talk))
        .withColumn(
            "offset",
            F.coalesce(F.sum("size").over(Window.partitionBy("conv_id", "window").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    loss = F.when(
        F.col("role") == "assistant",
        F.struct((F.col("offset") + F.col("head")).alias("start"), F.char_length(escaped(F.col("body"))).cast("bigint").alias("length")),
    )
    again = F.when(F.col("first") & (F.col("rank") > 1), F.concat(F.filter(F.array("kept"), lambda x: x.isNotNull()), F.col("past")))
    windows = rows.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("rank", "shown"))).alias("own"),
        F.array_sort(F.collect_list(loss)).alias("loss"),
        F.coalesce(F.first(again, ignorenulls=True), F.array().cast("array<string>")).alias("again"),
    )
    front = F.array_join("again", "")
    return windows.select(
        "conv_id", "window",
        F.concat(front, F.array_join(F.transform("own", lambda x: x["shown"]), "")).alias("text"),
        F.size("again").alias("n_repeated"),
        F.transform("loss", lambda x: F.struct((x["start"] + F.char_length(front)).alias("start"), x["length"].alias("length"))).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from the windows' texts and masks."""
    pattern = F.lit(f"{TURN}([^<]*){TEXT}([^<]*){CLOSE}")

    def group(number: int) -> Column:
        found = F.regexp_extract_all("text", pattern, F.lit(number))
        return F.slice(found, F.col("n_repeated") + 1, F.greatest(F.size(found), F.lit(1)))

    parsed = windows.select(
        "conv_id", "window", F.char_length("text").alias("chars"), F.size(group(1)).alias("n"),
        F.array_join(F.zip_with(group(1), group(2), lambda r, t: F.concat(unescaped(r), F.lit("\n"), unescaped(t), F.lit("\n"))), "").alias("turns"),
        F.array_join(
            F.transform("loss", lambda x: unescaped(F.substr("text", (x["start"] + 1).cast("int"), x["length"].cast("int")))), ""
        ).alias("learned"),
    )
    whole = parsed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "learned"))).alias("parts"),
        F.sum("n").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"),
    )
    turns = F.array_join(F.transform("parts", lambda x: x["turns"]), "")
    learned = F.array_join(F.transform("parts", lambda x: x["learned"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


TRAP = r"\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = load(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], turns.schema)
    return read_back(formatted(turns.unionByName(more)))


SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{TRAP}' UNION ALL SELECT -7, 1, 'assistant', '{TRAP}'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) AS rank,
         len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) + {OVERHEAD} AS tokens,
         {len(TURN + TEXT + CLOSE)} + length(role || body) + len(regexp_extract_all(role || body, '[<\\]')) AS size
  FROM turns),
marked AS (SELECT *, rank = 1 AND role = 'system' AS system FROM ranked),
costs AS (
  SELECT *, CASE WHEN system THEN 0 ELSE tokens END AS cost,
         coalesce(max(CASE WHEN system THEN tokens END) OVER (PARTITION BY conv_id), 0) AS kept_tokens,
         coalesce(max(CASE WHEN system THEN size END) OVER (PARTITION BY conv_id), 0) AS kept_size
  FROM marked),
placed AS (
  SELECT *, greatest(1, ({BUDGET - HISTORY} - kept_tokens) // 2) AS room,
         coalesce(sum(cost) OVER (PARTITION BY conv_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM costs),
cells AS (SELECT *, before // room AS cell, cost > room AS long FROM placed),
starts AS (
  SELECT *, rank = 1 OR long OR lag(long) OVER w OR cell <> lag(cell) OVER w AS first,
         coalesce(sum(CASE WHEN NOT system THEN size END) OVER (PARTITION BY conv_id ORDER BY before RANGE BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING), 0) AS past
  FROM cells WINDOW w AS (PARTITION BY conv_id ORDER BY rank)),
sums AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(coalesce(string_agg(role || chr(10) || body || chr(10), '' ORDER BY rank), '')) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN body END, '' ORDER BY rank), '') AS learned,
         sum(size + CASE WHEN first AND rank > 1 THEN past + kept_size ELSE 0 END)::BIGINT AS formatted_chars
  FROM starts GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learned)::BIGINT AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM sums
"""

QUERIES = {"op9_chat_format": op9_chat_format}
ORACLE_SQL = {"op9_chat_format": SQL}
