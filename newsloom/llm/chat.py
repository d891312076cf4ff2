"""Chat formatting: turns of a conversation become one marked-up string with a
loss mask, and are read back from it. Spark expressions only.

The template writes a message as ``### <role>: <text></turn>`` and a line end.
Adjacent turns of one role share a message; a joint marks where one turn ended.
Inside texts and roles the control strings are replaced by two-character codes,
so that no text can be read as markup and every text comes back unchanged.

Defined cases: a null text or role is the empty string; equal turn numbers are
ordered by role, then text; a null turn number comes first; repeated rows are
turns of their own; rows with a null conversation id form one conversation; an
empty table gives no rows; further columns are ignored.

A conversation is one row of the result, so its turns meet in one task by
definition; the arrays are walked once and never copied turn by turn.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template and the codes that stand for them in a text.
# The backslash comes first when writing and last when reading.
OPEN, CLOSE, JOINT = "### ", "</turn>", "\\m"
CODES = [("\\", "\\s"), (CLOSE, "\\e"), ("###", "\\h")]
ROLE_END = ": "
ROLE_CODE = (":", "\\c")


def escape(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(ROLE_CODE[0]), F.lit(ROLE_CODE[1]))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ROLE_CODE[1]), F.lit(ROLE_CODE[0])))


def format_chats(turns: DataFrame, conv="conv_id", turn="turn", role="role", text="text",
                 learned="assistant") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted`` and ``pieces``.

    ``pieces`` are the consecutive parts of ``formatted`` with the flag ``loss``:
    true for the (escaped) texts of the ``learned`` role, which a model is
    trained on, and for nothing else.
    """
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = rows.groupBy("_conv").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    n = F.size("ts")
    nobody = F.array(F.lit(None).cast("string"))
    roles = F.transform("ts", lambda t: t["role"])
    chats = chats.select(
        "_conv", "ts",
        F.concat(nobody, F.slice(roles, F.lit(1), n - 1)).alias("before"),
        F.concat(F.slice(roles, F.lit(2), n), nobody).alias("after"),
    )
    # arrays_zip walks the three arrays together: no look-up by position
    around = F.arrays_zip("ts", "before", "after")

    def pieces(x):
        t = x["ts"]
        head = F.when(x["before"].eqNullSafe(t["role"]), F.lit(JOINT)).otherwise(
            F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit(ROLE_END))
        )
        tail = F.when(x["after"].eqNullSafe(t["role"]), F.lit("")).otherwise(F.lit(CLOSE + "\n"))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), (t["role"] == learned).alias("loss")),
            F.struct(tail.alias("text"), F.lit(False).alias("loss")),
        )

    out = chats.select("_conv", F.flatten(F.transform(around, pieces)).alias("pieces"))
    return out.select(
        F.col("_conv").alias(conv),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        "pieces",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    messages = F.split(formatted, CLOSE + "\n")
    messages = F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))

    def turns(message):
        body = F.substr(message, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, ROLE_END, 1)
        texts = F.split(F.substr(body, F.length(role) + len(ROLE_END) + 1), "\\\\m")
        return F.transform(
            texts, lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(messages, turns))


def loss_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing in between."""
    kept = F.filter(pieces, lambda p: p["loss"])
    return F.array_join(F.transform(kept, lambda p: unescape(p["text"])), "")


def digest(chats: DataFrame, conv="conv_id") -> DataFrame:
    """What the formatted conversations say when they are read back."""
    read = chats.select(
        F.col(conv), "formatted", read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("pieces")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        F.col(conv),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


ADDED = "\\### Assistant: </turn> ok"


def query(spark, sf_dir) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(ADDED).alias("text"),
    )
    return digest(format_chats(table.unionByName(extra)))


# formatted_chars: each text grows by one character per backslash, shrinks by
# five per </turn> and by one per ###; each run of one role adds its markers.
ORACLE = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), coded as (
  select *, replace(replace(replace(text, '\', '\s'), '</turn>', '\e'), '###', '\h') as code,
    row_number() over w as pos,
    coalesce(lag(role) over w = role, false) as joined
  from turns window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(code) + case when joined then 2 else
    length(replace(replace(replace(replace(role, '\', '\s'), '</turn>', '\e'), '###', '\h'), ':', '\c')) + 14 end)
    as bigint) as formatted_chars
from coded group by conv_id
"""
