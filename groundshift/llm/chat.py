r"""Chat formatting that is proven by reading it back.

A turn is rendered as a header, its text and a closing mark::

    ### Assistant: text
    </turn>

with the headers ``### System: ``, ``### User: ``, ``### Assistant: `` and, for
any other role, ``### Role <hex of the role>: ``. The parser is deterministic: a
header or ``</turn>`` not preceded by a backslash is a mark, one preceded by
backslashes is text and loses one of them. Every turn is rendered plainly,
parsed, and compared with its source; if they differ, a backslash is put before
every mark in the text and it is rendered, parsed and compared again. After that
whole conversations are compared, and a difference stops the job.

All of this is DataFrame expressions: no Python touches a row.

Turns are ordered by turn number (nulls first), then role, then text; repeated
rows are repeated turns. A null text is empty, a null role is the empty role,
rows of null conversation id are one conversation. An empty table gives no rows.
A conversation is one record, so it is held whole in one task, whatever its
length; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CLOSE = "</turn>"
END = f"\n{CLOSE}\n"
NAMED = {"system": "System", "user": "User", "assistant": "Assistant"}
HEADER = r"### (?:System|User|Assistant|Role [0-9A-F]*): "
MARK = f"(?:{HEADER}|{CLOSE})"
#: Where the parser cuts: before a header that no backslash precedes.
CUT = rf"(?<!\\)(?={HEADER})"
TURN = rf"(?s)\A{HEADER}(.*)\n{CLOSE}\n\z"
PLAIN_CLOSE = rf"(?<!\\){CLOSE}"


def header(role: Column) -> Column:
    out = F.concat(F.lit("### Role "), F.hex(F.encode(role, "utf-8")), F.lit(": "))
    for name, shown in NAMED.items():
        out = F.when(role == name, F.lit(f"### {shown}: ")).otherwise(out)
    return out


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"({MARK})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\({MARK})", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(header(role), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns ``(role, text)`` of rendered text; null where it is not well formed."""
    pieces = F.when(formatted == "", F.array().cast("array<string>")).otherwise(F.split(formatted, CUT))

    def turn(piece: Column) -> Column:
        body = F.regexp_extract(piece, TURN, 1)
        name = F.regexp_extract(piece, r"\A### (System|User|Assistant|Role [0-9A-F]*): ", 1)
        role = F.when(name.startswith("Role "), F.decode(F.unhex(F.substring(name, 6, 1 << 30)), "utf-8")).otherwise(F.lower(name))
        sound = piece.rlike(TURN) & ~body.rlike(PLAIN_CLOSE)
        return F.when(sound, F.struct(role.alias("role"), unescape(body).alias("text")))

    turns = F.transform(pieces, turn)
    return F.when(~F.exists(turns, lambda t: t.isNull()), turns)


def one_turn(role: Column, text: Column) -> Column:
    return F.array(F.struct(role.alias("role"), text.alias("text")))


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, spans``: the rendered conversation and the loss mask.

    ``spans`` are ``(start, length, octet, octets)`` of the assistant texts in ``formatted``:
    place and length in code points and in octets of UTF-8, from 0. They are running sums
    over the turns, so the time grows with the turns.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    source = one_turn(F.col("role"), F.col("text"))
    plain = rows.withColumn("body", F.col("text")).withColumn("back", parse(render(F.col("role"), F.col("body"))))
    rows = plain.withColumn("body", F.when(F.col("back").eqNullSafe(source), F.col("body")).otherwise(escape(F.col("text")))).drop("back")
    head = header(F.col("role"))
    rows = rows.withColumns({"head": F.length(head), "size": F.length("body"), "head_octets": F.octet_length(head), "octets": F.octet_length("body")})
    earlier = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda x: F.coalesce(F.sum(x + len(END)).over(earlier), F.lit(0).cast("long"))
    rows = rows.withColumns({"at": before(F.col("head") + F.col("size")), "octet_at": before(F.col("head_octets") + F.col("octets"))})
    shown = F.struct("turn", "role", "text", "body", "at", "head", "size", "octet_at", "head_octets", "octets")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(shown)).alias("turns"))
    whole = whole.withColumn("formatted", F.array_join(F.transform("turns", lambda t: render(t["role"], t["body"])), ""))
    same = parse(F.col("formatted")).eqNullSafe(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    message = F.concat(F.lit("conversation is not read back as it was: "), F.col("conv_id").cast("string"))
    whole = whole.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(F.raise_error(message).cast("string")))

    def span(t: Column) -> Column:
        return F.struct(
            (t["at"] + t["head"]).alias("start"),
            t["size"].cast("long").alias("length"),
            (t["octet_at"] + t["head_octets"]).alias("octet"),
            t["octets"].cast("long").alias("octets"),
        )

    spans = F.transform(F.filter("turns", lambda t: t["role"] == "assistant"), span)
    return whole.select("conv_id", "formatted", spans.alias("spans"))


def masked_text(text: Column, spans: Column) -> Column:
    """The unescaped text under the mask, read from the rendered conversation.

    Cut by octets, since a code point is only found by counting from the front. The
    octets are the variable of an outer function, so they are not made for every span.
    """

    def read(octets: Column) -> Column:
        return F.transform(spans, lambda s: unescape(F.decode(F.substring(octets, (s["octet"] + 1).cast("int"), s["octets"].cast("int")), "utf-8")))

    return F.array_join(F.element_at(F.transform(F.array(F.encode(text, "utf-8")), read), 1), "")
