"""Chat formatting: a finite-state machine over roles and a declarative template.

``segments`` turns every message into text segments with a loss flag each; ``formatted`` joins them per turn.
Turn order is validated by the machine's transition table, which needs only a turn's role and the one before it,
so validation is a window expression and no conversation is gathered.  ``read_back`` parses the formatted turns
again, undoing the escapes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START = "<start>"


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which roles carry loss and which role may follow which.

    ``segments`` lists (part, loss) in order; a part is literal text or one of ``{role}`` and ``{text}``;
    ``loss`` names when the part carries loss: ``never`` or ``role`` (if the turn's role is in ``loss_roles``).
    """

    segments: tuple[tuple[str, str], ...] = (
        ("<|im_start|>", "never"), ("{role}", "never"), ("\n", "never"), ("{text}", "role"), ("<|im_end|>\n", "never"))
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>")
    loss_roles: tuple[str, ...] = ("assistant",)
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    escape_char: str = "\\"


CHATML = Template()


def escaped(text: Column, t: Template = CHATML) -> Column:
    """Make every control string in ``text`` harmless, reversibly.

    The escape character is doubled, then one is put after the first character of each control string's opening
    ``<|``: no control string can occur in the result, and :func:`unescaped` restores the text exactly.
    """
    e = t.escape_char
    return F.replace(F.replace(text, F.lit(e), F.lit(e + e)), F.lit("<|"), F.lit("<" + e + "|"))


def unescaped(text: Column, t: Template = CHATML) -> Column:
    """Inverse of :func:`escaped`: an escape before ``|`` goes (it was put there), one before ``n`` is a role's line
    break, a doubled one becomes single.

    A doubled escape is first set aside as a character sequence that the escaped form cannot hold (``<|``), so
    the two replacements cannot be confused: ``\\\\`` to ``<|``, ``<\\|`` to ``<`` + ``|`` comes last.
    """
    e = t.escape_char
    held = F.replace(text, F.lit(e + e), F.lit("<|"))
    parts = F.split(held, "<\\|", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit("<" + e + "|"), F.lit("<|")),
                                                               F.lit(e + "n"), F.lit("\n"))), e)


def validated(messages: DataFrame, t: Template = CHATML) -> DataFrame:
    """Add ``prev_role`` and ``turn_ok``: whether the machine may go from the turn before to this one.

    Rows are ordered by turn, ties by role and text.  A null role is the empty role and never valid.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    allowed = F.lit(False)
    for before, after in t.transitions.items():
        allowed = allowed | ((F.col("prev_role") == before) & F.col("role").isin(*after))
    return messages.withColumn("prev_role", F.lag("role", 1, START).over(order)).withColumn("turn_ok", allowed)


def segments(messages: DataFrame, t: Template = CHATML) -> DataFrame:
    """Rows (conv_id, turn, turn_ok, segments array<struct<text, loss>>) of every message; null text is empty.

    An unknown or misplaced role is formatted like any other and flagged by ``turn_ok``.  Columns beyond the four
    of the table are dropped, so clashing names cannot do harm; repeated rows stay.
    """
    base = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                           F.coalesce("text", F.lit("")).alias("text"))
    checked = validated(base, t)
    has_loss = F.col("role").isin(*t.loss_roles)

    def part(p: str) -> Column:
        if p == "{role}":      # the header is one line
            return F.replace(escaped(F.col("role"), t), F.lit("\n"), F.lit(t.escape_char + "n"))
        return escaped(F.col("text"), t) if p == "{text}" else F.lit(p)

    parts = [F.struct(part(p).alias("text"), (has_loss if loss == "role" else F.lit(False)).alias("loss"))
             for p, loss in t.segments]
    return checked.select("conv_id", "turn", "role", "turn_ok", F.array(*parts).alias("segments"))


def formatted(messages: DataFrame, t: Template = CHATML) -> DataFrame:
    """One formatted string per turn with the spans (start, length in code points) that carry loss."""
    seg = segments(messages, t)
    text = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    upto = F.transform("segments", lambda s, i: F.struct(
        F.aggregate(F.slice("segments", F.lit(1), i), F.lit(0), lambda n, x: n + F.length(x["text"])).alias("start"),
        F.length(s["text"]).alias("length"), s["loss"].alias("loss")))
    spans = F.transform(F.filter(upto, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"]))
    return seg.select("conv_id", "turn", "turn_ok", text.alias("formatted"), spans.alias("loss_spans"))


def read_back(turns: DataFrame, t: Template = CHATML) -> DataFrame:
    """Parse formatted turns: (conv_id, turn, turn_ok, role, text, loss_text, formatted_chars), unescaped."""
    start, end = t.controls[0], t.controls[1] + "\n"
    body = F.expr(f"substring(formatted, {len(start) + 1}, length(formatted) - {len(start) + len(end)})")
    at = F.instr(F.col("body"), "\n")
    loss = F.array_join(F.transform("loss_spans", lambda s: F.substring(F.col("formatted"), s["start"] + 1, s["length"])), "")
    return (turns.withColumn("body", body)
            .select("conv_id", "turn", "turn_ok",
                    unescaped(F.substring(F.col("body"), F.lit(1), at - 1), t).alias("role"),
                    unescaped(F.substring(F.col("body"), at + 1, F.length("body")), t).alias("text"),
                    unescaped(loss, t).alias("loss_text"), F.length("formatted").alias("formatted_chars")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream sorted turns of whole conversations; state is one pair of running hashes, however long.

    Ids stay Arrow integers, so they are exact beside null ones.
    """
    key: object = START
    now: list = []

    def row() -> list:
        conv, n, turns, loss, chars, total, ok = now
        return [conv, n, turns.hexdigest(), chars, loss.hexdigest(), total, ok]

    def given(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(DIGESTS)],
                                          names=[c for c, _ in DIGESTS])

    for batch in batches:
        out = []
        for here, role, text, loss, chars, ok in zip(*(batch[c].to_pylist() for c in (
                "conv_id", "role", "text", "loss_text", "formatted_chars", "turn_ok"))):
            if here != key:
                if now:
                    out.append(row())
                key, now = here, [here, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, True]
            now[1] += 1
            now[2].update(f"{role}\n{text}\n".encode())
            now[3].update(loss.encode())
            now[4] += len(loss)
            now[5] += chars
            now[6] = now[6] and bool(ok)
        yield given(out)
    if now:
        yield given([row()])


DIGESTS = (("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
           ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation, from the formatted turns alone: counts and digests of what is read back.

    A null conv_id is a conversation of its own.  An empty table gives an empty result.
    """
    sorted_turns = (read_back(turns).repartition("conv_id")
                    .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"))
    return sorted_turns.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                             "loss_sha256 string, formatted_chars long, valid boolean")
