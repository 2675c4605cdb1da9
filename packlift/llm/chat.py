"""Chat formatting with DataFrame functions only.

A declarative template names the roles, the order in which they may speak, the
strings around a turn, and the roles whose text is trained on. A finite-state
machine over each conversation's roles checks the order (``valid`` and
``end_state``; all conversations are formatted, valid or not). A turn gives three segments, each
with a loss flag: the opening with the role, the text, and the close. Control
strings inside a text or role are escaped, so they cannot pose as the
template's, and ``read_turns`` gets the turns back from the formatted string.

Escaping is reversible: ``&`` becomes ``&amp;``, then ``<|`` becomes ``&lt;|``
(and a line feed in a role ``&nl;``); reading undoes this in reverse order.

Defined cases: a null text or role is empty, an unknown role leads to the state
``error``; turns are ordered by turn number, then role, then text, null turn numbers first; repeated
rows are turns of their own; rows with a null conversation id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packlift.llm.common import text_of


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    # state -> roles that may speak next; a role's name is the state after it
    turns: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})


CHATML = Template()


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def final_state(turns: Column, template: Template) -> Column:
    """The machine's state after all turns; ``error`` once a role speaks out of order."""
    steps = F.create_map(*[F.lit(x) for state, roles in template.turns.items() for role in roles
                           for x in (f"{state}>{role}", role)])
    return F.aggregate(turns, F.lit("start"),
                       lambda state, t: F.coalesce(steps[F.concat(state, F.lit(">"), t["role"])], F.lit("error")))


def format_chats(rows: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation: ``conv_id, valid, end_state, segments, formatted``;
    a segment is (text, loss)."""
    turns = (rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         text_of().alias("text"))
             .groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
                 F.col("turn").isNotNull().alias("numbered"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                 "role", "text"))).alias("turns")))

    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template.open), _escape_role(t["role"]), F.lit(template.after_role))
        return F.array(segment(head, F.lit(False)), segment(escape(t["text"]), t["role"].isin(*template.loss_roles)),
                       segment(F.lit(template.close), F.lit(False)))

    state = final_state(F.col("turns"), template)
    return (turns.select("conv_id", state.alias("end_state"), F.flatten(F.transform("turns", segments)).alias("segments"))
            .select("conv_id", (F.col("end_state") != "error").alias("valid"), "end_state", "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted")))


def read_turns(formatted: Column, template: Template = CHATML) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.filter(F.split(formatted, "\\Q" + template.close + "\\E"), lambda p: p != "")
    body = F.transform(pieces, lambda p: F.substr(p, F.lit(len(template.open) + 1)))

    def turn(p: Column) -> Column:
        at = F.position(F.lit(template.after_role), p)
        return F.struct(_unescape_role(F.substr(p, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substr(p, at + len(template.after_role))).alias("text"))

    return F.transform(body, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    trained = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(trained, lambda s: unescape(s["text"])), "")


def chat_digests(chats: DataFrame, template: Template = CHATML) -> DataFrame:
    """Counts and digests read back from the formatted conversations."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (chats.select("conv_id", "valid", read_turns(F.col("formatted"), template).alias("turns"),
                         loss_text(F.col("segments")).alias("loss"), F.char_length("formatted").alias("n"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.col("n").cast("long").alias("formatted_chars"), "valid"))
