"""Chat formatting by event sourcing.

An event log (conversation, sequence, message, event) is folded into final
messages, which are rendered with a template.  The fold is dealt by message,
that is by conversation and, within it, by message: no event touches another
message, so the messages of a conversation fold apart and a conversation of
any length spreads over the tasks.  Each task reads its events in order of
sequence, holding one message at a time.  A turn
is rendered on its own; a formatted conversation is its turns' pieces in
order, so it need never be in one row (``whole`` joins the pieces where they
fit, ``digests`` reads them back as a stream).

A control string in a text gets a backslash after its first character, at
every place where one begins, also inside another.  An escaped text thus
holds no mark, and since each closing mark begins with its only blank, none
can arise where a text meets its mark: the open turn ends at the first closing
mark of its role.

Events: ``start`` opens a message with a role, ``delta`` appends to it,
``edit`` replaces its text, ``regenerate`` empties it for the deltas that
follow, ``delete`` removes it.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm._store import stored

# The strings that open and close a turn of each role; any other role is named in its mark.
MARKS = {
    "system": ("<<SYS>> ", " <</SYS>>"),
    "user": ("<s>[INST] ", " [/INST]"),
    "assistant": (" ", " </s>"),
}
OTHER = ("<|{role}|> ", " <|end|>")
#: Where control strings begin, with the backslashes that escape them (one more than the text had).
_CONTROL = re.compile(r"([<\[])(?=\\*(?:/?INST\]|/?s>|</?SYS>>|\|[^|\n]*\|>))")
_ESCAPED = re.compile(r"([<\[])\\(?=\\*(?:/?INST\]|/?s>|</?SYS>>|\|[^|\n]*\|>))")
_ROLE = re.compile(r"[\\|\n%]")
_OPEN = re.compile(r"(?P<system><<SYS>> )|(?P<user><s>\[INST\] )|<\|(?P<role>[^|\n]*)\|> |(?P<assistant> )")
_MESSAGES = "conv_id {id}, seq long, message long, role string, text string"
_PIECES = "conv_id {id}, seq long, message long, role string, piece string, loss_start int, loss_end int"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and start and end (code points) of what the loss covers in it."""
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = OTHER[0].format(role=_ROLE.sub(lambda m: f"%{ord(m.group()):02x}", role)), OTHER[1]
    body = escape(text)
    end = len(before) + len(body)
    return before + body + after, *((len(before), end) if role == "assistant" else (0, 0))


class Reader:
    """Reads formatted conversations back from a stream of characters, given in parts of any length."""

    def __init__(self):
        self.text, self.at, self.role = "", 0, None  # what is not read yet, its place in the stream, the open role

    def turns(self, more: str):
        """(role, text, start and end in the stream) of the turns that end within what is there now."""
        text = self.text + more
        pos = 0
        while True:
            if self.role is None:
                m = _OPEN.match(text, pos)
                if not m:
                    break
                self.role = m.lastgroup if m.lastgroup != "role" else re.sub("%(..)", lambda x: chr(int(x[1], 16)), m["role"])
                self.close = OTHER[1] if m.lastgroup == "role" else MARKS[self.role][1]
                pos = m.end()
            end = text.find(self.close, pos)
            if end < 0:
                break
            yield self.role, unescape(text[pos:end]), self.at + pos, self.at + end
            pos, self.role = end + len(self.close), None
        self.text, self.at = text[pos:], self.at + pos

    def whole(self) -> bool:
        """Nothing is left over: the stream ended with a turn."""
        return self.role is None and not self.text


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of the turns of a formatted conversation."""
    reader = Reader()
    found = [(role, text) for role, text, _, _ in reader.turns(formatted)]
    if not reader.whole():
        raise ValueError("the text does not end with a turn")
    return found


def events_of_messages(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", delta: int = 256) -> DataFrame:
    """An event log that folds to the given messages: a start, then deltas of at most ``delta`` characters of the whole text.

    So that every event occurs, a third of the messages has a draft and is
    generated again, a third has a draft that an edit replaces, and beside
    each of the others a message is written and deleted.

    Every row is a message of its own, also rows that repeat; rows of one turn
    follow each other in order of arrival.  Null texts and roles are empty,
    null turns come first, null conversation ids are one conversation.
    """
    rows = stored(messages.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("seq"), F.monotonically_increasing_id().alias("message"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")))
    # how a message came about: written again from a draft, a draft edited, or another one deleted beside it
    way = F.pmod(F.xxhash64("message"), F.lit(3))
    way = F.when((way == 1) & (F.col("text") == ""), 0).otherwise(way)
    rows = rows.withColumn("way", way)
    part = F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / delta).cast("int"))).alias("part")
    event = F.when(F.col("part") == 0, "start").when((F.col("part") == 1) & (F.col("way") == 1), "edit").otherwise("delta")
    log = rows.select("*", part).select(
        "conv_id", "seq", (F.col("part") * 2).alias("part"), "message", event.alias("event"), "role",
        F.when(F.col("part") > 0, F.substring("text", (F.col("part") - 1) * delta + 1, F.lit(delta))).alias("text"))
    draft = F.concat(F.lit("draft "), F.reverse(F.substring("text", 1, delta)))

    def said(event: str, of: DataFrame, part: int, message, text=None) -> DataFrame:
        return of.select("conv_id", "seq", F.lit(part).alias("part"), message.alias("message"), F.lit(event).alias("event"), "role", (F.lit(None).cast("string") if text is None else text).alias("text"))

    message, other = F.col("message"), -1 - F.col("message")
    drafts, beside = rows.filter("way < 2"), rows.filter("way = 2")
    more = [said("delta", drafts, 1, message, draft), said("regenerate", rows.filter("way = 0"), 1, message),
            said("start", beside, 0, other), said("delta", beside, 1, other, draft), said("delete", beside, 2, other)]
    for m in more:
        log = log.unionByName(m)
    return log


def _folded(batches, names: list[str]):
    """Final messages from events in order of message, sequence and part."""
    key = first = role = None
    text: list[str] | None = None
    for batch in batches:
        rows: list[tuple] = []
        for conv, seq, message, event, r, t in zip(*(c.to_pylist() for c in batch.columns)):
            if (conv, message) != key:
                if key is not None and text is not None:
                    rows.append((key[0], first, key[1], role or "", "".join(text)))
                key, first, role, text = (conv, message), seq, None, []
            if event == "delete":
                text = None
                continue
            if text is None:
                text = []
            role = r if r is not None and (event == "start" or role is None) else role
            if event in ("edit", "regenerate"):
                text = []
            if t is not None and event != "regenerate":
                text.append(t)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], batch.column(0).type if i == 0 else pa.int64() if i < 3 else pa.string()) for i in range(5)], names=names)
    if key is not None and text is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], batch.column(0).type if i == 0 else pa.int64() if i < 3 else pa.string()) for i, v in enumerate((key[0], first, key[1], role or "", "".join(text)))], names=names)


def fold(events: DataFrame) -> DataFrame:
    """Final messages of an event log (columns conv_id, seq, part, message, event, role, text).

    Returns conv_id, seq (that of the message's first event: its place in the
    conversation, ties by message id), message, role, text.

    Events at the same place (seq, part) apply in order of event and text;
    repeated events apply again.  A null text adds nothing, a null role is
    empty, unknown events count as deltas, a message without a start takes
    the first role it meets.  Null conversation ids are one conversation, null
    seq come first, an empty log has no messages.
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["conv_id", "seq", "message", "role", "text"]
    schema = _MESSAGES.format(id=events.schema["conv_id"].dataType.simpleString())
    order = F.when(F.col("event") == "start", 0).otherwise(1)
    ordered = events.repartition(parts, "conv_id", "message").sortWithinPartitions("conv_id", "message", "seq", "part", order, "event", "text")
    return ordered.select("conv_id", "seq", "message", "event", "role", "text").mapInArrow(lambda it: _folded(it, names), schema)


def formatted(messages: DataFrame) -> DataFrame:
    """Rendered turns of folded messages: ``piece``, and the code points the loss covers in it (an assistant's text)."""
    def run(batches):
        for batch in batches:
            made = [render(r or "", t or "") for r, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int32())],
                                             names=["conv_id", "seq", "message", "role", "piece", "loss_start", "loss_end"])

    schema = _PIECES.format(id=messages.schema["conv_id"].dataType.simpleString())
    return messages.select("conv_id", "seq", "message", "role", "text").mapInArrow(run, schema)


def whole(pieces: DataFrame) -> DataFrame:
    """One text for each conversation (for conversations that fit in a row)."""
    rows = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("seq", "message", "piece"))).alias("p"))
    return rows.select("conv_id", F.concat_ws("", F.transform("p", lambda x: x["piece"])).alias("formatted"))


def digests(pieces: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its formatted turns.

    A task streams its conversations in order and holds a hash state, not a
    conversation: SHA-256 is sequential, so that one conversation is one
    stream, whatever its length.
    """
    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = pieces.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = pieces.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "seq", "message")

    def run(batches):
        state = None

        def fresh(conv):
            return {"conv": conv, "n": 0, "chars": 0, "loss": 0, "turns": hashlib.sha256(), "under": hashlib.sha256(), "reader": Reader(), "mask": []}

        def row(s):
            if not s["reader"].whole() or s["mask"]:
                raise ValueError(f"conversation {s['conv']} does not read back")
            return s["conv"], s["n"], s["turns"].hexdigest(), s["loss"], s["under"].hexdigest(), s["chars"]

        def batch_of(rows, id_type):
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            made = []
            for c, piece, a, b in zip(*(x.to_pylist() for x in batch.columns)):
                if state is None or c != state["conv"]:
                    if state is not None:
                        made.append(row(state))
                    state = fresh(c)
                reader = state["reader"]
                if b > a:
                    state["mask"].append((state["chars"] + a, state["chars"] + b))
                # what the mask covers is cut out of the stream as it stands
                before, held = reader.at, reader.text + piece
                state["chars"] += len(piece)
                for role, text, _, _ in reader.turns(piece):
                    state["turns"].update(f"{role}\n{text}\n".encode())
                    state["n"] += 1
                while state["mask"] and state["mask"][0][1] <= state["chars"]:
                    x, y = state["mask"].pop(0)
                    under = unescape(held[x - before: y - before])
                    state["under"].update(under.encode())
                    state["loss"] += len(under)
            if made:
                yield batch_of(made, batch.column(0).type)
            last = batch.column(0).type
        if state is not None:
            yield batch_of([row(state)], last)

    return ordered.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
