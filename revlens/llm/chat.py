"""Conversations as training text: a template's marks, turn order by a state machine, loss flags.

A template is data: the marks around a turn, the escape mark, and for each role its label, whether
its text is under the loss and which states it may follow. From it come three steps:

- `segments`: each turn becomes pieces (text, loss), its header, escaped text and end, in DataFrame expressions; no shuffle.
- `verdicts`: roles run through the state machine. Turns are dealt by range of (conversation, turn), so one endless
  conversation is cut like any other; each piece of a conversation becomes a map from every state to the state after
  it and the first turn out of order, and the maps are composed.
- `read_back`: the pieces of a conversation, streamed in order, are parsed by their marks alone; nothing is held but the
  open turn.

Edge cases: a null text is empty, a null role the empty role. Roles that the template doesn't name are written in quotes and
follow any state. Turns are ordered by turn (null first), ties by role and text, so repeated rows are turns of their own. Rows
without conversation form one conversation of their own. An empty table gives no rows. A conversation out of order is still
formatted; its verdict says so. Columns not named take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

START = "start"


@dataclass(frozen=True)
class Role:
    """A speaker: the label in the text, the states it may follow, whether its text is learned."""

    label: str
    follows: tuple[str, ...]
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """`opening` label `between` text `closing`, for each turn."""

    opening: str = "### "
    between: str = ": "
    closing: str = "</turn>\n"
    end: str = "</turn>"  # the part of `closing` that may not occur in a text
    escape: str = "\\"
    quote: str = '"'
    roles: dict[str, Role] = field(default_factory=lambda: {
        "system": Role("System", (START,)),
        "user": Role("User", (START, "system", "assistant")),
        "assistant": Role("Assistant", ("user",), loss=True),
    })
    ends: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        labels = [r.label for r in self.roles.values()]
        if len(set(labels)) < len(labels) or any(self.quote in x or self.between in x for x in labels) or START in self.roles:
            raise ValueError("labels must differ, without quote or separator, and no role is named as the start")

    @property
    def in_text(self) -> tuple[str, ...]:
        """What is escaped in a text."""
        return self.escape, self.opening, self.end

    @property
    def in_role(self) -> tuple[str, ...]:
        """What is escaped in a role that the template doesn't name."""
        return *self.in_text, self.between, self.quote

    @property
    def states(self) -> list[str]:
        """The start, each role, and one state after any other role."""
        return [START, *self.roles, ""]

    def after(self, state: str, role: str) -> tuple[str, bool]:
        """The state after a turn, and whether the turn was in order. A turn out of order is taken as a new beginning."""
        if role not in self.roles:
            return "", True
        return role, state == "" or state in self.roles[role].follows


DEFAULT = Template()


def escaped(text: Column, marks: tuple[str, ...], escape: str) -> Column:
    """The text with the escape mark before every one of `marks` in it."""
    pattern = "|".join(r"\Q" + x + r"\E" for x in marks)
    return F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(re.sub(r"([\\$])", r"\\\1", escape) + "$1"))


def turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conversation, turn, role, text) under the operator's own names."""
    named = [F.col(f"`{c}`") for c in (conversation, turn, role, text)]
    empty = F.lit("")
    return df.select(named[0].alias("conversation"), named[1].alias("turn"),
                     F.coalesce(named[2].cast("string"), empty).alias("role"), F.coalesce(named[3].cast("string"), empty).alias("text"))


def segments(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """`rows` with `segments`: the turn's header, body and end, each with its text and loss flag."""
    known = F.create_map(*[F.lit(x) for name, r in template.roles.items() for x in (name, r.label)])
    quoted = F.concat(F.lit(template.quote), escaped(F.col("role"), template.in_role, template.escape), F.lit(template.quote))
    label = F.coalesce(F.try_element_at(known, F.col("role")), quoted)
    learned = F.col("role").isin([name for name, r in template.roles.items() if r.loss])

    def piece(kind: str, text: Column, loss: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    return rows.withColumn("segments", F.array(
        piece("header", F.concat(F.lit(template.opening), label, F.lit(template.between)), no),
        piece("body", escaped(F.col("text"), template.in_text, template.escape), learned),
        piece("end", F.lit(template.closing), no)))


def verdicts(rows: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conversation, valid, bad_turn): whether the turns follow the template, and the first that doesn't.

    A conversation that ends with another role than the template's last ones is not valid either; its `bad_turn` is null.
    """
    states, turn_type = template.states, rows.schema["turn"].dataType
    keys = rows.select("conversation", "turn", "role", F.xxhash64("text").alias("tie"))
    order = ["conversation", "turn", "role", "tie"]
    dealt = keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    n = len(states)

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each stretch of one conversation: for each state before it, the state after it and the first bad turn."""
        table = {(s, r): template.after(s, r) for s in states for r in [*template.roles, ""]}
        known, current, out = set(template.roles), None, []

        def flush() -> pa.RecordBatch:
            names = ["conversation", "part", "after", "bad", "at"]
            kinds = [batch.schema.field("conversation").type, pa.int32(), pa.list_(pa.int32()),
                     pa.list_(pa.bool_()), pa.list_(batch.schema.field("turn").type)]
            done = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else
                                              [pa.array([], k) for k in kinds], names)
            out.clear()
            return done

        for batch in batches:
            for conversation, turn, role, part in zip(*(batch.column(c).to_pylist() for c in ("conversation", "turn", "role", "part"))):
                if current is None or current[0] != conversation:
                    if current:
                        out.append((current[0], current[1], [states.index(s) for s in current[2]], current[3], current[4]))
                    current = [conversation, part, list(states), [False] * n, [None] * n]
                role = role if role in known else ""
                for i, before in enumerate(current[2]):
                    current[2][i], fine = table[before, role]
                    if not fine and not current[3][i]:
                        current[3][i], current[4][i] = True, turn
            yield flush()
        if current:
            out.append((current[0], current[1], [states.index(s) for s in current[2]], current[3], current[4]))
            yield flush()

    schema = (f"conversation {rows.schema['conversation'].dataType.simpleString()}, part int, after array<int>, "
              f"bad array<boolean>, at array<{turn_type.simpleString()}>")
    stretches = dealt.select("conversation", "turn", "role", "part").mapInArrow(maps, schema)
    # At most one stretch of a conversation from each partition.
    whole = stretches.groupBy("conversation").agg(F.array_sort(F.collect_list(F.struct("part", "after", "bad", "at"))).alias("s"))
    begin = F.struct(F.lit(0).alias("state"), F.lit(False).alias("bad"), F.lit(None).cast(turn_type).alias("at"))

    def step(a: Column, s: Column) -> Column:
        here = a["state"]
        return F.struct(F.get(s["after"], here).alias("state"), (a["bad"] | F.get(s["bad"], here)).alias("bad"),
                        F.when(a["bad"], a["at"]).otherwise(F.get(s["at"], here)).alias("at"))

    last = F.aggregate("s", begin, step)
    ends = [states.index(r) for r in template.ends]
    found = whole.select("conversation", last.alias("last"))
    return found.select("conversation", (~F.col("last.bad") & F.col("last.state").isin(ends)).alias("valid"),
                        F.col("last.at").alias("bad_turn"))


class Reader:
    """Reads turns back from formatted text that arrives in pieces (text, loss)."""

    def __init__(self, template: Template):
        self.template = template
        self.roles = {r.label: name for name, r in template.roles.items()}
        kept = re.escape(template.escape) + "(?:" + "|".join(map(re.escape, template.in_role)) + ")"
        self.mark = re.compile(f"{kept}|({re.escape(template.between)})|({re.escape(template.closing)})")
        self.escaped = re.compile(kept.replace("(?:", "(", 1))
        self.open = ""

    def plain(self, text: str) -> str:
        return self.escaped.sub(r"\1", text)

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """The turns (role, text) that end within this piece."""
        self.open += piece
        while turn := self._turn():
            yield turn

    def _turn(self) -> tuple[str, str] | None:
        t, between = self.template, None
        if not self.open.endswith(t.closing):  # a turn ends where a piece ends
            return None
        if not self.open.startswith(t.opening):
            raise ValueError("no turn begins here")
        for found in self.mark.finditer(self.open, len(t.opening)):
            if found.group(1) is not None and between is None:
                between = found
            elif found.group(2) is not None:
                label = self.open[len(t.opening):between.start()]
                text = self.plain(self.open[between.end():found.start()])
                self.open = self.open[found.end():]
                quoted = label.startswith(t.quote)
                return (self.plain(label[len(t.quote):-len(t.quote)]) if quoted else self.roles[label]), text
        return None


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation.

    Roles and texts are parsed from the joined pieces, not taken from the rows. A task sorts its conversations' pieces and
    streams them; it holds the open turn and two running hashes.
    """
    order = ["turn", "role", "text"]
    dealt = formatted.repartition("conversation").sortWithinPartitions("conversation", *order)
    dealt = dealt.select("conversation", F.col("segments.text").alias("texts"), F.col("segments.loss").alias("losses"))
    names = ["conversation", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done, kind = None, [], None

        def close() -> None:
            if current["reader"].open:
                raise ValueError("a turn without end")
            done.append((current["conversation"], current["turns"], current["all"].hexdigest(), current["loss_chars"],
                         current["loss"].hexdigest(), current["chars"]))

        def flush() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*done)) if done else [[]] * len(kinds)
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            kind = batch.schema.field("conversation").type
            for conversation, texts, losses in zip(*(c.to_pylist() for c in batch.columns)):
                if current is None or current["conversation"] != conversation:
                    if current:
                        close()
                    current = {"conversation": conversation, "reader": Reader(template), "turns": 0, "all": hashlib.sha256(),
                               "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                for text, loss in zip(texts, losses):
                    current["chars"] += len(text)
                    if loss:
                        learned = current["reader"].plain(text)
                        current["loss_chars"] += len(learned)
                        current["loss"].update(learned.encode())
                    for role, said in current["reader"].feed(text):
                        current["turns"] += 1
                        current["all"].update(f"{role}\n{said}\n".encode())
            yield flush()
        if current:
            close()
            yield flush()

    schema = (f"conversation {formatted.schema['conversation'].dataType.simpleString()}, n_turns bigint, turns_sha256 string, "
              "loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return dealt.mapInArrow(read, schema)


def formatted_text(formatted: DataFrame) -> DataFrame:
    """(conversation, text, spans): whole conversations as one text, with (start, end) of what is under the loss.

    For writing out conversations that fit a row; `segments` has no such bound.
    """
    whole = formatted.groupBy("conversation").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "segments"))).alias("t"))
    whole = whole.select("conversation", F.flatten("t.segments").alias("s"))
    ends = F.aggregate("s", F.array(F.lit(0)), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + F.length(s["text"]))))
    spans = F.zip_with(F.slice(ends, 1, F.size("s")), F.slice(ends, 2, F.size("s")), lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    spans = F.filter(spans, lambda x, i: F.get(F.col("s.loss"), i))
    return whole.select("conversation", F.array_join("s.text", "").alias("text"), spans.alias("spans"))
