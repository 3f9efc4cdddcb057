"""Chat formatting: a finite-state machine over roles, and texts in segments that say whether they are learned."""

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.llm.common import quoted
from shelfmatch.sources.staging import broadcast_if_small, stage

LONG = 4096  # rows; longer conversations are put together in pieces first
PIECE_TURNS = 256  # turn numbers in a piece of a long conversation


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which role may follow which ('' is the begin), and which texts are learned.

    Controls begin with ``mark``. In texts one more ``guard`` follows each ``mark``, so no text holds a control.
    """

    begin: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    after_role: str = "\n"
    mark: str = "<|"
    guard: str = "|"
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    last: tuple[str, ...] = ("assistant",)
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if not (self.begin.startswith(self.mark) and self.end.startswith(self.mark) and self.after_role[:1] == "\n"):
            raise ValueError("controls begin with the mark, and a line break ends the role")
        if any((self.mark + self.guard)[k:].startswith(self.mark) for k in range(1, len(self.mark))) or self.begin.startswith(self.mark + self.guard) or self.end.startswith(self.mark + self.guard):
            raise ValueError("a guarded mark may not look like a control or overlap itself")

    def escape(self, text: Column) -> Column:
        return F.replace(text, F.lit(self.mark), F.lit(self.mark + self.guard))

    def unescape(self, text: Column) -> Column:
        return F.replace(text, F.lit(self.mark + self.guard), F.lit(self.mark))

    def escape_role(self, role: Column) -> Column:
        return self.escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))

    def unescape_role(self, role: Column) -> Column:
        return F.replace(F.replace(self.unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


class Machine:
    """The template's states as numbers: 0 the begin, then the roles, last the sink of all that is not allowed."""

    def __init__(self, template: Template):
        self.roles = list(dict.fromkeys([*[r for r in template.follows if r], *[r for to in template.follows.values() for r in to]]))
        self.sink = len(self.roles) + 1
        number = {r: i + 1 for i, r in enumerate(self.roles)}
        self.moves = [[self.sink] * (len(self.roles) + 1) for _ in range(self.sink + 1)]  # [state][role, 0 if unknown]
        for state, roles in template.follows.items():
            for role in roles:
                self.moves[number.get(state, 0)][number[role]] = number[role]
        self.final = [number[r] for r in template.last if r in number]

    def number(self, role: Column) -> Column:
        found = F.lit(0)
        for i, name in enumerate(self.roles):
            found = F.when(role == name, F.lit(i + 1)).otherwise(found)
        return found

    def run(self, numbers: Column) -> Column:
        """For each state to start from: the state after all roles, and how many roles it took (all, or up to the fault)."""
        width = len(self.roles) + 1
        moves = F.array(*[F.lit(x) for row in self.moves for x in row])

        def step(now, number):
            state = F.get(moves, now["state"] * width + number)
            return F.struct(state.alias("state"), (now["taken"] + (state != self.sink).cast("int")).alias("taken"))

        def begin(state):
            return F.struct(F.lit(state).alias("state"), F.lit(0).alias("taken"))

        return F.array(*[F.aggregate(numbers, begin(s), step) for s in range(self.sink + 1)])

    def compose(self, runs: Column) -> Column:
        """The run of pieces one after the other, from the begin: what a piece does depends only on the state before it."""
        begin = F.struct(F.lit(0).alias("state"), F.lit(0).alias("taken"))

        def step(now, run):
            after = F.get(run, now["state"])
            return F.struct(after["state"].alias("state"), (now["taken"] + after["taken"]).alias("taken"))

        return F.aggregate(runs, begin, step)


def format_conversations(
    rows: DataFrame, template: Template = Template(), conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", long: int = LONG
) -> DataFrame:
    """(conv_id, n_turns, segments, valid, fault) of each conversation. ``segments`` are the formatted text in order, as
    (text, loss): head, text and end of each turn; ``loss`` marks the texts to learn. ``valid``: the template allows the
    order of the roles and the last one. ``fault``: from 0, the turn that is not allowed, or the number of turns if more
    were to come; null if valid. Conversations that are not valid are formatted as well.

    Rows go by turn (null turns last), equal turns by role and text, repeated rows stay. A null text or role counts as
    an empty one, an unknown role is not allowed. Rows without a ``conv_id`` are one conversation, with a null id. Other
    columns are left out, whatever their names. An empty table gives an empty result.

    A conversation ends as one row, so it must fit one (2 GB). Texts are shuffled once. Conversations of more than
    ``long`` rows are first put together in pieces of turn numbers by many tasks: a piece says for each state of the
    machine in which it ends, so the pieces' runs can be joined afterwards.
    """
    machine = Machine(template)
    source = rows.select(
        quoted(conv_id).alias("conv_id"), quoted(turn).alias("turn"),
        F.coalesce(quoted(role), F.lit("")).alias("role"), F.coalesce(quoted(text), F.lit("")).alias("text"),
    )
    counted = stage(source.groupBy("conv_id").count().where(F.col("count") > long).select(F.col("conv_id").alias("long_id")), "long-conversations")
    held = broadcast_if_small(counted)
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))

    def pieces(part, key):
        turns = F.array_sort(F.collect_list(F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text")))
        return part.groupBy("conv_id", *key).agg(turns.alias("turns")).select(
            "conv_id", *key, F.size("turns").cast("long").alias("n"),
            machine.run(F.transform("turns", lambda t: machine.number(t["role"]))).alias("run"),
            F.flatten(F.transform("turns", lambda t: segments_of(template, t["role"], t["text"]))).alias("segments"),
        )

    short = pieces(source.join(held, same, "left_anti"), []).select("conv_id", "n", machine.compose(F.array("run")).alias("end"), "segments")
    cut = pieces(source.join(held, same, "left_semi").withColumn("piece", F.floor(F.col("turn") / PIECE_TURNS)), ["piece"])
    parts = F.array_sort(F.collect_list(F.struct(F.col("piece").isNull().alias("late"), "piece", "run", "segments")))
    whole = cut.groupBy("conv_id").agg(F.sum("n").alias("n"), parts.alias("parts"))
    joined = whole.select("conv_id", "n", machine.compose(F.col("parts.run")).alias("end"), F.flatten(F.col("parts.segments")).alias("segments"))
    valid = F.col("end.state").isin(machine.final)
    return short.unionByName(joined).select(
        "conv_id", F.col("n").alias("n_turns"), "segments", valid.alias("valid"), F.when(~valid, F.col("end.taken")).alias("fault"))


def segments_of(template: Template, role: Column, text: Column) -> Column:
    def segment(content, loss):
        return F.struct(content.alias("text"), loss.alias("loss"))

    head = F.concat(F.lit(template.begin), template.escape_role(role), F.lit(template.after_role))
    return F.array(segment(head, F.lit(False)), segment(template.escape(text), role.isin(*template.learned)), segment(F.lit(template.end), F.lit(False)))


def formatted_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned_text(segments: Column, template: Template = Template()) -> Column:
    """The texts under the loss mask as they were before formatting, one after the other."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.split(formatted, re.escape(template.begin), -1)

    def turn(part):
        head = F.substring_index(part, template.after_role, 1)
        before = F.char_length(head) + len(template.after_role)
        body = F.substr(part, before + 1, F.char_length(part) - before - len(template.end))
        return F.struct(template.unescape_role(head).alias("role"), template.unescape(body).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), turn)
