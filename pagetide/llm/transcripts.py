"""Chat transcripts as lines of text, parsed into turns by a hidden Markov model.

A state is a role and whether a line opens a turn or goes on with it. A line shows one symbol made
of its speaker marker, if any, its length and its ending. The Viterbi path gives each line its role,
also where a marker is missing or unknown; then turns are rendered in one canonical form.

Lines are dealt by ranges of their full order, so a conversation of any length is spread over tasks.
What lies whole in a task is decoded there. Of a conversation that may go on in another task, each
piece is first reduced to the best score between any two states at its ends; these small tables, one
per piece, are chained, which fixes the states at the borders, and then each piece is decoded.

Defined results: a null text is an empty line; a null `turn` comes first; rows that repeat all of
conversation, turn, role and text count once, other rows of one turn follow each other by a hash;
null conversations are one conversation; unknown roles are parsed but not learned from; an empty
table gives an empty result; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window, functions as F

from pagetide.llm.tables import ship, stored

ROLES = ("system", "user", "assistant")
STATES = tuple((role, opens) for role in ROLES for opens in (True, False))

# Speaker words, all in lower case, of each role in turn.
SPEAKERS = (
    ("system", "instructions", "context"),
    ("user", "human", "customer", "question", "q", "me"),
    ("assistant", "bot", "ai", "answer", "a", "model"),
)
_MARK = r"^[#*\[(<|]*\s*([A-Za-z]{1,20})\s*[\])*|>]*\s*[:>]\s?"
_MARKS = 2 + len(ROLES)
_LENGTHS = (40, 160)
SYMBOLS = _MARKS * (len(_LENGTHS) + 1) * 2

_KEYS = ["conv_id", "position", "tie", "line_no"]


def _speaker(line):
    return F.lower(F.regexp_extract(line, _MARK, 1))


def symbol(line):
    """A line's marker, length class and ending as one number below `SYMBOLS`."""
    word = _speaker(line)
    mark = F.when(word == "", 0)
    for number, words in enumerate(SPEAKERS):
        mark = mark.when(word.isin(*words), number + 1)
    mark = mark.otherwise(_MARKS - 1)
    length = sum((F.char_length(line) > limit).cast("int") for limit in _LENGTHS)
    asks = line.rlike(r"\?\s*$").cast("int")
    return ((mark * (len(_LENGTHS) + 1) + length) * 2 + asks).cast("int")


def content(line):
    """The line without the marker of a known speaker."""
    known = _speaker(line).isin(*[word for words in SPEAKERS for word in words])
    return F.when(known, F.regexp_replace(line, _MARK, "")).otherwise(line)


# Transcripts from the table of conversations.


def _marker(role):
    """How a conversation marks a role; every fourth turn is not marked at all."""
    style = F.pmod(F.xxhash64(F.col("conv_id")), F.lit(3))
    forms = [("{}: ", 0), ("[{}]: ", 1), ("{}> ", 2)]
    word = F.initcap(
        F.when(style == 0, role)
        .when(role == "user", F.lit("human"))
        .when(role == "assistant", F.lit("bot"))
        .otherwise(role)
    )
    marked = F.lit("")
    for form, number in forms:
        marked = F.when(style == number, F.format_string(form.replace("{}", "%s"), word)).otherwise(
            marked
        )
    bare = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0
    return F.when(bare | role.isNull(), F.lit("")).otherwise(marked)


def transcript_lines(conversations):
    """Lines in their order, with the role that spoke, which a parser does not get to see."""
    turns = conversations.select("conv_id", "turn", "role", "text").distinct()
    text = F.concat(_marker(F.col("role")), F.coalesce("text", F.lit("")))
    lines = F.split(text, "\n", -1)
    return turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(-1)).alias("position"),
        F.xxhash64("role", "text").alias("tie"),
        "role",
        F.size(lines).alias("n_lines"),
        F.posexplode(lines).alias("line_no", "line"),
    )


# Learning.


def train(lines):
    """Log probabilities of first states, transitions and symbols, by counting lines of known role.

    The state before a turn's first line is that of the last line of the turn before, which a join
    on conversation and turn finds; no conversation is gathered.
    """
    known = lines.filter(F.col("role").isin(*ROLES)).withColumns(
        {"symbol": symbol(F.col("line")), "opens": F.col("line_no") == 0}
    )
    emitted = known.groupBy("role", "opens", "symbol").count().collect()
    turns = known.filter("line_no = 0").select("conv_id", "position", "tie", "role", "n_lines")
    # Where a turn number comes several times, its last row comes before the next turn.
    ended = F.struct("role", (F.col("n_lines") == 1).alias("opens"))
    before = (
        turns.groupBy("conv_id", (F.col("position") + 1).alias("position"))
        .agg(F.max_by(ended, "tie").alias("ended"))
        .select(
            "conv_id",
            "position",
            F.col("ended.role").alias("role_before"),
            F.col("ended.opens").alias("opens_before"),
        )
    )
    moved = turns.join(before, ["conv_id", "position"], "left").groupBy(
        "role_before", "opens_before", "role"
    ).count().collect()
    went_on = turns.groupBy("role").agg(
        F.sum((F.col("n_lines") > 1).cast("bigint")).alias("after_first"),
        F.sum(F.greatest(F.col("n_lines") - 2, F.lit(0)).cast("bigint")).alias("later"),
    ).collect()

    place = {state: number for number, state in enumerate(STATES)}
    first, steps = np.zeros(len(STATES)), np.zeros((len(STATES), len(STATES)))
    shown = np.ones((len(STATES), SYMBOLS))
    for (role, opens), number in place.items():
        first[number] = opens
        for (other, starts), after in place.items():
            steps[number, after] = starts or other == role
    for row in emitted:
        shown[place[row.role, row.opens], row.symbol] += row["count"]
    for row in moved:
        if row.role_before is None:
            first[place[row.role, True]] += row["count"]
        else:
            steps[place[row.role_before, row.opens_before], place[row.role, True]] += row["count"]
    for row in went_on:
        steps[place[row.role, True], place[row.role, False]] += row.after_first
        steps[place[row.role, False], place[row.role, False]] += row.later
    with np.errstate(divide="ignore"):
        return (
            np.log(first / first.sum()),
            np.log(steps / steps.sum(axis=1, keepdims=True)),
            np.log(shown / shown.sum(axis=1, keepdims=True)),
        )


# Decoding.


def viterbi(symbols, model, entry=None, last=None):
    """The best states of a run of lines, after state `entry` and with state `last` at its end."""
    first, steps, shown = model
    score = (first if entry is None else steps[entry]) + shown[:, symbols[0]]
    back = np.zeros((len(symbols), len(first)), np.int64)
    for at in range(1, len(symbols)):
        reached = score[:, None] + steps
        back[at] = reached.argmax(axis=0)
        score = reached.max(axis=0) + shown[:, symbols[at]]
    path = np.zeros(len(symbols), np.int64)
    path[-1] = score.argmax() if last is None else last
    for at in range(len(symbols) - 1, 0, -1):
        path[at - 1] = back[at, path[at]]
    return path


def transfer(symbols, model):
    """Best scores of a run, from each state before it, and from the start of a conversation."""
    first, steps, shown = model
    score = np.vstack([steps, first]) + shown[:, symbols[0]]
    for found in symbols[1:]:
        score = (score[:, :, None] + steps).max(axis=1) + shown[:, found]
    return score


def chain(transfers):
    """The states before and at the end of each run of one conversation; none before the first."""
    score, back = transfers[0][-1], []
    for one in transfers[1:]:
        reached = score[:, None] + one[:-1]
        back.append(reached.argmax(axis=0))
        score = reached.max(axis=0)
    ends = [int(score.argmax())]
    for pointers in reversed(back):
        ends.append(int(pointers[ends[-1]]))
    ends.reverse()
    return [None, *ends[:-1]], ends


_OPENS = np.array([opens for _, opens in STATES])

_LINE = "conv_id bigint, position bigint, tie bigint, line_no int, line string, symbol int"
_DECODED = f"{_LINE}, part int, state int, turn bigint"


def _turns(states):
    return np.cumsum(_OPENS[states]) - 1


def _decode_whole(model):
    """Lines with state and turn, or with nulls for the first and last conversation of a task."""
    kinds = [pa.int64()] * 3 + [pa.int32(), pa.string()] + [pa.int32()] * 3 + [pa.int64()]
    names = [part.split()[0] for part in _DECODED.split(", ")]

    def rows(lines, part, border):
        count = lines.num_rows
        if border:
            states = turns = pa.nulls(count)
        else:
            states = viterbi(lines.column("symbol").to_numpy(), model)
            turns = _turns(states)
        columns = [*lines.columns, pa.array([part] * count), pa.array(states), pa.array(turns)]
        table = pa.table([column.cast(kind) for column, kind in zip(columns, kinds)], names=names)
        return table.to_batches()

    def run(batches):
        part, waiting, is_first = TaskContext.get().partitionId(), None, True
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if waiting is None else pa.concat_tables([waiting, table])
            if not table.num_rows:
                continue
            conversations = table.column("conv_id").fill_null(np.iinfo(np.int64).min).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(conversations)) + 1).tolist()]
            for start, end in zip(cuts, cuts[1:]):
                yield from rows(table.slice(start, end - start), part, is_first)
                is_first = False
            waiting = table.slice(cuts[-1])
        if waiting is not None and waiting.num_rows:
            yield from rows(waiting, part, True)

    return run


def parse(lines, model):
    """The lines with `state` and `turn`, numbered from 0 in each conversation."""
    ship(lines.sparkSession)
    ordered = (
        lines.select("conv_id", "position", "tie", "line_no", "line")
        .withColumn("symbol", symbol(F.col("line")))
        .repartitionByRange(*_KEYS)
        .sortWithinPartitions(*_KEYS)
    )
    decoded = stored(ordered.mapInArrow(_decode_whole(model), _DECODED), "transcript-lines")
    border = decoded.filter("state is null")

    def reduce(rows):
        scores = transfer(rows.sort_values(_KEYS[1:])["symbol"].to_numpy(), model)
        return pd.DataFrame(
            {
                "conv_id": rows["conv_id"].iloc[:1].array,
                "part": rows["part"].iloc[:1].array,
                "scores": [scores.tobytes()],
            }
        )

    def join_up(rows):
        rows = rows.sort_values("part")
        shape = (len(STATES) + 1, len(STATES))
        entries, ends = chain([np.frombuffer(one).reshape(shape) for one in rows["scores"]])
        found = rows[["conv_id", "part"]].copy()
        found["entry"] = pd.Series(entries, index=found.index, dtype="Int64")
        found["last"] = ends
        return found

    def decode(rows, ends):
        rows = rows.sort_values(_KEYS[1:])
        entry = ends["entry"].iloc[0]
        states = viterbi(
            rows["symbol"].to_numpy(),
            model,
            None if pd.isna(entry) else int(entry),
            int(ends["last"].iloc[0]),
        )
        return rows.assign(state=states, turn=_turns(states))

    pieces = ["conv_id", "part"]
    scores = border.groupBy(*pieces).applyInPandas(
        reduce, "conv_id bigint, part int, scores binary"
    )
    # One row per task that a conversation reaches into.
    ends = scores.groupBy("conv_id").applyInPandas(
        join_up, "conv_id bigint, part int, entry bigint, last bigint"
    )
    found = stored(
        border.groupBy(*pieces).cogroup(ends.groupBy(*pieces)).applyInPandas(decode, _DECODED),
        "transcript-borders",
    )
    opened = F.sum(F.array_contains(F.array(*_opening()), F.col("state")).cast("bigint"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = found.groupBy(*pieces).agg(opened.alias("opened")).select(
        F.col("conv_id").alias("conversation"),
        F.col("part").alias("piece"),
        F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("turns_before"),
    )
    own = F.col("conv_id").eqNullSafe(F.col("conversation")) & (F.col("part") == F.col("piece"))
    numbered = found.join(offsets, own).withColumn("turn", F.col("turn") + F.col("turns_before"))
    return decoded.filter("state is not null").unionByName(numbered.select(*decoded.columns))


def _opening():
    return [F.lit(number) for number, (_, opens) in enumerate(STATES) if opens]


def rendered(parsed):
    """A row per turn: its role, its number of lines, and its canonical text.

    A turn is one text and so one row. Where turns may be longer than that, use the parsed lines.
    """
    # A speaker word is a marker only where a turn opens; lines that go on are kept whole.
    own = F.when(F.col("state").isin(*_opening()), content(F.col("line"))).otherwise(F.col("line"))
    line = F.struct("position", "tie", "line_no", own.alias("line"))
    lines = F.array_sort(F.collect_list(line))
    role = F.element_at(F.array(*[F.lit(role) for role, _ in STATES]), F.min("state") + 1)
    turns = parsed.groupBy("conv_id", "turn").agg(role.alias("role"), lines.alias("lines"))
    text = F.trim(F.array_join(F.transform("lines", lambda one: one["line"]), "\n"))
    return turns.select(
        "conv_id",
        "turn",
        "role",
        F.size("lines").cast("bigint").alias("n_lines"),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"),
    )


def chat_turns(conversations):
    """Transcripts of the conversations, parsed by a model that is learned from all of them."""
    lines = stored(transcript_lines(conversations), "transcripts")
    return rendered(parse(lines, train(lines)))
