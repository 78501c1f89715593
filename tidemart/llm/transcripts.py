"""Transcripts to chat turns: a hidden Markov model recovers who speaks, turns get one rendering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.shared import saved

# fixed values: how transcripts mark speakers
MARKERS = {
    "user": ("user", "human", "question", "q", "customer", "prompt", "instruction"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "response", "model"),
    "system": ("system", "context", "setup"),
}
KINDS = {name: kind for kind, names in MARKERS.items() for name in names}
MARKER = re.compile(r"\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?([A-Za-z]{1,12})(?:\*\*|\]|\|?>)?\s*:(?:\*\*)?\s*"
                    r"|\s*(?:#{2,4}\s*|\[|<\|)([A-Za-z]{1,12})(?:\]|\|>)?\s*$")
ROWS_TOGETHER = 64      # rows of a transcript that one group of the search holds, at the most
FAN = 64                # neighbouring sums that are made one


def observe(line: str) -> tuple[str, int, str]:
    """(kind of marker or '', where the line's own text begins, its features)."""
    found = MARKER.match(line)
    kind = KINDS.get((found.group(1) or found.group(2)).lower(), "") if found else ""
    start = found.end() if kind else 0
    rest = line[start:].strip()
    return kind, start, (f"{min(len(rest).bit_length(), 12)}"
                         f"{'?' if rest.endswith('?') else ''}{'`' if rest.startswith('```') else ''}")


@dataclass(frozen=True)
class RoleModel:
    """Log probabilities: of the first role, of role after role at a boundary, and of what is seen.

    Between boundaries (row starts and marked lines) the role stays. Unseen features weigh as half
    a count.
    """
    roles: tuple[str, ...]
    start: np.ndarray
    step: np.ndarray
    marker: dict[tuple[str, str], float]
    feature: dict[tuple[str, str], float]
    floor: tuple[float, float]

    def emit(self, kind: str, features: str, boundary: bool) -> np.ndarray:
        out = np.array([self.feature.get((r, features), self.floor[1]) for r in self.roles])
        if boundary:
            out += [self.marker.get((r, kind), self.floor[0]) for r in self.roles]
        return out


@dataclass
class Line:
    row: int
    text: str
    boundary: bool
    score: np.ndarray


def lines_of(model: RoleModel, texts: list[str | None]) -> list[Line]:
    """Lines of rows; blank lines and fenced code take no marker and say nothing about the role."""
    out = []
    for row, text in enumerate(texts):
        fenced, first = False, True
        for line in (text or "").split("\n"):
            kind, start, features = ("", 0, "") if fenced else observe(line)
            boundary = first or bool(kind)
            blank = fenced or not line.strip()
            score = np.zeros(len(model.roles)) if blank and not first else model.emit(
                kind, features, boundary)
            out.append(Line(row, line[start:], boundary, score))
            fenced ^= line.lstrip().startswith("```")
            first = False
    return out


def passage(model: RoleModel, lines: list[Line]) -> np.ndarray:
    """Best log weight from the role before the lines to the role of the last one."""
    total = np.where(np.eye(len(model.roles), dtype=bool), 0.0, -np.inf)
    for line in lines:
        if line.boundary:
            total = (total[:, :, None] + model.step[None]).max(axis=1)
        total = total + line.score
    return total


def viterbi(model: RoleModel, lines: list[Line], before: int | None, last: int | None) -> list[int]:
    """The best roles of the lines, given the role before them and that of the last line.

    Ties go to the role that is first. Without a role before, the first line begins a transcript.
    """
    best, back = None, []
    for i, line in enumerate(lines):
        n = len(model.roles)
        if i == 0:
            move = model.start if before is None else model.step[before]
            best, came = move.copy(), np.zeros(n, np.int64)
        elif line.boundary:
            both = best[:, None] + model.step
            came, best = both.argmax(axis=0), both.max(axis=0)
        else:
            came = np.arange(n)
        best = best + line.score
        back.append(came)
    state = int(best.argmax()) if last is None else last
    path = [state]
    for came in back[:0:-1]:
        state = int(came[state])
        path.append(state)
    return path[::-1]


def turns(roles: tuple[str, ...], lines: list[Line], path: list[int]) -> list[tuple[int, int, str, str]]:
    """(row, part, role, text): a turn begins with a row, at a marker and where the role changes."""
    out: list[tuple[int, int, str, list[str]]] = []
    for i, (line, state) in enumerate(zip(lines, path)):
        same_row = bool(out) and out[-1][0] == line.row
        if not same_row or line.boundary or path[i - 1] != state:
            part = out[-1][1] + 1 if same_row else 0
            out.append((line.row, part, roles[state], []))
        out[-1][3].append(line.text)
    return [(row, part, role, "\n".join(texts).strip()) for row, part, role, texts in out]


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def fit(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
        text: str = "text") -> RoleModel:
    """Count markers, line features and role changes over rows whose role is known.

    Role changes: of rows numbered one after another. Rows without a role count for nothing; no
    rows give a model of one role, `user`. Roles are taken to be few; only counts by role reach the
    driver.
    """
    known = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"),
                        F.col(role).alias("role"), F.col(text).alias("text")).where(
                            "role IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for who, what in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                fenced = False
                for i, line in enumerate((what or "").split("\n")):
                    kind, _, features = ("", 0, "") if fenced else observe(line)
                    if i == 0 or kind:
                        seen["marker", who, kind] += 1
                    if line.strip() and not fenced:
                        seen["feature", who, features] += 1
                    fenced ^= line.lstrip().startswith("```")
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in seen], pa.string()) for i in range(3)]
            + [pa.array(list(seen.values()), pa.int64())], names=["what", "role", "value", "n"])

    counted = known.select("role", "text").mapInArrow(
        count, "what string, role string, value string, n bigint").groupBy(
            "what", "role", "value").agg(F.sum("n").alias("n")).collect()
    # repeated turns are counted before they meet the next ones
    here = known.groupBy("conv", "turn", "role").agg(F.count(F.lit(1)).alias("n"))
    after = here.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"),
                        F.col("n").alias("m"))
    changes = here.join(after, ["conv", "turn"]).groupBy("role", "next").agg(
        F.sum(F.col("n") * F.col("m")).alias("count")).collect()
    begins = known.where("turn = 0").groupBy("role").count().collect()
    roles = tuple(sorted({r["role"] for r in counted})) or ("user",)
    start, step = np.full(len(roles), 0.5), np.full((len(roles), len(roles)), 0.5)
    for r in begins:
        start[roles.index(r["role"])] += r["count"]
    for r in changes:
        step[roles.index(r["role"]), roles.index(r["next"])] += r["count"]
    totals: Counter = Counter()
    for r in counted:
        totals[r["what"], r["role"]] += r["n"]
    chance = {(r["what"], r["role"], r["value"]): float(np.log(
        (r["n"] + 0.5) / (totals[r["what"], r["role"]] + 10))) for r in counted}
    floor = tuple(float(np.log(0.5 / (max([totals[w, r] for r in roles]) + 10)))
                  for w in ("marker", "feature"))
    return RoleModel(roles, np.log(start / start.sum()), np.log(step / step.sum(axis=1)[:, None]),
                     {k[1:]: v for k, v in chance.items() if k[0] == "marker"},
                     {k[1:]: v for k, v in chance.items() if k[0] == "feature"}, floor)


def placed_in_order(rows: DataFrame, conv: str, turn: str, text: str) -> DataFrame:
    """(conv, turn, text, place, group): places from 0 in the order of all transcripts, without gaps.

    Rows are sorted by ranges of (transcript, turn, hash of the text, where they stood), so that
    neither a long transcript nor equal rows are gathered in one task. A group is a transcript's
    share of ROWS_TOGETHER places.
    """
    keys = ("conv", F.col("turn").asc_nulls_first(), "tie", "stood")
    ranged = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(text).alias("text"),
        F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("stood")
    ).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id: the task in the upper bits, its rows counted in the lower 33
    held = saved(ranged.select("conv", "turn", "text",
                               F.monotonically_increasing_id().alias("id")), "transcripts")
    task = F.shiftright("id", 33).alias("task")
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = held.groupBy(task).agg(F.count(F.lit(1)).alias("n")).select(
        "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    # one row per task of the sort
    held = held.withColumn("task", task).join(F.broadcast(begins), "task")
    place = F.col("begin") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    return held.select("conv", "turn", "text", place.alias("place"),
                       F.floor(place / ROWS_TOGETHER).cast("bigint").alias("group"))


def joined_up(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """Best weights over two stretches one after the other; `first` may be a vector or a matrix."""
    return (first[..., :, None] + then).max(axis=-2)


def ends_of(openings: list[np.ndarray], weights: list[np.ndarray], before: int | None,
            last: int | None) -> list[int]:
    """The last role of each stretch on the best path from `before` to `last`; None: any."""
    best, back = openings[0] if before is None else weights[0][before], []
    for w in weights[1:]:
        both = best[:, None] + w
        back.append(both.argmax(axis=0))
        best = both.max(axis=0)
    ends = [int(best.argmax()) if last is None else last]
    for came in reversed(back):
        ends.append(int(came[ends[-1]]))
    return ends[::-1]


def parse(rows: DataFrame, model: RoleModel, conv: str = "conv_id", turn: str = "turn",
          text: str = "text") -> DataFrame:
    """(conv, turn, part, role, text, rendered): the turns that each row of a transcript holds.

    Rows of a transcript are read in the order of `turn` (null first), equal ones by a hash of the
    text; texts are split into lines. Null and empty texts are one empty turn. Rows without a
    transcript's name are one transcript. No rows: no turns.

    The best path over a whole transcript is found in a tree, so that a transcript of any length is
    spread over tasks: a group of rows is summed up as the best weights from role to role, FAN
    neighbouring sums as one, and so on until a transcript is one sum; from there the roles at the
    ends are handed down, and each group of rows is solved between its own. No task holds more than
    ROWS_TOGETHER rows or FAN sums of a group.
    """
    placed = saved(placed_in_order(rows, conv, turn, text), "placed")
    n = len(model.roles)
    key = placed.schema["conv"].dataType
    fields = [T.StructField("conv", key), T.StructField("group", T.LongType())]
    sum_schema = T.StructType([*fields, T.StructField("weights", T.ArrayType(T.DoubleType())),
                               T.StructField("opening", T.ArrayType(T.DoubleType()))])
    end_schema = T.StructType([*fields, T.StructField("before", T.IntegerType()),
                               T.StructField("last", T.IntegerType())])

    def summed(conv_column: pa.ChunkedArray, group: int, weights: np.ndarray, opening: np.ndarray
               ) -> pa.Table:
        return pa.table({"conv": conv_column[:1], "group": pa.array([group], pa.int64()),
                         "weights": pa.array([weights.ravel().tolist()], pa.list_(pa.float64())),
                         "opening": pa.array([opening.tolist()], pa.list_(pa.float64()))})

    def of_rows(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        lines = lines_of(model, table.column("text").to_pylist())
        opening = joined_up(model.start + lines[0].score, passage(model, lines[1:]))
        return summed(table.column("conv"), table.column("group")[0].as_py(),
                      passage(model, lines), opening)

    def values(table: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return ([np.array(x) for x in table.column("opening").to_pylist()],
                [np.array(w).reshape(n, n) for w in table.column("weights").to_pylist()])

    def of_sums(table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        openings, weights = values(table)
        opening, total = openings[0], weights[0]
        for w in weights[1:]:
            opening, total = joined_up(opening, w), joined_up(total, w)
        return summed(table.column("conv"), table.column("group")[0].as_py() // FAN, total, opening)

    def hand_down(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        before, last = above.column("before")[0].as_py(), above.column("last")[0].as_py()
        ends = ends_of(*values(table), before, last)
        return pa.table({"conv": table.column("conv"), "group": table.column("group"),
                         "before": pa.array([before, *ends[:-1]], pa.int32()),
                         "last": pa.array(ends, pa.int32())})

    def solve(table: pa.Table, above: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        lines = lines_of(model, table.column("text").to_pylist())
        path = viterbi(model, lines, above.column("before")[0].as_py(),
                       above.column("last")[0].as_py())
        found = turns(model.roles, lines, path)
        rows_of = pa.array([f[0] for f in found], pa.int64())
        return pa.table({
            "conv": table.column("conv").take(rows_of), "turn": table.column("turn").take(rows_of),
            "part": pa.array([f[1] for f in found], pa.int32()),
            "role": pa.array([f[2] for f in found], pa.string()),
            "text": pa.array([f[3] for f in found], pa.string()),
            "rendered": pa.array([render(f[2], f[3]) for f in found], pa.string())})

    over = F.floor(F.col("group") / FAN).cast("bigint").alias("over")
    free = [F.lit(None).cast("int").alias("before"), F.lit(None).cast("int").alias("last")]
    spans = saved(placed.groupBy("conv").agg(F.min("group").alias("group"), F.max("group").alias("end")),
                  "spans")
    # a transcript within one group has nothing to hand down
    short = spans.where(F.col("group") == F.col("end")).select("conv", "group", *free)
    long = saved(spans.where("group < end").select(F.col("conv").alias("c")), "long")
    split = placed.join(long, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    tiers = [saved(split.groupBy("conv", "group").applyInArrow(of_rows, sum_schema), "sums")]
    transcripts = long.count()
    while tiers[-1].count() > transcripts:
        tiers.append(saved(tiers[-1].groupBy("conv", over).applyInArrow(of_sums, sum_schema), "sums"))
    # above the last tier nothing is fixed: any role before and any at the end
    ends = tiers[-1].select("conv", over.alias("group"), *free)
    for tier in reversed(tiers):
        ends = tier.groupBy("conv", over).cogroup(ends.groupBy("conv", "group")).applyInArrow(
            hand_down, end_schema)
    ends = ends.unionByName(short)
    return placed.groupBy("conv", "group").cogroup(ends.groupBy("conv", "group")).applyInArrow(
        solve, T.StructType([
            T.StructField("conv", key), T.StructField("turn", placed.schema["turn"].dataType),
            T.StructField("part", T.IntegerType()), T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()), T.StructField("rendered", T.StringType())])
    ).withColumnRenamed("conv", conv).withColumnRenamed("turn", turn)


def as_transcript(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text", bare: int = 5, seed: int = 29) -> DataFrame:
    """Turns with known roles as rows of raw transcripts: markers in several styles, one in `bare`
    without any."""
    h = F.pmod(F.xxhash64(F.col(conv), F.col(turn), F.lit(seed)), F.lit(1 << 30))
    style = F.pmod(F.xxhash64(F.col(conv), F.lit(seed)), F.lit(3))
    names = {r: F.element_at(F.array(*map(F.lit, m[:3])), (style + 1).cast("int"))
             for r, m in MARKERS.items()}
    name = F.col(role)
    for r, column in names.items():
        name = F.when(F.col(role) == r, column).otherwise(name)
    mark = F.when(h % bare == 0, F.lit("")).when(
        style == 0, F.concat(F.initcap(name), F.lit(": "))).when(
        style == 1, F.concat(F.lit("### "), F.initcap(name), F.lit(":\n"))).otherwise(
        F.concat(F.lit("["), name, F.lit("]: ")))
    return rows.withColumn(text, F.concat(F.coalesce(mark, F.lit("")),
                                          F.coalesce(F.col(text), F.lit(""))))
