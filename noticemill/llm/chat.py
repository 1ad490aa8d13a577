"""Chat formatting: minimum-cost repair of role sequences, then rendering.

Legal conversations are walks of a small automaton (system?, then user and assistant in turn, tools answering assistants).
For each raw role, a matrix holds the least cost of consuming such a turn between any two states: keep it, give it another
role, merge it into the turn before, or insert empty turns first.  Repairing a conversation is a shortest path, and since
(min, +) products of matrices are associative, a conversation need not lie in one task: rows are range-partitioned by
conversation and turn, every partition multiplies its own matrices, and only the conversations that cross a partition border,
two a partition at most, exchange a matrix.  Ties go to the raw role, then to the lower role, whatever the partitioning.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

# Roles by code, and other names of them.  Code 0 is the state before any turn; 5 is an unknown raw role.
ROLES = ("", "system", "user", "assistant", "tool")
ALIASES = {"developer": "system", "human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant", "function": "tool"}
UNKNOWN = 5
#: Roles that may follow each state.
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2, 4), 4: (3,)}
LAST = 3
_FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 2
    relabel: int = 3
    name: int = 1  # give an unknown role a name
    insert: int = 4


@functools.lru_cache(maxsize=8)
def ways(costs: Costs) -> tuple[np.ndarray, dict[tuple[int, int, int], tuple[str, tuple[int, ...]]], np.ndarray, list[tuple[int, ...]]]:
    """Cost by (raw role, state, role), the action of each, and the cost and turns of ending in each state."""
    between: dict[tuple[int, int], tuple[int, ...]] = {}
    for start in range(5):
        reach = {0: [(start, ())]}
        seen: dict[int, tuple[int, ...]] = {}
        for depth in range(5):
            for state, path in reach.get(depth, []):
                for role in NEXT[state]:
                    if role not in seen:
                        seen[role] = path
                        reach.setdefault(depth + 1, []).append((role, (*path, role)))
        for role, path in seen.items():
            between[start, role] = path
    cost = np.full((6, 5, 5), _FAR, dtype=np.int64)
    action: dict[tuple[int, int, int], tuple[str, tuple[int, ...]]] = {}
    for raw in range(1, 6):
        for role in range(1, 5):
            change = 0 if raw == role else costs.name if raw == UNKNOWN else costs.relabel
            word = "keep" if raw == role else "relabel"
            for state in range(5):
                if (state, role) in between:
                    path = between[state, role]
                    cost[raw, state, role] = change + costs.insert * len(path)
                    action[raw, state, role] = (word, path)
                if state == role and change + costs.merge < cost[raw, state, role]:
                    cost[raw, state, role] = change + costs.merge
                    action[raw, state, role] = ("merge", ())
    close = [() if s in (0, LAST) else (*between[s, LAST], LAST) for s in range(5)]
    return cost, action, np.array([costs.insert * len(c) for c in close], dtype=np.int64), close


def product(codes: np.ndarray, costs: Costs) -> np.ndarray:
    """Least costs between all states over a run of turns."""
    cost = ways(costs)[0]
    total = np.where(np.eye(5, dtype=bool), 0, _FAR)
    for c in codes:
        total = np.minimum((total[:, :, None] + cost[c][None, :, :]).min(1), _FAR)
    return total


def rest_costs(codes: np.ndarray, end: np.ndarray, costs: Costs) -> np.ndarray:
    """Least cost from each state before each turn to the end of the conversation; the last row is ``end``."""
    cost = ways(costs)[0]
    out = np.empty((len(codes) + 1, 5), dtype=np.int64)
    out[-1] = end
    for i in range(len(codes) - 1, -1, -1):
        out[i] = np.minimum((cost[codes[i]] + out[i + 1][None, :]).min(1), _FAR)
    return out


def walk(codes: np.ndarray, start: int, rest: np.ndarray, costs: Costs) -> list[int]:
    """The roles of the best repair from state ``start``."""
    cost, out, state = ways(costs)[0], [], start
    for i, c in enumerate(codes):
        onward = cost[c][state] + rest[i + 1]
        best = onward.min()
        state = int(c) if c < UNKNOWN and onward[c] == best else int(onward.argmin())
        out.append(state)
    return out


@functools.lru_cache(maxsize=1 << 14)
def best_roles(codes: bytes, costs: Costs) -> list[int]:
    """The roles of the best repair of a whole conversation; most conversations share their sequence of roles with others."""
    c = np.frombuffer(codes, dtype=np.uint8)
    return walk(c, 0, rest_costs(c, ways(costs)[2], costs), costs)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[tuple[int, int]]]]:
    """The partition's rows with the bounds of each conversation in them; a conversation is never cut between two frames."""
    kept: list[pd.DataFrame] = []

    def bounded(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[tuple[int, int]]]:
        names = pdf["conv"].to_numpy()
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(pdf)]
        return pdf, list(zip(cuts, cuts[1:], strict=False))

    for pdf in batches:
        if not len(pdf):
            continue
        names = pdf["conv"].to_numpy()
        other = np.flatnonzero(names != names[-1])
        first = int(other[-1]) + 1 if len(other) else 0  # of the last conversation
        if kept and (first or kept[-1]["conv"].iloc[-1] != names[0]):
            kept.append(pdf.iloc[:first])
            yield bounded(pd.concat(kept, ignore_index=True))
            kept = []
        elif first:
            yield bounded(pdf.iloc[:first])
        kept.append(pdf.iloc[first:])
    if kept:
        yield bounded(pd.concat(kept, ignore_index=True))


def role_code(role: Column) -> Column:
    name = F.lower(F.trim(role))
    known = {n: i for i, n in enumerate(ROLES) if i} | {a: ROLES.index(r) for a, r in ALIASES.items()}
    code = F.element_at(F.create_map(*[x for k, v in known.items() for x in (F.lit(k), F.lit(v))]), name)
    return F.coalesce(code, F.lit(UNKNOWN))


def repair(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """One row for each row of ``turns`` (conv_id, turn, role, text): its place, its role after the repair and its rendering.

    Columns: conv_id, turn, seq (place in the conversation, from 0), role, new_role, action (keep, relabel or merge),
    inserted_before and inserted_after (roles of empty turns), piece.  A conversation's pieces in the order of seq make up
    its rendering.  Turns are ordered by number, nulls last; turns of equal number by a hash of role and text.  A null role
    or one that is not known is unknown and cheap to name; a null text counts as empty; rows with a null conv_id are one
    conversation.  An empty table gives an empty result; other columns are not read.
    """
    tie = F.xxhash64("role", "text")
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("null"))
    rows = turns.select("conv_id", "turn", "role", "text", conv.alias("conv"), role_code(F.col("role")).alias("code"))
    rows = rows.withColumns({"last": F.col("turn").isNull(), "tie": tie, "row": F.monotonically_increasing_id()})
    order = ["conv", "last", "turn", "tie", "row"]
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("last", "row").withColumn("pid", F.spark_partition_id()))
    codes = placed.select("pid", "conv", "code")

    def border(pdf: pd.DataFrame, a: int, b: int) -> tuple:
        return int(pdf["pid"].iloc[0]), pdf["conv"].iloc[a], b - a, product(pdf["code"].to_numpy()[a:b], costs).ravel()

    def borders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends: list[tuple] = []
        last = None
        for pdf, runs in _segments(batches):
            for a, b in (runs[:1] if last is None else []):
                ends.append(border(pdf, a, b))
            last = (pdf, *runs[-1])
        if last is not None and last[0]["conv"].iloc[last[1]] != ends[0][1]:
            ends.append(border(*last))
        yield pd.DataFrame(ends, columns=["pid", "conv", "n", "m"])

    # at most two rows a partition
    shared: dict[str, list] = {}
    for r in sorted(codes.mapInPandas(borders, "pid int, conv string, n long, m array<long>").collect()):
        shared.setdefault(r.conv, []).append(r)
    shared = {k: v for k, v in shared.items() if len(v) > 1}
    ending: dict[tuple[int, str], list[int]] = {}
    for name, parts in shared.items():
        rest = ways(costs)[2]
        for r in reversed(parts):
            ending[r.pid, name] = rest.tolist()
            rest = (np.array(r.m).reshape(5, 5) + rest[None, :]).min(1)

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, runs in _segments(batches):
            pid, names, codes = int(pdf["pid"].iloc[0]), pdf["conv"].to_numpy(), pdf["code"].to_numpy()
            for a, b in runs:
                name, c = names[a], codes[a:b]
                if (pid, name) not in ending:
                    continue
                rest = rest_costs(c, np.array(ending[pid, name]), costs)
                yield pd.DataFrame([(pid, name, [walk(c, s, rest, costs)[-1] for s in range(5)])], columns=["pid", "conv", "exits"])

    starting: dict[tuple[int, str], tuple[int, int, bool]] = {}
    if shared:
        leads = {(r.pid, r.conv): r.exits for r in codes.mapInPandas(exits, "pid int, conv string, exits array<int>").collect()}
        for name, parts in shared.items():
            state, ahead = 0, 0
            for r in parts:
                starting[r.pid, name] = (state, ahead, r is parts[-1])
                state, ahead = leads[r.pid, name][state], ahead + r.n

    def repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, action, _, close = ways(costs)
        for pdf, runs in _segments(batches):
            pid, names, codes = int(pdf["pid"].iloc[0]), pdf["conv"].to_numpy(), pdf["code"].to_numpy()
            seq, roles, words, before = [], [], [], []
            after, ends = [[]] * len(pdf), np.zeros(len(pdf), dtype=bool)
            for a, b in runs:
                c = codes[a:b]
                start, ahead, is_last = starting.get((pid, names[a]), (0, 0, True))
                if (pid, names[a]) in ending:
                    states = walk(c, start, rest_costs(c, np.array(ending[pid, names[a]]), costs), costs)
                else:
                    states = best_roles(c.astype(np.uint8).tobytes(), costs)
                for r, s, t in zip(c.tolist(), [start, *states], states, strict=False):
                    word, path = action[r, s, t]
                    words.append(word)
                    before.append([ROLES[x] for x in path])
                    roles.append(ROLES[t])
                seq.extend(range(ahead, ahead + b - a))
                ends[b - 1] = is_last
                if is_last:
                    after[b - 1] = [ROLES[x] for x in close[states[-1]]]
            out = pdf.drop(columns=["pid", "conv", "code"])
            yield out.assign(seq=seq, new_role=roles, action=words, inserted_before=before, inserted_after=after, ends=ends)

    # ids and turn numbers travel as text: pandas has no whole numbers beside nulls
    plain = placed.select(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "pid", "conv", "code")
    schema = "conv_id string, turn string, role string, text string, seq long, new_role string, action string, inserted_before array<string>, inserted_after array<string>, ends boolean"
    done = plain.mapInPandas(repaired, schema)
    kinds = dict(turns.dtypes)
    opened = lambda role: F.concat(F.lit("<|"), role, F.lit("|>\n"))
    shut = F.lit("<|end|>\n")
    empty = lambda roles: F.array_join(F.transform(roles, lambda r: F.concat(opened(r), shut)), "")
    body = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |"))
    first = F.when(F.col("seq") > 0, shut).otherwise(F.lit(""))
    piece = F.when(F.col("action") == "merge", F.concat(F.lit("\n"), body)).otherwise(
        F.concat(first, empty(F.col("inserted_before")), opened(F.col("new_role")), body)
    )
    piece = F.concat(piece, F.when(F.col("ends"), F.concat(shut, empty(F.col("inserted_after")))).otherwise(F.lit("")))
    return done.select(
        F.col("conv_id").cast(kinds["conv_id"]).alias("conv_id"),
        F.col("turn").cast(kinds["turn"]).alias("turn"),
        "seq",
        "role",
        "new_role",
        "action",
        "inserted_before",
        "inserted_after",
        piece.alias("piece"),
    )
