"""Chat formatting with minimum-cost role repair.

A conversation is a sequence of turns with roles.  The legal sequences are those of an
automaton: an optional system turn, then user and assistant in turn, starting with user
and ending with assistant.  Dynamic programming over the automaton's states chooses for
each turn the cheapest of

* keep     its role is legal here (cost 0),
* merge    it goes on the previous turn of the same (repaired) role (1),
* relabel  it gets another role, as a turn of its own (2) or merged (3),

with empty turns inserted where the sequence needs one (3 each).  Of several sequences of
states of equal cost the one whose last state is smallest is taken, then whose last but one
is, and so on to the first, so the result is unique.  The repaired turns are then rendered.

Long conversations are not collected: turns are dealt by ranges of (conversation, turn),
each partition computes the min-plus cost matrix of its part of a conversation (states x
states), the matrices of a conversation that crosses partitions are multiplied in order,
which fixes the state at every border, and each part is then repaired on its own.  With its
costs a part tells for each last state how its ways from different first states rank in the
order above, so ties at borders are settled as within a part and the result doesn't
depend on where the borders are.  A part has at most ``BLOCK`` turns.

Defined cases: roles are trimmed and lower-cased, with the aliases in ``ALIASES``; a null
or unknown role costs a relabel wherever it goes; a null text is empty; a null
conversation id is a conversation of its own; a null turn sorts first; turns that repeat
a number are ordered by role, then text; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsmith.llm.common import written

ROLES = ["system", "user", "assistant"]
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant",
           "model": "assistant", "ai": "assistant"}
#: States: nothing yet, and the role of the last turn.
START, STATES = 0, 4
MERGE, RELABEL, INSERT = 1, 2, 3
#: Legal next states of each state.
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
BLOCK = 2_000
_FAR = 1 << 30


def _paths() -> dict[tuple[int, int], list[int]]:
    """Fewest inserted turns on the way from a state to a turn of a role: the roles between."""
    out: dict[tuple[int, int], list[int]] = {}
    for s, goal in itertools.product(range(STATES), range(1, STATES)):
        ways, done = [(s, [])], set()
        while ways:
            at, way = ways.pop(0)
            if goal in NEXT[at]:
                out[s, goal] = way
                break
            for n in NEXT[at]:
                if n not in done:
                    done.add(n)
                    ways.append((n, [*way, n]))
    return out


PATHS = _paths()


def _moves() -> dict[int, list[tuple[int, int, int, bool, list[int]]]]:
    """For the role of a turn (0: unknown): (from, to, cost, merged, inserted) of every way
    to place it."""
    out = {}
    for role in range(STATES):
        moves = []
        for s, t in itertools.product(range(STATES), range(1, STATES)):
            own = 0 if t == role else RELABEL
            if s == t:
                moves.append((s, t, own + MERGE, True, []))
            if (s, t) in PATHS:
                way = PATHS[s, t]
                moves.append((s, t, own + INSERT * len(way), False, way))
        out[role] = moves
    return out


MOVES = _moves()
#: Turns inserted after the last one: a conversation must end with assistant.
ENDING = {0: [], 1: [2, 3], 2: [3], 3: []}


def _matrix(role: int) -> np.ndarray:
    m = np.full((STATES, STATES), _FAR, np.int64)
    for s, t, cost, _, _ in MOVES[role]:
        m[s, t] = min(m[s, t], cost)
    return m


_STEP = np.stack([_matrix(r) for r in range(STATES)])
#: The move behind each entry of a step: merged ones win ties (fewer turns).
_MOVE = {(r, s, t): min((x for x in MOVES[r] if x[:2] == (s, t)), key=lambda x: (x[2], not x[3]))
         for r in range(STATES) for s in range(STATES) for t in range(STATES)
         if any(x[:2] == (s, t) for x in MOVES[r])}


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), _FAR)


def cost_matrix(roles: np.ndarray) -> np.ndarray:
    """Cheapest way from each state to each state over a run of turns."""
    m = np.where(np.eye(STATES, dtype=bool), 0, _FAR)
    for r in roles:
        m = min_plus(m, _STEP[r])
    return m


def best_states(roles: np.ndarray, start: int, end: int) -> list[int]:
    """State after each turn of the cheapest way from ``start`` to ``end``; on equal costs the
    smaller state, decided from the last turn back."""
    cost = np.full((len(roles) + 1, STATES), _FAR, np.int64)
    cost[0, start] = 0
    for i, r in enumerate(roles):
        cost[i + 1] = (cost[i][:, None] + _STEP[r]).min(0)
    out, at = [], end
    for i in range(len(roles) - 1, -1, -1):
        out.append(at)
        at = int((cost[i] + _STEP[roles[i]][:, at]).argmin())
    return out[::-1]


def tie_ranks(roles: np.ndarray) -> np.ndarray:
    """Rank of each first state (rows) among the ways to each last state (columns) through a
    run of turns, by their states from the last one back, then by the first state."""
    ranks = np.zeros((STATES, STATES), np.int64)
    for end in range(1, STATES):
        ways = [(best_states(roles, s, end)[::-1], s) for s in range(STATES)]
        for rank, (_, s) in enumerate(sorted(ways)):
            ranks[s, end] = rank
    return ranks


def border_states(costs: list[np.ndarray], ranks: list[np.ndarray]) -> list[int]:
    """Last state of each part of a conversation, from the parts' matrices."""
    ahead = [np.where(np.arange(STATES) == START, 0, _FAR)]
    for m in costs:
        ahead.append(np.minimum((ahead[-1][:, None] + m).min(0), _FAR))
    ends = [end_state(ahead[-1])]
    for i in range(len(costs) - 1, 0, -1):
        at = ends[-1]
        total = ahead[i] + costs[i][:, at]
        ends.append(int(np.lexsort((ranks[i][:, at], total))[0]))
    return ends[::-1]


def end_state(costs: np.ndarray) -> int:
    """Best last state, inserted turns at the end included."""
    return int(np.argmin([c + INSERT * len(ENDING[s]) for s, c in enumerate(costs)]))


def role_code(role) -> int:
    name = role.strip().lower() if isinstance(role, str) else ""
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


def render_open(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


CLOSE = "<|end|>\n"


def repair_run(roles: np.ndarray, texts: list[str], start: int, end: int,
               last: bool) -> list[tuple[str, int, int, str]]:
    """(action, role, inserted before, rendered piece) of every turn of a run.  The pieces of
    a conversation, one after the other, are its rendering."""
    out, at = [], start
    for r, text, to in zip(roles, texts, best_states(roles, start, end), strict=True):
        _, _, _, merged, way = _MOVE[int(r), at, to]
        relabelled = to != r
        action = ("merge" if merged else "keep") if not relabelled else (
            "relabel-merge" if merged else "relabel")
        if merged:
            piece = "\n" + text
        else:
            piece = (CLOSE if at != START else "") + "".join(
                render_open(x) + CLOSE for x in way) + render_open(to) + text
        out.append((action, to, len(way), piece))
        at = to
    if last and out:
        action, to, n, piece = out[-1]
        tail = ENDING[at]
        out[-1] = (action, to, n + len(tail),
                   piece + CLOSE + "".join(render_open(x) + CLOSE for x in tail))
    return out


def _repaired(f: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
    """Repair whole runs; ``cuts``: where each begins."""
    codes = np.array([role_code(r) for r in f["role"]], int)
    texts = [t if isinstance(t, str) else "" for t in f["text"]]
    given = f["s"].notna().to_numpy()
    s_, e_, before_, final_ = (f[c].tolist() for c in ("s", "e", "before", "final"))
    position, got = [], []
    for a, b in zip(cuts, np.r_[cuts[1:], len(f)], strict=True):
        roles, own = codes[a:b], texts[a:b]
        if given[a]:
            s, e, before, last = int(s_[a]), int(e_[a]), int(before_[a]), bool(final_[a])
        else:  # the whole conversation
            cost = np.where(np.arange(STATES) == START, 0, _FAR)
            for r in roles:
                cost = (cost[:, None] + _STEP[r]).min(0)
            s, e, before, last = START, end_state(cost), 0, True
        got += repair_run(roles, own, s, e, last)
        position += range(before, before + b - a)
    out = f[["conv_id", "turn"]].copy()
    out["position"] = position
    out["role"] = [ROLES[g[1] - 1] for g in got]
    out["action"], out["inserted"] = [g[0] for g in got], [g[2] for g in got]
    out["rendered"] = [g[3] for g in got]
    return out


def repair(conversations: DataFrame) -> DataFrame:
    """Per turn row: ``conv_id, turn, position`` (of the turn in its conversation, from 0),
    ``role`` (repaired), ``action, inserted`` (empty turns put in), ``rendered``."""
    spark = conversations.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in conversations.schema}
    order = ["conv", "turn", "role", "text"]
    rows = conversations.select(
        # null-safe name of the conversation
        F.when(F.col("conv_id").isNull(), "-").otherwise(
            F.concat(F.lit("="), F.col("conv_id").cast("string"))).alias("conv"),
        "conv_id", "turn", "role", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id())
             .withColumn("at", F.monotonically_increasing_id()))
    dealt = written(dealt, "turns")
    # parts: the run of a conversation in a block of a partition
    parted = dealt.withColumn("block", F.floor((F.col("at") % (1 << 33)) / BLOCK))

    def costs(key, f: pd.DataFrame) -> pd.DataFrame:
        roles = np.array([role_code(r) for r in f.sort_values("at")["role"]], int)
        m, ranks = cost_matrix(roles), tie_ranks(roles)
        return pd.DataFrame({"conv": [key[0]], "first": [int(f["at"].min())], "n": [len(f)],
                             "part": [key[1]], "block": [key[2]],
                             "m": [[int(x) for x in m.ravel()]],
                             "ranks": [[int(x) for x in ranks.ravel()]]})

    grouped = parted.select("conv", "part", "block", "at", "role")
    spans = grouped.groupBy("conv").agg(F.min("part").alias("p0"), F.max("part").alias("p1"),
                                        F.min("block").alias("b0"), F.max("block").alias("b1"))
    crossing = spans.where("p0 < p1 OR b0 < b1").select("conv")
    crossing = written(crossing, "crossing")
    matrices = (grouped.join(crossing, "conv", "left_semi").groupBy("conv", "part", "block")
                .applyInPandas(costs, "conv string, first long, n long, part int, block long,"
                                      " m array<long>, ranks array<long>"))

    def borders(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("first")
        ms, ranks = ([np.array(x, np.int64).reshape(STATES, STATES) for x in f[c]]
                     for c in ("m", "ranks"))
        ends = border_states(ms, ranks)
        return pd.DataFrame({"conv": f["conv"].to_numpy(), "part": f["part"].to_numpy(),
                             "block": f["block"].to_numpy(), "s": [START, *ends[:-1]], "e": ends,
                             "before": np.r_[0, np.cumsum(f["n"])[:-1]],
                             "final": [False] * (len(ms) - 1) + [True]})

    # one row per part of the few conversations that cross a border
    fixed = matrices.groupBy("conv").applyInPandas(
        borders, "conv string, part int, block long, s int, e int, before long, final boolean")
    whole = parted.join(fixed, ["conv", "part", "block"], "left")

    def fix(frames):
        keys = ["conv", "part", "block"]
        held = None
        for f in itertools.chain(frames, [None]):
            done, held = held, f
            if f is not None:
                f = f if done is None else pd.concat([done, f], ignore_index=True)
                if not len(f):
                    held = None
                    continue
                own = [f[k].to_numpy() for k in keys]
                new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in own])]
                cut = int(np.flatnonzero(new)[-1])  # the last run may go on
                done, held, new = f.iloc[:cut], f.iloc[cut:].reset_index(drop=True), new[:cut]
            elif done is not None:
                new = np.r_[True, np.zeros(len(done) - 1, bool)]
            if done is None or not len(done):
                continue
            yield _repaired(done, np.flatnonzero(new))

    dealt = (whole.repartition("conv", "part", "block")
             .sortWithinPartitions("conv", "part", "block", "at")
             .select("conv", "part", "block", "conv_id", "turn", "role", "text", "s", "e",
                     "before", "final"))
    return dealt.mapInPandas(
        fix, f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, position long, role string,"
             " action string, inserted int, rendered string")
