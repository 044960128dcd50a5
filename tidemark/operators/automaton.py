"""State machines over keyed event sequences.

The state of a key after n events is a composition of n small functions from
state to state, and composition is associative.  So a key's sequence is cut into
chunks of at most ``chunk`` events; each chunk is folded to its own state map in
parallel, the maps are scanned to find the state each chunk starts in, and the
chunks are then replayed in parallel from the right state.  No task and no array
ever holds more than ``chunk`` elements of a key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.buckets import Width
from tidemark.plans.ordered import row_numbers
from tidemark.plans.staging import staged

# The order life-cycle machine (state, event) -> state.
STATES = ("Initial", "W", "X", "Y", "Z")
TERMINAL = "Terminal"
EVENTS = ("a", "b", "c", "d", "e", "f", "g")
TRANSITIONS = {
    ("Initial", "a"): "W",
    ("Initial", "c"): "X",
    ("W", "b"): "Y",
    ("X", "b"): "Y",
    ("X", "d"): "Z",
    ("Y", "e"): "Z",
    ("Z", "g"): TERMINAL,
}


@dataclass(frozen=True)
class Machine:
    """Transition table as arrays: an illegal event keeps the state, a terminal state starts anew."""

    states: tuple[str, ...] = STATES
    events: tuple[str, ...] = EVENTS

    def target(self, state: str, event: str) -> int | None:
        to = TRANSITIONS.get((state, event))
        if to is None:
            return None
        return 0 if to == TERMINAL else self.states.index(to)

    def step_table(self) -> Column:
        """``step[state * events + event]`` = next state index."""
        return F.array(*[
            F.lit(i if self.target(s, e) is None else self.target(s, e))
            for i, s in enumerate(self.states) for e in self.events])

    def legal_table(self) -> Column:
        return F.array(*[
            F.lit(self.target(s, e) is not None) for s in self.states for e in self.events])


def alerts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], event: str, width: Width = None,
    machine: Machine = Machine(), chunk: int = 2000,
) -> DataFrame:
    """Events that are illegal in the key's state at that moment, with that state."""
    keys, order = list(keys), list(order)
    n_events = len(machine.events)
    symbol = F.array_position(F.array(*[F.lit(e) for e in machine.events]), F.col(event)) - 1
    rows = row_numbers(
        df.select(*keys, *order, event, symbol.cast("int").alias("_sym")), keys, order, width, "_rn")
    rows = rows.withColumn("_chunk", _div(F.col("_rn") - 1, chunk))

    packed = staged(rows.groupBy(*keys, "_chunk").agg(
        F.array_sort(F.collect_list(F.struct("_rn", "_sym", *order, event))).alias("_events")), "chunks")
    # An event outside the machine's alphabet, or a null one, is illegal everywhere and keeps the state.
    known = lambda sym: F.coalesce(sym, F.lit(-1)) >= 0
    cell = lambda table, state, sym: F.element_at(
        F.col(table), (state * F.lit(n_events) + F.greatest(sym, F.lit(0)) + 1).cast("int"))
    step = lambda state, sym: F.when(known(sym), cell("_step", state, sym)).otherwise(state)
    if packed.filter("_chunk > 0").isEmpty():
        # Every key fits one chunk and starts in the initial state.
        started = packed.withColumn("_start", F.lit(0))
    else:
        # Only full chunks can be followed by another one.
        folded = packed.filter(F.size("_events") == chunk).withColumn("_step", machine.step_table()).select(
            *keys, "_chunk",
            F.aggregate(
                "_events", _identity(machine),
                lambda acc, e: F.transform(acc, lambda s: step(s, e["_sym"]))).alias("_map"))
        entry = _entry_states(staged(folded, "maps"), keys, "_chunk", "_map", machine, chunk)
        started = packed.join(entry, [*keys, "_chunk"], "left").withColumn(
            "_start", F.coalesce("_entry", F.lit(0)))

    legal = lambda state, sym: F.when(known(sym), cell("_legal", state, sym)).otherwise(F.lit(False))
    alert_type = packed.schema["_events"].dataType.elementType
    fields = [f"{c}:{alert_type[c].dataType.simpleString()}" for c in [*order, event]]
    empty = F.array().cast(f"array<struct<{','.join(fields)},_state:int>>")
    replay = F.aggregate(
        "_events",
        F.struct(F.col("_start").alias("s"), empty.alias("out")),
        lambda acc, e: F.struct(
            step(acc["s"], e["_sym"]).alias("s"),
            F.when(legal(acc["s"], e["_sym"]), acc["out"]).otherwise(
                F.concat(acc["out"], F.array(F.struct(
                    *[e[c].alias(c) for c in [*order, event]], acc["s"].alias("_state"))))).alias("out")),
        lambda acc: acc["out"])
    hits = (
        started.withColumn("_step", machine.step_table()).withColumn("_legal", machine.legal_table())
        .select(*keys, F.explode(replay).alias("_hit"))
    )
    names = F.array(*[F.lit(s) for s in machine.states])
    return hits.select(
        *keys, *[F.col(f"_hit.{c}").alias(c) for c in [*order, event]],
        F.element_at(names, F.col("_hit._state") + 1).alias("state"))


def _div(col: Column, by: int) -> Column:
    return F.call_function("div", col, F.lit(by)).cast("long")


def _identity(machine: Machine) -> Column:
    return F.array(*[F.lit(i) for i in range(len(machine.states))])


def _compose(first: Column, then: Column) -> Column:
    return F.transform(first, lambda s: F.element_at(then, s + 1))


def _entry_states(
    maps: DataFrame, keys: list[str], at: str, col: str, machine: Machine, chunk: int, levels: int = 2,
) -> DataFrame:
    """State in which the piece after each mapped piece starts: ``keys, at, _entry``.

    Maps are grouped ``chunk`` at a time; a group's start state comes from the
    level above.  Three levels of 2000 cover 8e9 events of one key, and the top
    level has one array element per ``chunk ** levels`` events.
    """
    top = levels == 0
    above = F.lit(0).cast("long") if top else _div(F.col(at), chunk)
    groups = maps.withColumn("_up", above).groupBy(*keys, "_up").agg(
        F.array_sort(F.collect_list(F.struct(F.col(at).alias("at"), F.col(col).alias("map")))).alias("_maps"))
    if top:
        started = groups.withColumn("_from", F.lit(0))
    else:
        upper = groups.filter(F.size("_maps") == chunk).select(
            *keys, F.col("_up").alias("_at"),
            F.aggregate("_maps", _identity(machine), lambda acc, m: _compose(acc, m["map"])).alias("_map"))
        entry = _entry_states(upper, keys, "_at", "_map", machine, chunk, levels - 1)
        started = groups.join(entry.withColumnRenamed("_at", "_up"), [*keys, "_up"], "left").withColumn(
            "_from", F.coalesce("_entry", F.lit(0))).drop("_entry")
    walk = F.aggregate(
        "_maps",
        F.struct(F.col("_from").alias("s"),
                 F.array().cast("array<struct<at:bigint,state:int>>").alias("out")),
        lambda acc, m: F.struct(
            F.element_at(m["map"], acc["s"] + 1).alias("s"),
            F.concat(acc["out"], F.array(F.struct(
                (m["at"] + 1).alias("at"), F.element_at(m["map"], acc["s"] + 1).alias("state")))).alias("out")),
        lambda acc: acc["out"])
    return started.select(*keys, F.explode(walk).alias("_next")).select(
        *keys, F.col("_next.at").alias(at), F.col("_next.state").alias("_entry"))
