"""Workflow states: allowed transitions, and transitions as functions.

A request for state ``r`` maps every current state to the state after it: ``r``
where the move is allowed, the current state where it is blocked.  Such a
mapping over the six states packs into 18 bits of a LONG (three bits per
state), and two mappings compose into a third.  Composition is associative,
which lets a long history be folded in pieces.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerleaf import constants as C
from ledgerleaf.functions.common import by_value, literal_array, literal_map, no_strings

BITS = 3
MASK = (1 << BITS) - 1


def current_state(col: Column) -> Column:
    """A document without a state counts as new."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(C.NEW))


def can_transition(current: Column, new: Column) -> Column:
    allowed = by_value(
        current, {state: literal_array(to) for state, to in C.TRANSITIONS.items()}, no_strings()
    )
    return F.coalesce(F.array_contains(allowed, new), F.lit(False))


def transition_error(current: Column, new: Column) -> Column:
    shown = F.coalesce(new, F.lit("None"))
    return F.when(~can_transition(current, new), F.format_string(C.MSG_TRANSITION, current, shown))


def _pack(targets) -> int:
    return sum(target << (BITS * start) for start, target in enumerate(targets))


IDENTITY = _pack(range(len(C.STATES)))


def request_mapping(requested: Column) -> Column:
    """The packed mapping of one request; an unknown state blocks everywhere."""
    table = {}
    for code, state in enumerate(C.STATES):
        moved = [
            code if state in C.TRANSITIONS[start] else start_code
            for start_code, start in enumerate(C.STATES)
        ]
        table[state] = _pack(moved)
    found = F.try_element_at(literal_map(table), requested)
    return F.coalesce(found, F.lit(IDENTITY)).cast("long")


def apply_mapping(mapping: Column, code: Column) -> Column:
    """State code after ``mapping`` when the document is in state ``code``."""
    return F.call_function("shiftright", mapping, (code * BITS).cast("int")).bitwiseAND(F.lit(MASK).cast("long"))


def compose(first: Column, then: Column) -> Column:
    """The packed mapping of doing ``first`` and afterwards ``then``."""
    parts = [
        F.shiftleft(
            apply_mapping(then, apply_mapping(first, F.lit(start).cast("long"))), BITS * start
        )
        for start in range(len(C.STATES))
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def state_code(state: Column) -> Column:
    codes = {name: code for code, name in enumerate(C.STATES)}
    return F.try_element_at(literal_map(codes), state).cast("long")


def state_name(code: Column) -> Column:
    return F.get(literal_array(C.STATES), code.cast("int"))
