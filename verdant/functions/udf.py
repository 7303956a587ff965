"""How Arrow functions enter a plan."""

from __future__ import annotations


def once(function):
    """The function marked so that Catalyst evaluates it where it stands.

    A filter on the result of a deterministic Python function is pushed below the projection
    with a copy of the call, and the work is done twice.
    """
    return function.asNondeterministic()
