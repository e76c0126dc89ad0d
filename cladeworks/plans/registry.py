"""Exchangeable strategies by kind and name, and the choice among them by size."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from importlib import import_module, metadata


class EngineError(Exception):
    """Base of the errors a user can act on."""


class InputError(EngineError):
    """Options or tables that do not fit."""


class UnknownStrategy(EngineError):
    """A name that is not registered."""


class SourceError(EngineError):
    """A source that cannot be read or fetched."""


class FormatError(SourceError):
    """A source that can be read but does not hold what it should."""


class StageError(EngineError):
    """A stage whose input tables do not fit together."""


@dataclass(frozen=True)
class Capability:
    name: str
    most: int | None = None  # records it is advised for; None: no bound
    native: bool = True  # scales by itself
    defaults: dict = field(default_factory=dict)


class Registry:
    """Strategies of one kind. Those given as 'module:object' are loaded when first used."""

    def __init__(self, kind: str):
        self.kind, self._caps, self._made = kind, {}, {}

    def add(self, cap: Capability, made: Callable | str) -> None:
        self._caps[cap.name], self._made[cap.name] = cap, made

    def discover(self, group: str) -> None:
        """Add what installed packages offer under an entry-point group; broken ones fail only when used."""
        for e in metadata.entry_points(group=group):
            self._caps.setdefault(e.name, Capability(e.name))
            self._made.setdefault(e.name, e.value)

    def names(self) -> list[str]:
        return sorted(self._caps)

    def capability(self, name: str) -> Capability:
        if name not in self._caps:
            raise UnknownStrategy(f"no {self.kind} named {name}; there are {', '.join(self.names())}")
        return self._caps[name]

    def get(self, name: str) -> Callable:
        self.capability(name)
        made = self._made[name]
        if isinstance(made, str):
            module, _, attr = made.partition(":")
            made = self._made[name] = getattr(import_module(module), attr)
        return made

    def choose(self, n: int) -> str:
        """The strategy for n records: one that is advised for so many, then native ones, then most room, then by name."""
        def key(c: Capability):
            room = float("inf") if c.most is None else c.most
            return (room >= n, c.native, room), [-ord(x) for x in c.name]

        if not self._caps:
            raise UnknownStrategy(f"no {self.kind} is registered")
        return max(self._caps.values(), key=key).name

    def warning(self, name: str, n: int) -> str | None:
        most = self.capability(name).most
        if most is None or n <= most:
            return None
        return f"{name} is advised for up to {most} records, not {n}; {self.choose(n)} suits better"


dereplicators = Registry("dereplicator")
dereplicators.add(Capability("sketch"), "cladeworks.plans.dereplicate:by_sketch")
dereplicators.add(Capability("edges"), "cladeworks.plans.dereplicate:by_edges")
aligners = Registry("aligner")
aligners.add(Capability("blocks"), "cladeworks.operators.alignment:project_blocks")
aligners.add(Capability("xmfa"), "cladeworks.operators.alignment:project_xmfa")
tree_builders = Registry("tree builder")
tree_builders.add(Capability("neighbour-joining", most=10_000), "cladeworks.operators.trees:nj_tree")
