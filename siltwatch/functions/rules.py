"""Field rules of a log format and their Spark predicates."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltwatch.functions.network import is_ip

# Field names with a set role.
REQUIRED_NAMES = ("ts", "src_ip")
RESERVED_NAMES = ("logline_id", "batch_id")

# Strptime directives and their Spark pattern letters.
DIRECTIVES = {
    "Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss",
    "f": "SSSSSS", "y": "yy", "b": "MMM", "B": "MMMM", "j": "DDD", "z": "XX", "p": "a", "I": "hh",
}


def spark_time_pattern(fmt: str) -> str:
    """Spark datetime pattern of a strptime format; other letters become literals."""
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            letter = fmt[i + 1]
            if letter == "%":
                out.append("'%'")
            elif letter in DIRECTIVES:
                out.append(DIRECTIVES[letter])
            else:
                raise ValueError(f"unsupported time directive %{letter}")
            i += 2
        else:
            out.append(f"'{fmt[i]}'" if fmt[i].isalpha() else "''" if fmt[i] == "'" else fmt[i])
            i += 1
    return "".join(out)


@dataclass(frozen=True)
class Rule:
    """One named field; ``test`` maps its text column to a never-null predicate."""

    name: str

    def test(self, col: Column) -> Column:
        raise NotImplementedError


@dataclass(frozen=True)
class RegEx(Rule):
    pattern: str

    def test(self, col: Column) -> Column:
        return F.coalesce(col.rlike(f"^(?:{self.pattern})"), F.lit(False))


@dataclass(frozen=True)
class Timestamp(Rule):
    format: str

    def parse(self, col: Column) -> Column:
        """Event time, trying 1-6 fraction digits when the format has a fraction."""
        return F.try_to_timestamp(col, F.lit(spark_time_pattern(self.format)))

    def test(self, col: Column) -> Column:
        return self.parse(col).isNotNull()


@dataclass(frozen=True)
class IpAddress(Rule):
    def test(self, col: Column) -> Column:
        return is_ip(col)


@dataclass(frozen=True)
class ListItem(Rule):
    allowed: tuple = ()
    relevant: tuple | None = None

    def test(self, col: Column) -> Column:
        return F.coalesce(col.isin(list(self.allowed)), F.lit(False))

    def is_relevant(self, col: Column) -> Column:
        return F.coalesce(col.isin(list(self.relevant)), F.lit(False)) if self.relevant else F.lit(True)


def _one_text(name: str, kind: str, args: Sequence) -> str:
    if len(args) != 1 or not isinstance(args[0], str):
        raise ValueError(f"{kind} field {name!r} takes one text argument")
    return args[0]


def _regex(name, args):
    pattern = _one_text(name, "RegEx", args)
    re.compile(pattern)
    return RegEx(name, pattern)


def _timestamp(name, args):
    fmt = _one_text(name, "Timestamp", args)
    spark_time_pattern(fmt)
    return Timestamp(name, fmt)


def _address(name, args):
    if args:
        raise ValueError(f"IpAddress field {name!r} takes no arguments")
    return IpAddress(name)


def _list_item(name, args):
    if len(args) not in (1, 2) or not all(isinstance(a, (list, tuple)) or a is None for a in args):
        raise ValueError(f"ListItem field {name!r} takes an allowed and maybe a relevant list")
    if args[0] is None:
        raise ValueError(f"ListItem field {name!r} needs an allowed list")
    allowed = tuple(args[0])
    relevant = tuple(args[1]) if len(args) == 2 and args[1] is not None else None
    if relevant and not set(relevant) <= set(allowed):
        raise ValueError(f"relevant values of {name!r} must be allowed values")
    return ListItem(name, allowed, relevant)


KINDS: dict[str, Callable[[str, Sequence], Rule]] = {
    "RegEx": _regex,
    "Timestamp": _timestamp,
    "IpAddress": _address,
    "ListItem": _list_item,
}


def rule_from_entry(entry: Sequence) -> Rule:
    if len(entry) < 2 or not isinstance(entry[0], str):
        raise ValueError(f"a field needs a name and a class: {entry!r}")
    name, kind, *args = entry
    if kind not in KINDS:
        raise ValueError(f"unknown field class {kind!r}")
    return KINDS[kind](name, args)


@dataclass(frozen=True)
class LogFormat:
    """Ordered, checked set of field rules of one collector."""

    rules: tuple[Rule, ...] = field(default=())

    @classmethod
    def parse(cls, entries: Sequence[Sequence]) -> "LogFormat":
        if not entries:
            raise ValueError("a log format needs fields")
        rules = tuple(rule_from_entry(e) for e in entries)
        names = [r.name for r in rules]
        if len(set(names)) != len(names):
            raise ValueError("field names must be unique")
        if set(names) & set(RESERVED_NAMES):
            raise ValueError(f"reserved field names: {RESERVED_NAMES}")
        missing = [n for n in REQUIRED_NAMES if n not in names]
        if missing:
            raise ValueError(f"required fields are missing: {missing}")
        return cls(rules)

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    def rule(self, name: str) -> Rule:
        return next(r for r in self.rules if r.name == name)

    def schema(self) -> str:
        """Text schema for ``from_json``; a missing field reads as null."""
        return ", ".join(f"`{n}` string" for n in self.names)

    def failed_fields(self, value: Callable[[str], Column]) -> Column:
        """Names of the fields that break their rule, in format order."""
        checks = [F.when(~r.test(value(r.name)), F.lit(r.name)) for r in self.rules]
        return F.array_compact(F.array(*checks))

    def all_valid(self, value: Callable[[str], Column]) -> Column:
        return reduce(lambda a, b: a & b, [r.test(value(r.name)) for r in self.rules])


Relevance = Callable[[LogFormat], Column]
RELEVANCE: dict[str, Relevance] = {}


def relevance(name: str) -> Callable[[Relevance], Relevance]:
    """Register a relevance method ``format -> predicate`` under a name."""

    def add(fn: Relevance) -> Relevance:
        RELEVANCE[name] = fn
        return fn

    return add


def relevance_predicate(name: str, fmt: LogFormat) -> Column:
    if name not in RELEVANCE:
        raise ValueError(f"relevance method {name!r} is not registered")
    return RELEVANCE[name](fmt)


@relevance("check_dga_relevance")
def _listed_values(fmt: LogFormat) -> Column:
    tests = [r.is_relevant(F.col(r.name)) for r in fmt.rules if isinstance(r, ListItem) and r.relevant]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


@relevance("no_relevance_check")
def _everything(fmt: LogFormat) -> Column:
    return F.lit(True)
