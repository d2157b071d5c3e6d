"""Named, ordered, explainable classification rules as data, compiled to one column expression.

Which rules apply is the caller's policy; none is built in.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Match:
    """One matcher: folders, fragments, extensions, pattern, terms, keywords, or a field's values (``kind`` then is field:name)."""

    kind: str
    values: Sequence[str]


@dataclass(frozen=True)
class Both:
    """All of its parts."""

    parts: Sequence[Match | Both | Either | Not]


@dataclass(frozen=True)
class Either:
    """Any of its parts."""

    parts: Sequence[Match | Both | Either | Not]


@dataclass(frozen=True)
class Not:
    """The contrary of its part; what can't be judged counts as no match, so its contrary holds."""

    part: Match | Both | Either | Not


Predicate = Match | Both | Either | Not


@dataclass(frozen=True)
class Rule:
    """A rule fires if any of its matchers does (whole folder names, path fragments, extensions, a name pattern, terms,
    or the predicate ``when``), unless the path holds a fragment of ``unless``, and where it has a ``gate``, if that holds too."""

    name: str
    outcome: str
    folders: Sequence[str] = ()
    fragments: Sequence[str] = ()
    extensions: Sequence[str] = ()
    pattern: str | None = None
    terms: Sequence[str] = ()
    unless: Sequence[str] = ()
    note: str = ""
    when: Predicate | None = None
    gate: Predicate | None = None


@dataclass(frozen=True)
class Ruleset:
    """Rules of the first group come before the second's, and so on; the first that fires decides."""

    name: str
    version: str
    groups: Sequence[tuple[str, Sequence[Rule]]] = field(default_factory=tuple)
    default: str = "unmatched"


def mentions(text: Column, terms: Sequence[str]) -> Column:
    """Any of the terms as whole words, whatever their case: a cheap look for the substring comes before the pattern."""
    low = F.lower(text)
    whole = "|".join(re.escape(t.lower()) for t in terms)
    near = reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in terms])
    return near & low.rlike(rf"(^|[^\p{{L}}\p{{N}}_])({whole})($|[^\p{{L}}\p{{N}}_])")


@dataclass(frozen=True)
class Row:
    """The columns that predicates look at."""

    path: Column
    name: Column
    extension: Column
    texts: Sequence[Column] = ()
    keywords: Column | None = None
    fields: Mapping[str, Column] = field(default_factory=dict)


def matches(p: Predicate, row: Row) -> Column:
    """A predicate as a boolean column that is never null."""
    if isinstance(p, Both | Either):
        parts = [matches(x, row) for x in p.parts]
        if not parts:
            return F.lit(isinstance(p, Both))
        return reduce((lambda a, b: a & b) if isinstance(p, Both) else (lambda a, b: a | b), parts)
    if isinstance(p, Not):
        return ~matches(p.part, row)
    values = [v.lower() for v in p.values]
    low = F.lower(F.coalesce(row.path, F.lit("")))
    if not values:
        return F.lit(False)
    if p.kind == "folders":
        return F.arrays_overlap(F.split(low, "/"), F.array(*map(F.lit, values)))
    if p.kind == "fragments":
        return reduce(lambda a, b: a | b, [low.contains(v) for v in values])
    if p.kind == "extensions":
        return F.ltrim(F.lower(F.coalesce(row.extension, F.lit(""))), F.lit(".")).isin([v.lstrip(".") for v in values])
    if p.kind == "pattern":
        return reduce(lambda a, b: a | b, [F.coalesce(row.name, F.lit("")).rlike(f"(?i){v}") for v in p.values])
    if p.kind == "terms":
        return reduce(lambda a, b: a | b, [mentions(F.coalesce(t, F.lit("")), p.values) for t in row.texts], F.lit(False))
    if p.kind == "keywords":
        held = F.coalesce(row.keywords, F.array().cast("array<string>")) if row.keywords is not None else F.array().cast("array<string>")
        return F.coalesce(F.arrays_overlap(F.transform(held, F.lower), F.array(*map(F.lit, values))), F.lit(False))
    if p.kind.startswith("field:"):
        column = row.fields.get(p.kind[6:])
        return F.lit(False) if column is None else F.coalesce(F.lower(column).isin(values), F.lit(False))
    raise ValueError(p.kind)


def predicate(rule: Rule) -> Predicate:
    """The whole rule as one predicate."""
    parts: list[Predicate] = [Match(kind, values) for kind, values in (("folders", rule.folders), ("fragments", rule.fragments), ("extensions", rule.extensions), ("terms", rule.terms)) if values]
    parts += [Match("pattern", [rule.pattern])] if rule.pattern else []
    parts += [rule.when] if rule.when else []
    every: list[Predicate] = [Either(parts)]
    every += [Not(Match("fragments", rule.unless))] if rule.unless else []
    every += [rule.gate] if rule.gate else []
    return Both(every)


def condition(rule: Rule, path: Column, name: Column, extension: Column, texts: Sequence[Column] = (), keywords: Column | None = None, fields: Mapping[str, Column] | None = None) -> Column:
    """The rule as a boolean column that is never null."""
    return matches(predicate(rule), Row(path, name, extension, texts, keywords, fields or {}))


def said(p: Predicate) -> str:
    """A predicate in words."""
    if isinstance(p, Both | Either):
        return "(" + (" and " if isinstance(p, Both) else " or ").join(map(said, p.parts)) + ")"
    return f"not {said(p.part)}" if isinstance(p, Not) else f"{p.kind.removeprefix('field:')} {', '.join(p.values)}"


def decide(rules: Ruleset, path: Column, name: Column, extension: Column, texts: Sequence[Column] = (), keywords: Column | None = None, fields: Mapping[str, Column] | None = None) -> Column:
    """struct<decision, rule_matched, ruleset, rationale, policy_version> of the first rule that fires."""

    def made(decision: str, rule: str | None, why: str) -> Column:
        return F.struct(F.lit(decision).alias("decision"), F.lit(rule).cast("string").alias("rule_matched"), F.lit(rules.name).alias("ruleset"), F.lit(why).alias("rationale"), F.lit(rules.version).alias("policy_version"))

    out = None
    for _, group in rules.groups:
        for rule in group:
            branch = (condition(rule, path, name, extension, texts, keywords, fields), made(rule.outcome, rule.name, rule.note or rule.name))
            out = F.when(*branch) if out is None else out.when(*branch)
    last = made(rules.default, None, "no rule matched")
    return last if out is None else out.otherwise(last)


def to_markdown(rules: Ruleset) -> str:
    """The rules for people to confirm."""
    lines = [f"# {rules.name} (version {rules.version})"]
    for title, group in rules.groups:
        lines += ["", f"## {title}", ""]
        for rule in group:
            what = [("folders", rule.folders), ("paths with", rule.fragments), ("extensions", rule.extensions), ("names like", [rule.pattern] if rule.pattern else ()), ("texts with", rule.terms), ("unless", rule.unless)]
            parts = [f"{label} {', '.join(values)}" for label, values in what if values] + [f"{label} {said(p)}" for label, p in (("when", rule.when), ("only where", rule.gate)) if p]
            lines.append(f"- **{rule.name}** → {rule.outcome}: " + "; ".join(parts) + (f". {rule.note}" if rule.note else ""))
    return "\n".join(lines) + "\n"
