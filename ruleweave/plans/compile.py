"""Compile selection groups and conditions to Catalyst expressions.

The condition grammar (``and`` below ``not``, ``or`` lowest, parentheses as separate
tokens) is a subset of Spark SQL boolean expressions with the same precedence. The token
list is checked here, every group name is replaced by its predicate in parentheses and the
result is handed to ``F.expr``: Catalyst does the parsing, one expression per rule.
"""

from __future__ import annotations

import ast
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ruleweave.errors import RuleError
from ruleweave.functions.fields import Fields, rule_text, sql_text
from ruleweave.plans.rules import Rule

log = logging.getLogger(__name__)

# The supported field modifiers and the condition keywords.
MODIFIERS = ("contains", "startswith", "endswith")
KEYWORDS = ("and", "or", "not", "(", ")")


def _flatten(values) -> list:
    out = []
    for v in values:
        if isinstance(v, list):
            out.extend(_flatten(v))
        else:
            out.append(v)
    return out


def split_key(key: str) -> tuple[str, str | None]:
    """``field|modifier`` at the first pipe (``a|contains|all`` has modifier ``contains|all``)."""
    if "|" in key:
        name, mod = key.split("|", 1)
        return name, mod
    return key, None


def term_sql(fields: Fields, key: str, expected) -> str:
    """One ``field[|modifier]: value-or-list`` entry of a selection group.

    P1-P7, P14: absent field is false; a list is OR over its items (empty list is false);
    an unknown modifier is false.
    """
    name, modifier = split_key(key)
    if modifier is not None and modifier not in MODIFIERS:
        log.warning("unknown modifier %r in %r: the term never matches", modifier, key)
        return "false"
    values = [rule_text(v) for v in (_flatten(expected) if isinstance(expected, list) else [expected])]
    if not values or not fields.has(name):
        return "false"
    if modifier is None:
        match = fields.equals_any_sql(name, values)
    else:
        txt = fields.text_sql(name)
        match = " OR ".join(f"{modifier}({txt}, {sql_text(v)})" for v in dict.fromkeys(values))
    return f"({fields.present_sql(name)} AND ({match}))"


def group_sql(fields: Fields, group, rule_id: str = "", group_name: str = "") -> str:
    """AND over the entries of a selection group; an empty group is true.

    Never NULL: presence gates every comparison, so ``not`` stays two-valued (T4) and no
    ``coalesce`` is needed (it would block filter pushdown).
    """
    if not isinstance(group, dict):
        raise RuleError(f"rule {rule_id!r}: selection group {group_name!r} must be a mapping")
    terms = [term_sql(fields, str(k), v) for k, v in group.items()]
    return "(" + " AND ".join(terms) + ")" if terms else "true"


def group_predicate(fields: Fields, group, rule_id: str = "", group_name: str = "") -> Column:
    return F.expr(group_sql(fields, group, rule_id, group_name))


def check_condition(tokens: list[str], groups: dict) -> None:
    """The token list must be a complete boolean expression over known groups."""
    if not tokens:
        raise RuleError("empty condition")
    depth = 0
    want_operand = True
    for tok in tokens:
        if want_operand:
            if tok == "(":
                depth += 1
            elif tok == "not":
                pass
            elif tok in KEYWORDS:
                raise RuleError(f"unexpected {tok!r} in condition")
            elif tok not in groups:
                raise RuleError(f"unknown selection group in condition: {tok!r}")
            else:
                want_operand = False
        else:
            if tok in ("and", "or"):
                want_operand = True
            elif tok == ")":
                depth -= 1
                if depth < 0:
                    raise RuleError("unbalanced ')' in condition")
            else:
                raise RuleError(f"unexpected {tok!r} after a complete expression in condition")
    if want_operand or depth != 0:
        raise RuleError("incomplete condition")


def rule_sql(rule: Rule, fields: Fields, condition: str | None = None) -> str:
    """The whole rule (or ``condition`` over its groups) as one SQL boolean expression."""
    groups = rule.groups
    tokens = (rule.condition if condition is None else condition).split()
    try:
        check_condition(tokens, groups)
    except RuleError as exc:
        raise RuleError(f"rule {rule.id!r}: {exc}") from None
    cache: dict[str, str] = {}
    out = []
    for tok in tokens:
        if tok in KEYWORDS:
            out.append(tok.upper() if tok.isalpha() else tok)
        else:
            if tok not in cache:
                cache[tok] = group_sql(fields, groups[tok], rule.id, tok)
            out.append(cache[tok])
    return " ".join(out)


def compile_rule(rule: Rule, fields: Fields, condition: str | None = None) -> Column:
    """A rule as one boolean Column."""
    return F.expr(rule_sql(rule, fields, condition))


def with_rule_flags(df: DataFrame, rules: list[Rule], fields: Fields, prefix: str = "__r",
                    conditions: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Add one boolean column per rule; returns the frame and the flag column names."""
    names = [f"{prefix}{i}" for i in range(len(rules))]
    flags = [compile_rule(r, fields, None if conditions is None else conditions[i]).alias(n)
             for i, (r, n) in enumerate(zip(rules, names))]
    return df.select("*", *flags), names


def usable_rules(rules: list[Rule], fields: Fields) -> tuple[list[Rule], list[tuple[Rule, str]]]:
    """Split rules into (compilable, [(rule, reason)]) for rule sets fed at run time.

    A changelog may carry a rule whose condition or timeframe cannot work; it is reported
    and left out instead of stopping evaluation of every other rule (T15).
    """
    from ruleweave.plans.rules import burst_spec

    good, bad = [], []
    for r in rules:
        try:
            if r.is_burst:
                spec = burst_spec(r)
                group_sql(fields, r.groups[spec.selection], r.id, spec.selection)
            else:
                rule_sql(r, fields)
            good.append(r)
        except RuleError as exc:
            log.warning("rule %r left out: %s", r.id, exc)
            bad.append((r, str(exc)))
    return good, bad


def condition_tree(rule: Rule):
    """The checked condition as a boolean tree, and the groups that its names stand for.

    Python's ``ast`` has the same precedence: ``not`` > ``and`` > ``or``.
    """
    tokens = rule.condition.split()
    check_condition(tokens, rule.groups)
    names: dict[str, str] = {}
    text = " ".join(t if t in KEYWORDS else names.setdefault(t, f"g{len(names)}") for t in tokens)
    return ast.parse(text, mode="eval").body, {v: k for k, v in names.items()}


def normal_form(rule: Rule, constants: dict[str, bool], most: int) -> list[tuple[frozenset, frozenset]] | None:
    """The condition as OR of clauses ``(groups that hold, groups that do not)``.

    ``constants`` are groups with a known truth; contradictions and clauses that a shorter one
    implies are left out. An always-true condition is one empty clause, an always-false one has no
    clause. None if there would be more than ``most`` clauses on the way.
    """
    tree, names = condition_tree(rule)

    def tidy(found):
        found = sorted({c for c in found if not c[0] & c[1]}, 
                       key=lambda c: (len(c[0]) + len(c[1]), sorted(c[0]), sorted(c[1])))
        kept: list = []
        for c in found:
            if not any(k[0] <= c[0] and k[1] <= c[1] for k in kept):
                kept.append(c)
        return kept

    def walk(node, positive: bool):
        if isinstance(node, ast.Name):
            group = names[node.id]
            if group in constants:
                return [(frozenset(), frozenset())] if constants[group] == positive else []
            own, none = frozenset([group]), frozenset()
            return [(own, none) if positive else (none, own)]
        if isinstance(node, ast.UnaryOp):
            return walk(node.operand, not positive)
        out = None
        for part in (walk(v, positive) for v in node.values):
            if part is None:
                return None
            if out is None:
                out = part
            elif isinstance(node.op, ast.And) == positive:
                if len(out) * len(part) > most * most:
                    return None
                out = tidy((x[0] | y[0], x[1] | y[1]) for x in out for y in part)
            else:
                out = tidy([*out, *part])
            if len(out) > most:
                return None
        return out

    return walk(tree, True)


def _pushable_term_sql(fields: Fields, key: str, expected) -> str | None:
    """A term a Parquet scan can evaluate itself, or None (no restriction)."""
    from pyspark.sql import types as T

    types = getattr(fields, "_types", None)
    if types is None:
        return None
    name, modifier = split_key(key)
    values = [rule_text(v) for v in (_flatten(expected) if isinstance(expected, list) else [expected])]
    if name not in types or (modifier is not None and modifier not in MODIFIERS) or not values:
        return "false"          # the term can never hold (absent field, unknown modifier, empty list)
    dtype = types[name]
    if isinstance(dtype, T.StringType):
        return term_sql(fields, key, expected)
    if modifier is None and isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return term_sql(fields, key, expected)
    return None


def necessary_sql(rule: Rule, fields: Fields) -> str | None:
    """A predicate every log matching ``rule`` satisfies, made only of pushable terms.

    A group gives the AND of its pushable terms, AND keeps what its parts give, OR needs every
    branch to give something, and ``not`` gives no restriction. None means nothing can be
    skipped for this rule.
    """
    try:
        tree, groups = condition_tree(rule)
    except RuleError:
        return None

    def walk(node) -> str | None:
        if isinstance(node, ast.Name):
            group = rule.groups[groups[node.id]]
            if not isinstance(group, dict):
                return None
            terms = [t for t in (_pushable_term_sql(fields, str(k), v) for k, v in group.items()) if t]
            return "(" + " AND ".join(terms) + ")" if terms else None
        if isinstance(node, ast.BoolOp):
            parts = [walk(v) for v in node.values]
            if isinstance(node.op, ast.And):
                kept = [p for p in parts if p]
                return "(" + " AND ".join(kept) + ")" if kept else None
            return "(" + " OR ".join(parts) + ")" if all(parts) else None
        return None   # not, or anything else: no restriction

    return walk(tree)


def scan_prefilter(rules: list[Rule], fields: Fields) -> Column | None:
    """OR of the rules' necessary predicates, for the scan to skip data; None if any rule
    has none. Always a superset of the matches: the exact rule check still runs after it."""
    parts = []
    for r in rules:
        n = necessary_sql(r, fields)
        if n is None:
            return None
        parts.append(n)
    if not parts:
        return None
    return F.expr(" OR ".join(f"({p})" for p in parts))
