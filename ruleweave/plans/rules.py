"""Rule model, validation and loading.

A rule is ``id``, ``title``, ``level`` and a ``detection`` block of named selection groups,
a ``condition`` and, for burst rules, a ``timeframe``. Other YAML keys are dropped.
"""

from __future__ import annotations

import json
import os
import re
from dataclasses import dataclass, field
from typing import Any

import yaml

from ruleweave.errors import RuleError
from ruleweave.functions.timeutil import parse_timeframe

REQUIRED = ("id", "title", "level", "detection")

# Fixed value: burst condition syntax, "<group> | count() by <field> > <N>".
BURST_CONDITION = re.compile(r"^(\w+)\s*\|\s*count\(\)\s*by\s*(\w+)\s*>\s*(\d+)$")


@dataclass(frozen=True)
class Rule:
    id: str
    title: str
    level: str
    detection: dict = field(hash=False, compare=False)
    source: str = field(default="", compare=False)

    @property
    def is_burst(self) -> bool:
        """A ``timeframe`` key in the detection block makes a burst rule."""
        return isinstance(self.detection, dict) and "timeframe" in self.detection

    @property
    def groups(self) -> dict[str, Any]:
        return {k: v for k, v in self.detection.items() if k not in ("condition", "timeframe")}

    @property
    def condition(self) -> str:
        return str(self.detection.get("condition", ""))

    def to_json(self) -> str:
        return json.dumps({"id": self.id, "title": self.title, "level": self.level,
                           "detection": self.detection}, sort_keys=True, default=str)


@dataclass(frozen=True)
class BurstSpec:
    """The parsed parts of a burst rule."""
    selection: str
    by_field: str
    threshold: int
    window_seconds: int


def build_rule(payload: Any, source: str = "rule payload") -> Rule:
    """A rule from a decoded object; not an object or a missing key is a RuleError."""
    if not isinstance(payload, dict):
        raise RuleError(f"{source} must be an object, got {type(payload).__name__}")
    missing = [k for k in REQUIRED if k not in payload]
    if missing:
        raise RuleError(f"missing required field {missing[0]!r} in {source}")
    detection = payload["detection"]
    if not isinstance(detection, dict):
        raise RuleError(f"'detection' must be an object in {source}")
    return Rule(id=str(payload["id"]), title=str(payload["title"]), level=str(payload["level"]),
                detection=detection, source=source)


def parse_rule_text(text: str, source: str) -> Rule:
    try:
        payload = yaml.safe_load(text)
    except yaml.YAMLError as exc:
        raise RuleError(f"{source}: not valid YAML ({exc})") from exc
    return build_rule(payload, source=source)


def load_rules(rules_dir: str) -> list[Rule]:
    """S3: every ``*.yml`` file of a folder (not recursive), in file-name order."""
    names = sorted(n for n in os.listdir(rules_dir) if n.endswith(".yml")
                   and os.path.isfile(os.path.join(rules_dir, n)))
    rules = []
    for n in names:
        with open(os.path.join(rules_dir, n), encoding="utf-8") as fh:
            rules.append(parse_rule_text(fh.read(), source=f"rule file '{n}'"))
    return rules


def burst_spec(rule: Rule) -> BurstSpec:
    """J7 + J8: parse ``<group> | count() by <field> > <N>`` and the timeframe."""
    m = BURST_CONDITION.match(rule.condition.strip())
    if not m:
        raise RuleError(f"rule {rule.id!r}: unsupported burst condition {rule.condition!r}; "
                        "expected '<group> | count() by <field> > <N>'")
    seconds = parse_timeframe(rule.detection.get("timeframe", ""))
    if seconds <= 0:
        raise RuleError(f"rule {rule.id!r}: timeframe must be positive")
    if m.group(1) not in rule.groups:
        raise RuleError(f"rule {rule.id!r}: unknown selection group {m.group(1)!r}")
    return BurstSpec(selection=m.group(1), by_field=m.group(2), threshold=int(m.group(3)),
                     window_seconds=seconds)


def split_rules(rules: list[Rule]) -> tuple[list[Rule], list[Rule]]:
    """(plain rules, burst rules), each in list order."""
    return [r for r in rules if not r.is_burst], [r for r in rules if r.is_burst]
