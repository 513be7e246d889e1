"""Rules as data, for large or often-changing rule sets.

Rules become two tables. The *conditions* have one row per (rule, group, term, value). The
*rule list* has one row per rule with its condition in normal form: clauses of groups that
must hold and groups that must not, so ``not``, parentheses and empty groups are data too.
Logs are offered under the keys that a condition can be found by, and meet them in one
equi-join, after which the term itself is checked:

* equality terms by (field, value);
* ``startswith`` / ``endswith`` by the first or last characters, as many as the largest power
  of two within the pattern: a value is offered once per power in use, whatever the patterns;
* ``contains`` by the pattern's rarest run of three characters among the patterns of the
  field (shorter patterns by themselves); a value is offered once per distinct run;
* empty patterns by the field alone, and rules that hold for a log which meets no group by
  nothing at all: these keys are shared by all logs and are salted.

A group needs all its terms, so only one of them, the one whose keys the fewest conditions share, is
searched for (see ``anchored``); the group's other terms are checked where it is met. So a term that all
rules share does not bring every log together with every rule.

One aggregate per (log, rule) then gathers the groups met and decides the clauses. Whether the
conditions are broadcast is left to the optimizer, which knows their bytes; where they are, a
value is not copied for its offers, as exploding, probing and checking are one generated loop.
Beyond, it travels with each of them and AQE splits skewed (field, value) keys. A condition of
more than ``MAX_CLAUSES`` clauses goes through the compiled path (E1) instead.
"""

from __future__ import annotations

import json
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ruleweave.errors import RuleError
from ruleweave.functions.fields import quote, rule_text
from ruleweave.operators.evaluate import alert_projection, match_rules
from ruleweave.plans.compile import KEYWORDS, MODIFIERS, _flatten, normal_form, split_key
from ruleweave.plans.rules import Rule, build_rule
from ruleweave.session import scratch_path
from ruleweave.sources.logs import LogView

CONDITIONS_SCHEMA = T.StructType([
    T.StructField("rule_ord", T.LongType()), T.StructField("rule_id", T.StringType()),
    T.StructField("group", T.IntegerType()), T.StructField("term", T.IntegerType()),
    T.StructField("field", T.StringType()), T.StructField("modifier", T.StringType()),
    T.StructField("value", T.StringType()),
])
_LITERALS = T.ArrayType(T.StructType([T.StructField("group", T.IntegerType()), T.StructField("terms", T.IntegerType())]))
RULE_LIST_SCHEMA = T.StructType([
    T.StructField("rule_ord", T.LongType()), T.StructField("rule_id", T.StringType()),
    T.StructField("rule_title", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("clauses", T.ArrayType(T.StructType([
        T.StructField("holds", _LITERALS), T.StructField("fails", _LITERALS)]))),
])
#: Clauses of one condition in normal form, above which a rule is compiled instead.
MAX_CLAUSES = 256
#: Characters of the runs that ``contains`` patterns are found by.
RUN = 3
ALWAYS = "always"       # modifier of the one row of a rule that holds where no group does


def condition_rows(ordinal: int, rule: Rule) -> tuple[list[tuple], list[dict]] | None:
    """One rule as (conditions, clauses); None when it needs the compiled path."""
    used = list(dict.fromkeys(t for t in rule.condition.split() if t not in KEYWORDS))
    constants, terms = {}, {}
    for g in used:
        group = rule.groups.get(g, {})
        if not isinstance(group, dict):
            raise RuleError(f"rule {rule.id!r}: selection group {g!r} must be a mapping")
        terms[g] = []
        for key, expected in group.items():
            name, mod = split_key(str(key))
            values = [rule_text(v) for v in (_flatten(expected) if isinstance(expected, list) else [expected])]
            if not values or (mod is not None and mod not in MODIFIERS):
                constants[g] = False         # a term that no value meets
            terms[g].append((name, mod, list(dict.fromkeys(values))))
        if not group:
            constants[g] = True
    form = normal_form(rule, constants, MAX_CLAUSES)
    if form is None:
        return None
    number = {g: i for i, g in enumerate(used)}
    needed = sorted({number[g] for holds, fails in form for g in holds | fails})
    rows = [(ordinal, rule.id, i, ti, name, mod, v)
            for i in needed for ti, (name, mod, values) in enumerate(terms[used[i]]) for v in values]
    if any(not holds for holds, _ in form):
        rows.append((ordinal, rule.id, -1, 0, "", ALWAYS, ""))

    def literals(groups):
        return [{"group": number[g], "terms": len(terms[g])} for g in sorted(groups)]

    return rows, [{"holds": literals(holds), "fails": literals(fails)} for holds, fails in form]


def split_for_table(rules: list[Rule]) -> tuple[list[tuple], list[tuple], list[int]]:
    """(conditions, rule list, ordinals of rules that need the compiled path)."""
    rows, listed, rest = [], [], []
    for i, r in enumerate(rules):
        got = condition_rows(i, r)
        if got is None:
            rest.append(i)
        else:
            rows.extend(got[0])
            listed.append((i, r.id, r.title, r.level, got[1]))
    return rows, listed, rest


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Driver rows as a local relation (by way of Arrow), whose size the optimizer knows."""
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(arrow.names, r)) for r in rows], arrow), schema)


def _runs(text: Column, n: int) -> Column:
    """The distinct runs of ``n`` characters of a text (none if it is shorter)."""
    def cut(chars):
        at = F.sequence(F.lit(1), F.size(chars) - F.lit(n - 1))
        return F.transform(at, lambda i: F.concat(*[F.element_at(chars, i + F.lit(k)) for k in range(n)]))

    # the characters are bound once, as a one-entry array, or each run would split the text anew
    once = F.transform(F.array(F.split(text, "")), cut)
    return F.when(F.length(text) >= n, F.array_distinct(F.element_at(once, 1)))


def _offer(field: str, path: str, jv: Column, text: Column) -> Column:
    """A value under one join value."""
    return F.struct(F.lit(field).alias("field"), F.lit(path).alias("path"), jv.alias("jv"), text.alias("log_value"))


def offers_of(fields, paths: dict[str, set[tuple[str, int]]]) -> Column | None:
    """A log's values under every key that a condition can be found by, as one array; None for no path.

    Absent fields and values too short for a key give no entry, or one whose ``jv`` is NULL.
    """
    single, many = [], []
    for f, kinds in sorted(paths.items()):
        for kind, n in sorted(kinds):
            if kind == "all":
                single.append(_offer(f, "all0", F.lit(""), F.lit("")))
            elif fields.has(f):
                text, path = fields.text(f), f"{kind}{n}"
                if kind == "run":
                    runs = F.when(fields.present(f), _runs(text, n))
                    many.append(F.coalesce(F.transform(runs, lambda jv: _offer(f, path, jv, text)),
                                           F.array().cast("array<struct<field:string,path:string,jv:string,"
                                                          "log_value:string>>")))
                else:
                    jv = {"eq": text, "any": F.lit(""), "head": F.substring(text, 1, n),
                          "tail": F.substring(text, -n, n)}[kind]
                    single.append(_offer(f, path, F.when(fields.present(f) & (F.length(text) >= n), jv), text))
    parts = ([F.array(*single)] if single else []) + many
    return F.concat(*parts) if parts else None


def found_by(conditions: DataFrame) -> DataFrame:
    """The conditions with the ``path`` and ``jv`` (join value) that they are found by."""
    v, m, n = F.col("value"), F.col("modifier"), F.length("value")
    power = F.expr("shiftleft(1, length(bin(length(value))) - 1)")
    size = F.when(m == "contains", F.least(n, F.lit(RUN))).otherwise(power)
    name = F.when(m == "contains", "run").when(m == "startswith", "head").otherwise("tail")
    plain = conditions.where(~F.coalesce((m == "contains") & (n > RUN), F.lit(False))).select(
        "*", F.when(m.isNull(), "eq0").when(m == ALWAYS, "all0").when(n == 0, "any0")
        .otherwise(F.concat(name, size.cast("string"))).alias("path"),
        F.when(m.isNull(), v).when((m == ALWAYS) | (n == 0), F.lit("")).when(m == "contains", v)
        .when(m == "startswith", F.substring(v, F.lit(1), power))
        .otherwise(F.substring(v, -power, power)).alias("jv"))
    runs = (conditions.where((m == "contains") & (n > RUN)).select("*", F.explode(_runs(v, RUN)).alias("jv"))
            .withColumn("_rw_n", F.count(F.lit(1)).over(Window.partitionBy("field", "jv"))))
    rarest = runs.groupBy(*conditions.columns).agg(F.min(F.struct("_rw_n", "jv")).alias("_rw_best")).select(
        *conditions.columns, F.lit(f"run{RUN}").alias("path"), F.col("_rw_best.jv").alias("jv"))
    return plain.unionByName(rarest)


_ANCHOR_COLUMNS = ["rule_ord", "group", "field", "modifier", "value", "path", "jv", "rest"]


def anchored(conditions: DataFrame) -> DataFrame:
    """The conditions that groups are searched by (columns ``_ANCHOR_COLUMNS``, then those besides a condition's own):
    of each group, those of the term whose keys the fewest conditions share, with the others as ``rest``, an array of
    terms, each an array of the alternatives ``(field, modifier, value)``.

    The conditions of a rule must agree in the further columns.
    """
    more = [c for c in conditions.columns if c not in CONDITIONS_SCHEMA.fieldNames()]
    found, key = found_by(conditions), ["field", "path", "jv"]
    found = found.join(found.groupBy(*key).agg(F.count(F.lit(1)).alias("_rw_n")), key)
    whole = F.when(F.col("path") == "eq0", 0).when(F.col("path").isin("any0", "all0"), 2).otherwise(1)
    terms = found.groupBy("rule_ord", "group", "term", *more).agg(
        F.sum("_rw_n").alias("_rw_n"), F.max(whole).alias("_rw_kind"),
        F.collect_set(F.struct("field", F.coalesce("modifier", F.lit("")).alias("modifier"), "value", "path", "jv")).alias("_rw_keys"))
    groups = terms.groupBy("rule_ord", "group", *more).agg(F.collect_list(
        F.struct("_rw_n", "_rw_kind", "term", "_rw_keys")).alias("_rw_terms")).withColumn("_rw_best", F.array_min("_rw_terms"))
    others = F.filter("_rw_terms", lambda x: x["term"] != F.col("_rw_best.term"))
    rest = F.transform(others, lambda x: F.transform(x["_rw_keys"], lambda k: F.struct(
        k["field"].alias("field"), k["modifier"].alias("modifier"), k["value"].alias("value"))))
    return groups.select("rule_ord", "group", rest.alias("rest"), F.inline("_rw_best._rw_keys"), *more).select(*_ANCHOR_COLUMNS, *more)


def staged_anchors(conditions: DataFrame) -> DataFrame:
    """``anchored``, written below the checkpoint folder and read back: made once, of a size that the optimizer knows."""
    anchors = anchored(conditions)
    spark = conditions.sparkSession
    path = scratch_path(spark, f"ruleweave-anchors-{uuid.uuid4().hex}")
    anchors.write.parquet(path)
    return spark.read.schema(anchors.schema).parquet(path)


def _holds(text: Column, modifier: Column, value: Column) -> Column:
    """Whether a field's text meets a condition (its modifier "" for equality)."""
    return (((modifier == "") & (text == value)) | (modifier == ALWAYS) | ((modifier == "contains") & text.contains(value))
            | ((modifier == "startswith") & text.startswith(value)) | ((modifier == "endswith") & text.endswith(value)))


def table_matches(view: LogView, anchors: DataFrame, rule_list: DataFrame, key_cols: list[str],
                  live: tuple[Column, Column] | None = None) -> DataFrame:
    """``(key..., rule_ord, rule_id, rule_title, severity)`` for every log and table rule that matches.

    One scan of the logs, one join with the ``anchored`` conditions, one shuffle by log and rule.

    ``live`` (a log's time and the slot of time it lies in) is for conditions that hold for an interval:
    they have ``from_us`` and ``to_us`` (NULL: open) and the slots ``first_slot`` to ``last_slot`` that it touches.
    Further columns of the rule list come along.
    """
    keys = [F.col(quote(k)) for k in key_cols]
    paths, others = paths_in(anchors)
    found = offers_of(view.fields, paths)
    if found is None:
        return view.df.where(F.lit(False)).select(*keys).join(rule_list.drop("clauses"), F.lit(False))
    when = [] if live is None else [live[0].alias("_rw_t"), live[1].alias("_rw_slot")]
    texts = [F.create_map(*[x for f in others for x in (F.lit(f), F.when(view.fields.present(f), view.fields.text(f)))]).alias(
        "_rw_texts")] if others else []
    offers = view.df.select(*keys, *when, *texts, F.inline(found)).where(F.col("jv").isNotNull())
    # The keys that all logs share are salted over the session's partitions: offers hashed by log
    # key, conditions copied per salt.
    salts = int(view.df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shared = F.col("path").isin("any0", "all0")
    offers = offers.withColumn("_rw_salt", F.when(shared, F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int"))
                               .otherwise(F.lit(0)))
    cond = anchors.withColumn("_rw_salt", F.explode(
        F.when(shared, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    on = ["field", "path", "jv", "_rw_salt"]
    if live is not None:
        cond = cond.withColumn("_rw_slot", F.explode(F.sequence("first_slot", "last_slot"))).drop("first_slot", "last_slot")
        on.append("_rw_slot")
    holds = _holds(F.col("log_value"), F.col("modifier"), F.col("value"))
    if others:
        text = F.col("_rw_texts")
        holds = holds & F.forall("rest", lambda term: F.exists(term, lambda c: F.coalesce(
            _holds(text[c["field"]], c["modifier"], c["value"]), F.lit(False))))
    else:       # of the groups' other terms, none is of a field that these logs have
        holds = holds & (F.size("rest") == 0)
    if live is not None:
        t = F.col("_rw_t")
        holds = holds & F.coalesce(F.col("from_us") <= t, F.lit(True)) & F.coalesce(t < F.col("to_us"), F.lit(True))
    met = offers.join(cond, on=on, how="inner").where(holds)
    per_rule = met.groupBy(*keys, "rule_ord").agg(F.collect_set("group").alias("_rw_met"))

    def group_holds(literal):
        return F.array_contains("_rw_met", literal["group"])

    clause = F.exists("clauses", lambda c: F.forall(c["holds"], group_holds)
                      & ~F.exists(c["fails"], group_holds))
    return per_rule.join(rule_list, "rule_ord").where(clause).drop("_rw_met", "clauses")


def table_alerts(spark: SparkSession, view: LogView, rules: list[Rule], key_cols: list[str]) -> DataFrame:
    """Alerts of plain rules, joined as data; conditions of very many clauses are compiled.

    ``key_cols`` must identify a log (e.g. the offset); matches are joined back on them.
    """
    rows, listed, rest = split_for_table(rules)
    parts = []
    if rest:
        parts.append(alert_projection(view, match_rules(view, [rules[i] for i in rest])))
    if rows:
        anchors, rule_list = anchored(local_table(spark, rows, CONDITIONS_SCHEMA)), local_table(spark, listed, RULE_LIST_SCHEMA)
        anchors = local_table(spark, [tuple(r.asDict(True).values()) for r in anchors.collect()], anchors.schema)
        matches = table_matches(view, anchors, rule_list, key_cols)
        tagged = matches.select(*key_cols, F.struct("rule_ord", "rule_id", "rule_title", "severity").alias("_rw_rule"))
        joined = view.df.join(tagged, on=key_cols, how="inner")
        parts.append(alert_projection(view, joined))
    if not parts:
        return alert_projection(view, match_rules(view, []))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- S3 on Spark: the rule folder as a table ------------------------------------------------

RULES_FRAME_SCHEMA = "path string, id string, title string, level string, detection string, error string"


def rules_frame(spark: SparkSession, rules_dir: str) -> DataFrame:
    """S3 + S4 on Spark: every ``*.yml`` file as one row; invalid files carry an ``error``."""
    texts = (spark.read.text(rules_dir, wholetext=True, pathGlobFilter="*.yml", recursiveFileLookup=False)
             .select(F.input_file_name().alias("path"), F.col("value").alias("text")))

    def parse(batches):
        import yaml
        for pdf in batches:
            out = []
            for path, text in zip(pdf["path"], pdf["text"]):
                name = path.rsplit("/", 1)[-1]
                try:
                    r = build_rule(yaml.safe_load(text), source=f"rule file '{name}'")
                    out.append((path, r.id, r.title, r.level, json.dumps(r.detection, default=str), None))
                except (RuleError, yaml.YAMLError) as exc:
                    out.append((path, None, None, None, None, str(exc)))
            yield pd.DataFrame(out, columns=["path", "id", "title", "level", "detection", "error"])

    return texts.mapInPandas(parse, RULES_FRAME_SCHEMA)


def _flattened(rules: DataFrame) -> DataFrame:
    """One row per rule of a rules table: its conditions and clauses, or why it has none."""
    def flatten(batches):
        for pdf in batches:
            out = []
            for at, rid, title, level, det in zip(pdf["rule_ord"], pdf["id"], pdf["title"], pdf["level"],
                                                  pdf["detection"]):
                rows, listed, error = None, None, None
                try:
                    rule = Rule(id=rid, title=title, level=level, detection=json.loads(det))
                    got = condition_rows(int(at), rule)
                    if got is None:
                        error = f"more than {MAX_CLAUSES} clauses: compile it"
                    else:
                        rows, listed = got
                        rows = [dict(zip(CONDITIONS_SCHEMA.fieldNames(), r)) for r in rows]
                except (RuleError, ValueError, TypeError, AttributeError) as exc:
                    error = str(exc)
                out.append((at, rid, title, level, rows, listed, error))
            yield pd.DataFrame(out, columns=["rule_ord", "rule_id", "rule_title", "severity", "conditions", "clauses",
                                             "error"])

    schema = T.StructType([*RULE_LIST_SCHEMA.fields[:-1], T.StructField("conditions", T.ArrayType(CONDITIONS_SCHEMA)),
                           RULE_LIST_SCHEMA["clauses"], T.StructField("error", T.StringType())])
    return rules.mapInPandas(flatten, schema)


def conditions_frame(rules: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """E2 tables from a rules table, one rule per row, flattened where the rows are: the conditions,
    the rule list, and the rules left out as ``(rule_ord, rule_id, error)``.

    A rule without a usable condition, or with a null or broken ``detection``, is left out with its
    reason; a rule that can never match is listed without clauses.
    """
    flat = _flattened(rules)
    usable = flat.where(F.col("error").isNull())
    return (usable.select(F.inline("conditions")), usable.drop("conditions", "error"),
            flat.where(F.col("error").isNotNull()).select("rule_ord", "rule_id", "error"))


def paths_in(anchors: DataFrame) -> tuple[dict[str, set[tuple[str, int]]], list[str]]:
    """The (kind, characters) under which each field's values must be offered, and the fields of the groups' other
    terms: a few rows per field reach the driver, whatever the rules."""
    paths: dict[str, set[tuple[str, int]]] = {}
    others = anchors.select(F.explode(F.flatten("rest")).alias("c")).select("c.field", F.lit(None).cast("string").alias("path"))
    fields = set()
    for field, path in anchors.select("field", "path").distinct().unionByName(others.distinct()).collect():
        if path is None:
            fields.add(field)
        else:
            kind = path.rstrip("0123456789")
            paths.setdefault(field, set()).add((kind, int(path[len(kind):])))
    return paths, sorted(fields)


def rules_as_data(view: LogView, rules: DataFrame, key_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """E2 for rules that are themselves a table (``rule_ord, id, title, level, detection``), never
    at the driver: ``(key..., rule_ord, rule_id, rule_title, severity)`` of the matches, and the rules
    left out with their reason."""
    conditions, rule_list, left_out = conditions_frame(rules)
    return table_matches(view, staged_anchors(conditions), rule_list, key_cols), left_out
