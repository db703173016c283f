"""Typed rules over configuration tables.

A rule speaks about one dotted path. Rules are checked after defaults are filled in; a missing
(null) value breaks only ``required``. Values compare as text for ``fixed`` and ``allowlist``, as
double for ``range`` (inclusive bounds; a value that is no number breaks the rule), and a ``regex``
must match the whole value. Bounds on a rule's length hold for present values as ``length``, and
for needed ones as a part of ``required``. Each check returns one row per violation:
``entity_id, path, rule_type, expected, actual``.

Several rules may speak about one path; the order of rules never matters and rules given twice count
once. Paths may contain ``*``; of the paths that match, the most specific one's rules hold, all of
them. A path is filled with its default, else with the value of its fixed rule; two different ones
are an error.

Two input forms exist. In the wide form every path is a column and the rules are compiled into one
projection: one scan, no shuffle, no join. A path without a column is missing everywhere. In the
long form (``entity_id, path, value``) the rules are a table of any length.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions.columns import moment
from lakewarden.plans.sizing import join_groups, local_table, rows_at_most

RULE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("values", T.ArrayType(T.StringType())),
        T.StructField("pattern", T.StringType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("default_value", T.StringType()),
        T.StructField("is_optional", T.BooleanType()),
        T.StructField("hidden", T.BooleanType()),
        T.StructField("min_length", T.IntegerType()),
        T.StructField("max_length", T.IntegerType()),
    ]
)


@dataclass(frozen=True)
class Rule:
    """One rule; ``type`` is fixed, range, regex, allowlist, forbidden, unlimited or required.

    Bounds on the length go with any type.
    """

    path: str
    type: str
    value: str | None = None
    values: Sequence[str] | None = None
    pattern: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    default_value: str | None = None
    is_optional: bool = True
    hidden: bool = False
    min_length: int | None = None
    max_length: int | None = None

    @property
    def needed(self) -> bool:
        return self.type == "required" or not self.is_optional


TYPES = ("fixed", "range", "regex", "allowlist", "forbidden", "unlimited", "required")


def rules_from_policy(policy: str) -> list[Rule]:
    """Rules of a JSON policy document ``{path: {type, value, values, pattern, …}}``."""

    def text(value):
        if value is None or isinstance(value, str):
            return value
        return json.dumps(value)

    return [
        Rule(
            path=path,
            type=spec["type"],
            value=text(spec.get("value")),
            values=[text(v) for v in spec["values"]] if "values" in spec else None,
            pattern=spec.get("pattern"),
            min_value=spec.get("minValue"),
            max_value=spec.get("maxValue"),
            default_value=text(spec.get("defaultValue")),
            is_optional=spec.get("isOptional", True),
            hidden=spec.get("hidden", False),
            min_length=spec.get("minLength"),
            max_length=spec.get("maxLength"),
        )
        for path, spec in json.loads(policy).items()
    ]


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The rules as a table of ``RULE_SCHEMA``."""

    def number(x):
        return None if x is None else float(x)

    rows = [
        (r.path, r.type, r.value, list(r.values) if r.values is not None else None, r.pattern,
         number(r.min_value), number(r.max_value), r.default_value, r.is_optional, r.hidden,
         r.min_length, r.max_length)
        for r in rules
    ]
    return local_table(spark, rows, RULE_SCHEMA)


def rules_from_frame(rules: DataFrame) -> list[Rule]:
    """The rules of a table of ``RULE_SCHEMA``, for the wide form, whose plan names each of them."""
    return [
        Rule(**{**row.asDict(), "is_optional": row["is_optional"] is not False, "hidden": bool(row["hidden"])})
        for row in rules.select(*RULE_SCHEMA.names).collect()
    ]


# --- single rules over a column -------------------------------------------------------------------


def _report(df: DataFrame, id_col: str, path: str, rule_type: str, expected: str, broken: Column, col: str):
    return df.filter(broken).select(
        F.col(id_col).cast("string").alias("entity_id"),
        F.lit(path).alias("path"),
        F.lit(rule_type).alias("rule_type"),
        F.lit(expected).alias("expected"),
        F.col(col).cast("string").alias("actual"),
    )


def _bounds(low: float | None, high: float | None) -> str:
    def end(x):
        return "" if x is None else f"{x:g}"

    return f"{end(low)}..{end(high)}"


def _outside(value: Column, low: float | None, high: float | None) -> Column:
    number = value.try_cast("double")
    broken = number.isNull()
    if low is not None:
        broken = broken | (number < low)
    if high is not None:
        broken = broken | (number > high)
    return value.isNotNull() & broken


def _whole(pattern: str) -> str:
    return rf"\A(?:{pattern})\z"


def rule_fixed(df: DataFrame, id_col: str, col: str, value: object) -> DataFrame:
    """Violation when the value differs from the fixed one."""
    return _report(df, id_col, col, "fixed", str(value), F.col(col).cast("string") != F.lit(str(value)), col)


def rule_range(
    df: DataFrame, id_col: str, col: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Violation below ``low`` or above ``high``."""
    return _report(df, id_col, col, "range", _bounds(low, high), _outside(F.col(col), low, high), col)


def rule_regex(df: DataFrame, id_col: str, col: str, pattern: str) -> DataFrame:
    """Violation when the pattern does not match the whole value."""
    return _report(df, id_col, col, "regex", pattern, ~F.col(col).cast("string").rlike(_whole(pattern)), col)


def rule_allowlist(df: DataFrame, id_col: str, col: str, values: Sequence[object] | DataFrame) -> DataFrame:
    """Violation when the value is not listed; the list may be a one-column table."""
    if isinstance(values, DataFrame):
        allowed = values.select(F.col(values.columns[0]).cast("string").alias("__allowed")).distinct()
        present = df.filter(F.col(col).isNotNull()).withColumn("__value", F.col(col).cast("string"))
        unlisted = join_groups(present, allowed, [("__value", "__allowed")], "left_anti")
        return _report(unlisted, id_col, col, "allowlist", "listed", F.lit(True), col)
    listed = [str(v) for v in values]
    return _report(df, id_col, col, "allowlist", ",".join(listed), ~F.col(col).cast("string").isin(listed), col)


def rule_forbidden(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """Violation when there is a value."""
    return _report(df, id_col, col, "forbidden", "absent", F.col(col).isNotNull(), col)


def rule_required(df: DataFrame, id_col: str, col: str, min_len: int = 1, max_len: int | None = None) -> DataFrame:
    """Violation when the value is missing or its length is out of bounds."""
    length = F.length(F.col(col).cast("string"))
    broken = length.isNull() | (length < min_len)
    if max_len is not None:
        broken = broken | (length > max_len)
    expected = f"length {_bounds(min_len, max_len)}"
    return _report(df, id_col, col, "required", expected, broken, col)


# --- rule tables ----------------------------------------------------------------------------------


def _masks(pattern: Column) -> Column:
    """Positions of the ``*`` segments of a pattern."""
    segments = F.split(pattern, r"\.")
    positions = F.transform(segments, lambda s, i: F.when(s == "*", i))
    return F.filter(positions, lambda p: p.isNotNull())


# Up to so many rules or patterns become literals of the plan; more are joined, with equal rows.
COMPILED_RULES = 500
COMPILED_MASKS = 64


def _best_rule(paths: DataFrame, rules: DataFrame) -> DataFrame | None:
    """``paths`` with ``rule_path`` by one expression, or None when there are too many rules."""
    rows = rows_at_most(rules.select("path").distinct(), COMPILED_RULES)
    if rows is None:
        return None
    by_mask: dict[tuple, list[str]] = {}
    for row in rows:
        segments = row["path"].split(".")
        wild = tuple(i for i, s in enumerate(segments) if s == "*")
        by_mask.setdefault((len(segments), wild) if wild else (0, ()), []).append(row["path"])
    if len(by_mask) > COMPILED_MASKS:
        return None
    # Columns of their own, so that each is computed once per row.
    parts = paths.withColumn("__parts", F.split("path", r"\."))
    masked, found = {}, {}
    for n, ((length, wild), patterns) in enumerate(sorted(by_mask.items())):
        name = f"__masked_{n}"
        segments = [F.lit("*") if i in wild else F.get("__parts", F.lit(i)) for i in range(length)]
        masked[name] = F.when(F.size("__parts") == length, F.concat_ws(".", *segments)) if wild else F.col("path")
        found.setdefault(len(wild), []).append(F.when(F.col(name).isin(patterns), F.col(name)))
    by_stars = [c[0] if len(c) == 1 else F.greatest(*c) for _, c in sorted(found.items())]
    best = F.coalesce(F.lit(None).cast("string"), *by_stars)
    # Exploding one value keeps later filters on it from repeating the expression.
    return parts.select(*paths.columns, *[c.alias(n) for n, c in masked.items()]).select(
        *paths.columns, F.explode_outer(F.array(best)).alias("rule_path")
    )


def _rule_of_path(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per distinct path that has a rule: ``path`` and ``rule_path``, for any number of rules.

    A path is masked in each way some rule masks paths of its length, and the masked text is looked
    up by equality. So no path meets a rule that does not match it.
    """
    patterns = rules.select(F.col("path").alias("rule_path")).distinct()
    patterns = patterns.withColumn("wild", _masks(F.col("rule_path"))).withColumn(
        "segments", F.size(F.split("rule_path", r"\."))
    )
    masks = patterns.select("segments", "wild").distinct()
    distinct = paths.select("path").distinct().withColumn("parts", F.split("path", r"\."))
    masked = distinct.join(masks, F.size("parts") == F.col("segments")).select(
        "path",
        F.size("wild").alias("stars"),
        F.array_join(
            F.transform("parts", lambda s, i: F.when(F.array_contains("wild", i), F.lit("*")).otherwise(s)), "."
        ).alias("masked"),
    )
    found = masked.join(patterns, masked["masked"] == patterns["rule_path"])
    return found.groupBy("path").agg(F.max_by("rule_path", F.struct(-F.col("stars"), "rule_path")).alias("rule_path"))


def _with_rule_path(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """``paths`` with ``rule_path``, null where no rule speaks about the path.

    A rule document of ordinary size becomes one expression; a longer one is joined.
    """
    best = _best_rule(paths, rules)
    if best is not None:
        return best
    found = _rule_of_path(paths, rules).withColumnRenamed("path", "__path")
    return join_groups(paths, found, [("path", "__path")], "left").select(*paths.columns, "rule_path")


def match_rule_paths(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows of ``paths`` that some rule speaks about, with ``rule_path``, the most specific one.

    ``*`` stands for exactly one dotted segment. Fewest ``*`` wins; between equally many the pattern
    that is last in text order wins, which puts a name before a ``*`` at the first difference.
    """
    return _with_rule_path(paths, rules).filter(F.col("rule_path").isNotNull())


def _fills(rules: Sequence[Rule]) -> dict[str, str]:
    """What each path is filled with: its default, else the value of its fixed rule."""
    given: dict[str, tuple[set, set]] = {}
    for rule in rules:
        if "*" not in rule.path.split("."):
            defaults, fixed = given.setdefault(rule.path, (set(), set()))
            defaults |= {rule.default_value} - {None}
            fixed |= {rule.value} - {None} if rule.type == "fixed" else set()
    fills = {path: defaults or fixed for path, (defaults, fixed) in given.items() if defaults or fixed}
    for path, values in fills.items():
        if len(values) > 1:
            raise ValueError(f"two fills for {path}: {', '.join(sorted(values))}")
    return {path: values.pop() for path, values in fills.items()}


def apply_defaults(entities: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Wide form: fill nulls with the default, or with the value of a fixed rule.

    A path with a fill but without a column becomes one, of text.
    """
    fills = _fills(rules)
    return entities.select(
        *[
            F.coalesce(F.col(f"`{c}`"), F.lit(fills[c]).cast(entities.schema[c].dataType)).alias(c)
            if c in fills
            else F.col(f"`{c}`")
            for c in entities.columns
        ],
        *[F.lit(fill).alias(path) for path, fill in sorted(fills.items()) if path not in entities.columns],
    )


def _expected_paths(rules: DataFrame) -> DataFrame:
    """Paths every entity is to have: ``path`` and ``fill``, null for a needed path without one."""
    fixed = F.when(F.col("type") == "fixed", F.col("value"))
    needed = (F.col("type") == "required") | ~F.coalesce("is_optional", F.lit(True))
    named = rules.filter(~F.array_contains(F.split("path", r"\."), "*"))
    per_path = named.groupBy("path").agg(
        F.min("default_value").alias("default"), F.max("default_value").alias("other_default"),
        F.min(fixed).alias("fixed"), F.max(fixed).alias("other_fixed"), F.bool_or(needed).alias("needed"),
    )
    two = (F.col("default") != F.col("other_default")) | (
        F.col("default").isNull() & (F.col("fixed") != F.col("other_fixed"))
    )
    error = F.raise_error(F.concat(F.lit("two fills for "), "path")).cast("string")
    fill = F.when(F.coalesce(two, F.lit(False)), error).otherwise(F.coalesce("default", "fixed"))
    filled = per_path.select("path", fill.alias("fill"), "needed")
    return filled.filter(F.col("fill").isNotNull() | F.col("needed")).select("path", "fill")


def apply_defaults_long(entities: DataFrame, rules: DataFrame, entity_ids: DataFrame | None = None) -> DataFrame:
    """Long form: like ``apply_defaults``, also adding the rows of paths an entity lacks.

    Needed paths without a fill are added with a null value. Only rules without ``*`` name a path
    that can be added. ``entity_ids`` (``entity_id``) names entities that may have no row at all.
    """
    expected = _expected_paths(rules)
    path = F.col("path")
    has = entities.select("entity_id", "path")
    if entity_ids is not None:
        has = has.unionByName(entity_ids.select("entity_id", F.lit(None).cast("string").alias("path")))
    rows = rows_at_most(expected, COMPILED_RULES)
    if rows is not None:
        if not rows:
            return entities.select("entity_id", "path", "value")
        names = [r["path"] for r in rows]
        wanted, is_wanted = F.array(*map(F.lit, names)), path.isin(names)
        pairs = [F.lit(x).cast("string") for r in rows for x in r]
        fills = F.create_map(*pairs)
    else:
        # Two values, as long as the rule table, computed once.
        wanted = expected.agg(F.collect_list("path")).scalar()
        fills = expected.agg(F.map_from_entries(F.collect_list(F.struct("path", "fill")))).scalar()
        is_wanted = F.array_contains(wanted, path)
    # An entity has at most as many wanted paths as there are; they are combined before the shuffle.
    present = has.groupBy("entity_id").agg(F.collect_set(F.when(is_wanted, path)).alias("has"))
    added = present.select("entity_id", F.explode(F.array_except(wanted, F.col("has"))).alias("path"))
    filled = F.coalesce(F.col("value"), F.when(is_wanted, F.try_element_at(fills, path)))
    return entities.select("entity_id", "path", filled.alias("value")).unionByName(
        added.select("entity_id", "path", F.try_element_at(fills, path).alias("value"))
    )


def _length_bounds(rule: Rule) -> str:
    low = 1 if rule.min_length is None and rule.needed else rule.min_length
    return f"length {_bounds(low, rule.max_length)}"


def _compiled(rule: Rule, path: str) -> list[tuple[str, str, Column]]:
    """The checks of one rule on a column: type, what it expects and whether it is broken."""
    value = F.col(f"`{path}`").cast("string")
    checks = []
    if rule.type == "fixed":
        checks.append(("fixed", rule.value, value != F.lit(rule.value)))
    elif rule.type == "range":
        low, high = rule.min_value, rule.max_value
        checks.append(("range", _bounds(low, high), _outside(F.col(f"`{path}`"), low, high)))
    elif rule.type == "regex":
        checks.append(("regex", rule.pattern, ~value.rlike(_whole(rule.pattern))))
    elif rule.type == "allowlist":
        listed = list(rule.values or [])
        checks.append(("allowlist", ",".join(listed), ~value.isin(listed)))
    elif rule.type == "forbidden":
        checks.append(("forbidden", "absent", value.isNotNull()))
    length = F.length(value)
    wrong = F.lit(False)
    if rule.min_length is not None or rule.needed:
        wrong = wrong | (length < (1 if rule.min_length is None else rule.min_length))
    if rule.max_length is not None:
        wrong = wrong | (length > rule.max_length)
    if rule.needed:
        checks.append(("required", _length_bounds(rule), value.isNull() | wrong))
    elif rule.min_length is not None or rule.max_length is not None:
        checks.append(("length", _length_bounds(rule), wrong))
    return checks


def _by_column(columns: Sequence[str], rules: Sequence[Rule]) -> list[tuple[str, Rule]]:
    """The rules that hold for each path: of a column, those of its most specific rule path."""
    unique = {repr(r): r for r in rules}.values()
    for rule in unique:
        if rule.type not in TYPES:
            raise ValueError(f"unknown rule type {rule.type!r} for {rule.path}")
    by_path: dict[str, list[Rule]] = {}
    for rule in unique:
        by_path.setdefault(rule.path, []).append(rule)
    starred = {p: p.split(".") for p in by_path if "*" in p.split(".")}
    out = [(path, rule) for path, own in by_path.items() if path not in starred for rule in own]
    for column in columns:
        if column in by_path and column not in starred:
            continue
        parts = column.split(".")
        fits = [
            p for p, s in starred.items()
            if len(s) == len(parts) and all(a in ("*", b) for a, b in zip(s, parts, strict=True))
        ]
        if fits:
            best = max(fits, key=lambda p: (-starred[p].count("*"), p))
            out += [(column, rule) for rule in by_path[best]]
    return out


def policy_violations(entities: DataFrame, id_col: str, rules: Sequence[Rule]) -> DataFrame:
    """Wide form: every violation of every rule in one projection over one scan."""
    held = _by_column([c for c in entities.columns if c != id_col], rules)
    filled = apply_defaults(entities, rules)
    absent = sorted({path for path, _ in held} - set(filled.columns))
    filled = filled.select("*", *[F.lit(None).cast("string").alias(path) for path in absent])
    checks = [(path, *check) for path, rule in held for check in _compiled(rule, path)]
    # Only the numbers of broken checks are exploded. Not a plain explode: for that Spark adds a
    # filter which runs all checks a second time.
    broken = F.array(*[F.when(check[3], F.lit(n)) for n, check in enumerate(checks)]).cast("array<int>")
    found = filled.select("*", F.explode_outer(broken).alias("__n")).filter(F.col("__n").isNotNull())

    def described(position: int, name: str) -> Column:
        return F.get(F.array(*[F.lit(check[position]) for check in checks]).cast("array<string>"), "__n").alias(name)

    actual = F.array(*[F.col(f"`{check[0]}`").cast("string") for check in checks]).cast("array<string>")
    return found.select(
        F.col(f"`{id_col}`").cast("string").alias("entity_id"),
        described(0, "path"),
        described(1, "rule_type"),
        described(2, "expected"),
        F.get(actual, "__n").alias("actual"),
    )


def _breaks_pattern(rules: DataFrame, value: Column, pattern: Column) -> Column:
    """Whether ``value`` doesn't match ``pattern`` as a whole.

    Patterns of a rule table of ordinary size are literals, so that each is compiled once per task.
    """
    rows = rows_at_most(rules.filter("type = 'regex'").select("pattern").distinct(), COMPILED_RULES)
    if rows is None:
        return ~F.rlike(value, F.concat(F.lit(r"\A(?:"), pattern, F.lit(r")\z")))
    broken = F.lit(None).cast("boolean")
    for row in rows:
        if row["pattern"] is not None:
            broken = F.when(pattern == row["pattern"], ~value.rlike(_whole(row["pattern"]))).otherwise(broken)
    return broken


def policy_violations_long(entities: DataFrame, rules: DataFrame, entity_ids: DataFrame | None = None) -> DataFrame:
    """Long form: defaults, path matching and every check, with the rules as a table.

    ``entity_ids`` (``entity_id``) names entities that may have no row at all.
    """
    rules = rules.select(*RULE_SCHEMA.names).distinct()
    filled = apply_defaults_long(entities, rules, entity_ids)
    unknown = F.raise_error(F.concat(F.lit("unknown rule type "), "type")).cast("string")
    known = F.when(F.col("type").isin(*TYPES), F.col("type")).otherwise(unknown)
    rule_columns = rules.select(
        F.col("path").alias("rule_path"),
        F.struct(
            known.alias("type"), "value", "values", "pattern", "min_value", "max_value", "is_optional", "min_length", "max_length"
        ).alias("rule"),
    )
    checked = match_rule_paths(filled, rules).join(rule_columns, "rule_path")
    value, rule = F.col("value"), F.col("rule")
    kind = rule["type"]
    number = value.try_cast("double")
    outside = (
        number.isNull()
        | F.coalesce(number < rule["min_value"], F.lit(False))
        | F.coalesce(number > rule["max_value"], F.lit(False))
    )
    content = (
        F.when(kind == "fixed", value != rule["value"])
        .when(kind == "range", value.isNotNull() & outside)
        .when(kind == "regex", _breaks_pattern(rules, value, rule["pattern"]))
        .when(kind == "allowlist", ~F.array_contains(F.coalesce(rule["values"], F.array().cast("array<string>")), value))
        .when(kind == "forbidden", value.isNotNull())
    )
    needed = (kind == "required") | ~F.coalesce(rule["is_optional"], F.lit(True))
    low = F.coalesce(rule["min_length"], F.when(needed, 1))
    wrong = F.coalesce(F.length(value) < low, F.lit(False)) | F.coalesce(F.length(value) > rule["max_length"], F.lit(False))
    types = F.array(
        F.when(content, kind),
        F.when(needed & (value.isNull() | wrong), F.lit("required")).when(~needed & wrong, F.lit("length")),
    )
    found = checked.select("*", F.explode_outer(types).alias("rule_type")).filter(F.col("rule_type").isNotNull())

    def end(bound):
        return F.coalesce(F.regexp_replace(bound.cast("string"), r"\.0$", ""), F.lit(""))

    kind = F.col("rule_type")
    expected = (
        F.when(kind == "fixed", rule["value"])
        .when(kind == "range", F.concat(end(rule["min_value"]), F.lit(".."), end(rule["max_value"])))
        .when(kind == "regex", rule["pattern"])
        .when(kind == "allowlist", F.coalesce(F.array_join(rule["values"], ","), F.lit("")))
        .when(kind == "forbidden", "absent")
        .otherwise(F.concat(F.lit("length "), end(low), F.lit(".."), end(rule["max_length"])))
    )
    return found.select("entity_id", "path", "rule_type", expected.alias("expected"), value.alias("actual"))


def policy_summary(violations: DataFrame, entities: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule and in total: entities checked, entities violating, share of them.

    ``entities`` has one row per entity. A violation counts for the most specific rule of its path.
    Rules nobody breaks are listed with zero; the total row has path ``all`` and rule type ``any``.
    """
    if any("*" in r.path.split(".") for r in rules):
        named = _with_rule_path(violations, rules_frame(violations.sparkSession, rules))
        violations = named.drop("path").withColumnRenamed("rule_path", "path")
    kinds = {(r.path, r.type) for r in rules if r.type not in ("required", "unlimited")}
    kinds |= {(r.path, "required") for r in rules if r.needed}
    kinds |= {(r.path, "length") for r in rules if not r.needed and (r.min_length, r.max_length) != (None, None)}
    listed = sorted(kinds)
    # First one row per violating entity with a flag per rule, then one row with a count per rule.
    flags = [
        F.max((F.col("path") == path) & (F.col("rule_type") == kind)).alias(f"__rule_{n}")
        for n, (path, kind) in enumerate(listed)
    ]
    per_entity = violations.groupBy("entity_id").agg(F.count(F.lit(1)).alias("__n"), *flags)
    counts = per_entity.agg(
        F.count(F.lit(1)).alias("__all"),
        *[F.count_if(F.col(f"__rule_{n}")).alias(f"__rule_{n}") for n in range(len(listed))],
    )
    named = [("all", "any", "__all"), *[(path, kind, f"__rule_{n}") for n, (path, kind) in enumerate(listed)]]
    lines = F.array(
        *[
            F.struct(F.lit(path).alias("path"), F.lit(kind).alias("rule_type"), F.col(name).alias("violating"))
            for path, kind, name in named
        ]
    )
    checked = entities.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.select(F.inline_outer(lines)).select(
        "path",
        "rule_type",
        checked.alias("checked"),
        "violating",
        F.when(checked > 0, F.round(F.col("violating") / checked, 4)).alias("share"),
    )


def hide_attributes(entities: DataFrame, rules: DataFrame) -> DataFrame:
    """Long form: rows whose most specific rule is not hidden (or that have no rule)."""
    hidden = rules.filter("hidden").select(F.col("path").alias("rule_path"))
    return _with_rule_path(entities, rules).join(hidden, "rule_path", "left_anti").select(*entities.columns)


def hide_columns(entities: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Wide form: drop the columns of hidden rules."""
    hidden = {r.path for r in rules if r.hidden}
    return entities.select(*[F.col(f"`{c}`") for c in entities.columns if c not in hidden])


# --- single conditions ----------------------------------------------------------------------------

LEASE_MARGIN_SECONDS = 600


def lease_status(df: DataFrame, expiry_col: str, as_of, margin: int = LEASE_MARGIN_SECONDS) -> DataFrame:
    """Add ``lease``: missing, expired (``margin`` seconds or less are left) or valid.

    The expiry is Unix seconds with a numeric ``as_of``, or a timestamp with a datetime ``as_of``.
    """
    expiry = F.col(expiry_col)
    if isinstance(df.schema[expiry_col].dataType, T.NumericType):
        limit = F.lit(as_of + margin)
    else:
        limit = moment(as_of, df.schema[expiry_col].dataType) + F.make_interval(secs=F.lit(margin))
    status = F.when(expiry.isNull(), "missing").when(expiry <= limit, "expired").otherwise("valid")
    return df.withColumn("lease", status)


def only_configured(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose optional settings are all there: neither null nor empty."""
    condition = F.lit(True)
    for c in cols:
        condition = condition & F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, T.StringType):
            condition = condition & (F.col(c) != "")
    return df.filter(condition)


__all__ = [
    "RULE_SCHEMA",
    "Rule",
    "apply_defaults",
    "apply_defaults_long",
    "hide_attributes",
    "hide_columns",
    "lease_status",
    "match_rule_paths",
    "only_configured",
    "policy_summary",
    "policy_violations",
    "policy_violations_long",
    "rule_allowlist",
    "rule_fixed",
    "rule_forbidden",
    "rule_range",
    "rule_regex",
    "rule_required",
    "rules_frame",
    "rules_from_frame",
    "rules_from_policy",
]
