"""Lookups: references, scopes, address ranges, ranked rules, case-insensitive keys.

Equality joins carry no broadcast hint: Spark broadcasts a side after checking its size, before the
run or during it, and splits skewed partitions otherwise. Range and rule lookups never compare each
row with each range: they become expressions or equality joins.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.functions import deterministic_id, ipv4_to_long
from lakewarden.plans.sizing import join_groups, local_table, rows_at_most, unique_by

# Fixed values.
REFERENCE_PATTERN = r"\A\{\{secrets/([^/]+)/([^}]+)\}\}\z"
NO_MATCH = "NoMatch"


def resolve_references(df: DataFrame, col: str, lookup: DataFrame) -> DataFrame:
    """Add ``resolved`` and ``dangling`` for values of the form ``{{secrets/<scope>/<key>}}``.

    ``lookup`` has ``scope``, ``key`` and ``value``, one row per reference. Other values resolve to
    themselves; a reference that leads nowhere resolves to null and is dangling.
    """
    entries = unique_by(lookup.select("scope", "key", "value"), ["scope", "key"], "lookup").select(
        F.col("scope").alias("__scope"), F.col("key").alias("__key"), F.col("value").alias("__value"),
        F.lit(True).alias("__found"),
    )
    is_reference = F.coalesce(F.col(col).rlike(REFERENCE_PATTERN), F.lit(False))
    # Plain values get a spread of scopes no reference can have, so they do not meet in one task.
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.concat(F.lit("/"), F.pmod(F.xxhash64(*hashable), F.lit(1024)).cast("string"))
    marked = df.withColumn("__is_reference", is_reference).select(
        "*",
        F.when(is_reference, F.regexp_extract(col, REFERENCE_PATTERN, 1)).otherwise(spread).alias("__s"),
        F.when(is_reference, F.regexp_extract(col, REFERENCE_PATTERN, 2)).otherwise(F.lit("")).alias("__k"),
    )
    joined = marked.join(entries, (F.col("__s") == F.col("__scope")) & (F.col("__k") == F.col("__key")), "left")
    return joined.select(
        *df.columns,
        F.when(F.col("__is_reference"), F.col("__value")).otherwise(F.col(col)).alias("resolved"),
        (F.col("__is_reference") & F.col("__found").isNull()).alias("dangling"),
    )


def in_scope(
    members: DataFrame, assignments: DataFrame, member_key: str, assigned_key: str, sync_all: bool = False
) -> DataFrame:
    """Members that some assignment names, or all of them with ``sync_all``."""
    if sync_all:
        return members
    assigned = assignments.select(F.col(assigned_key).alias("__assigned")).distinct()
    return join_groups(members, assigned, [(member_key, "__assigned")], "left_semi")


def missing_references(required: DataFrame, registered: DataFrame, key: str, registered_key: str) -> DataFrame:
    """Required rows whose key is not registered."""
    # One row per key and task is shuffled, however often a key is registered.
    known = registered.select(F.col(registered_key).alias("__known")).distinct()
    return join_groups(required, known, [(key, "__known")], "left_anti")


def assign_all(principals: DataFrame, resource: str, role: str) -> DataFrame:
    """Every principal on one resource: ``principalId, resourceId, appRoleId, assignment_id``.

    ``principals`` has ``principalId``. For several resources call it once for each of them.
    """
    return principals.select(
        "principalId",
        F.lit(resource).alias("resourceId"),
        F.lit(role).alias("appRoleId"),
        deterministic_id("principalId", F.lit(resource), F.lit(role)).alias("assignment_id"),
    )


RANGE_LIMIT = 10_000


def parse_ranges(ranges: DataFrame) -> DataFrame:
    """``name, prefix, network`` of ranges given as ``name, cidr``.

    ``network`` is the address shifted right by the free bits. Of ranges that are equal, the first
    name in text order stays. The job fails on anything but an IPv4 address and a length of 0 to 32.
    """
    parts = F.split("cidr", "/")
    length = F.try_to_number(F.get(parts, F.lit(1)), F.lit("99")).cast("int")
    address = ipv4_to_long(F.get(parts, F.lit(0)))
    valid = F.coalesce((F.size(parts) == 2) & address.isNotNull() & length.between(0, 32), F.lit(False))
    prefix = F.when(valid, length).otherwise(F.raise_error(F.concat(F.lit("not an address range: "), F.coalesce("cidr", F.lit("null")))))
    return (
        ranges.select("name", prefix.alias("prefix"), _network(address, prefix).alias("network"))
        .groupBy("prefix", "network")
        .agg(F.min("name").alias("name"))
    )


def _network(address: Column, prefix: Column) -> Column:
    return F.call_function("shiftright", address, F.lit(32) - prefix)


def cidr_lookup(df: DataFrame, ip_col: str, ranges: DataFrame, limit: int = RANGE_LIMIT) -> DataFrame:
    """Add ``range_name`` and ``range_prefix`` of the longest range that contains the address.

    The address is a number or a dotted quad; ``ranges`` has ``name`` and ``cidr``. An address no
    range contains, or outside 0 to 2**32 - 1, gets nulls. ``limit`` chooses the plan, not the rows.
    """
    address = F.col(ip_col)
    if isinstance(df.schema[ip_col].dataType, T.StringType):
        address = ipv4_to_long(address)
    address = F.when(address.between(0, 2**32 - 1), address.cast("bigint"))
    parsed = parse_ranges(ranges)
    rows = rows_at_most(parsed, limit)
    if rows is not None:
        return _lookup_short(df, address, rows)
    return _lookup_long(df, address, parsed)


def _lookup_short(df: DataFrame, address: Column, rows: list) -> DataFrame:
    """One hash join per prefix length in use; each range table is within the checked limit."""
    spark = df.sparkSession
    prefixes = sorted({r["prefix"] for r in rows}, reverse=True)
    found = df.withColumn("__ip", address.cast("bigint"))
    for p in prefixes:
        same = [(r["network"], r["name"]) for r in rows if r["prefix"] == p]
        if p == 0:
            name = F.when(F.col("__ip").isNotNull(), F.lit(same[0][1]))
            found = found.withColumn("__name_0", name)
            continue
        table = local_table(spark, same, f"__network_{p} bigint, __name_{p} string")
        found = found.join(
            F.broadcast(table), F.shiftrightunsigned("__ip", 32 - p) == F.col(f"__network_{p}"), "left"
        ).drop(f"__network_{p}")
    none = F.lit(None)
    return found.select(
        *df.columns,
        F.coalesce(none.cast("string"), *[F.col(f"__name_{p}") for p in prefixes]).alias("range_name"),
        F.coalesce(
            none.cast("int"), *[F.when(F.col(f"__name_{p}").isNotNull(), F.lit(p)) for p in prefixes]
        ).alias("range_prefix"),
    )


def _lookup_long(df: DataFrame, address: Column, parsed: DataFrame) -> DataFrame:
    """Each distinct address once, offered under every prefix length in use."""
    marked = df.withColumn("__ip", address.cast("bigint"))
    used = parsed.agg(F.collect_set("prefix")).scalar()  # at most 33 values
    offered = (
        marked.select("__ip")
        .filter(F.col("__ip").isNotNull())
        .distinct()
        .select("__ip", F.explode(used).alias("prefix"))
        .withColumn("network", _network(F.col("__ip"), F.col("prefix")))
    )
    networks = parsed.select(F.col("prefix").alias("__prefix"), F.col("network").alias("__network"), "name")
    # A short prefix is a key that very many addresses share.
    best = (
        join_groups(offered, networks, [("prefix", "__prefix"), ("network", "__network")])
        .groupBy("__ip")
        .agg(F.max_by("name", "prefix").alias("range_name"), F.max("prefix").alias("range_prefix"))
    )
    best = best.withColumnRenamed("__ip", "__address")
    return join_groups(marked, best, [("__ip", "__address")], "left").select(*df.columns, "range_name", "range_prefix")


FLOW_FIELDS = ["direction", "protocol", "source", "destination"]
RULE_LIMIT = 256


def first_match(flows: DataFrame, rules: DataFrame, limit: int = RULE_LIMIT) -> DataFrame:
    """Add ``access`` and ``matched_priority`` of the first rule that applies, per direction.

    Rules are tried in ascending ``priority`` among those of the flow's direction. Protocol, source
    and destination match when equal or when the rule says ``*``; the port must lie within
    ``port_lo`` and ``port_hi``, where null means any port. Without a match access is ``NoMatch``.
    ``matched_priority`` has the type of ``priority``; ``limit`` chooses the plan, not the rows.
    """
    rows = rows_at_most(rules, limit)
    if rows is None:
        return _first_match_joined(flows, rules)
    ranked = sorted(rows, key=lambda r: (r["priority"], r["access"]))
    # The number of the first rule that applies: branches are tried in order.
    number = F.when(F.lit(False), F.lit(0))
    for n, r in enumerate(ranked):
        hit = F.col("direction") == r["direction"]
        for name in FLOW_FIELDS[1:]:
            if r[name] != "*":
                hit = hit & (F.col(name) == r[name])
        if r["port_lo"] is not None:
            hit = hit & (F.col("port") >= r["port_lo"])
        if r["port_hi"] is not None:
            hit = hit & (F.col("port") <= r["port_hi"])
        number = number.when(hit, F.lit(n))
    accesses = F.array(*[F.lit(r["access"]) for r in ranked]).cast("array<string>")
    kind = T.ArrayType(rules.schema["priority"].dataType)
    priorities = F.array(*[F.lit(r["priority"]) for r in ranked]).cast(kind)
    return flows.withColumn("__rule", number).select(
        *flows.columns,
        F.coalesce(F.get(accesses, "__rule"), F.lit(NO_MATCH)).alias("access"),
        F.get(priorities, "__rule").alias("matched_priority"),
    )


# Ports as places: 0 for a missing port, then all 32-bit numbers; blocks of 2 ** level places.
PORT_LEVELS = 33
_LOWEST, _TOP = -(2**31), 2**32


def _place(port: Column) -> Column:
    inside = F.greatest(F.lit(_LOWEST), F.least(port.cast("bigint"), F.lit(2**31 - 1)))
    return F.when(port.isNotNull(), inside - _LOWEST + 1)


def _port_intervals(rules: DataFrame, mask: list[str]) -> DataFrame:
    """Where the ports of each mask are cut, and the first rule from each cut to the next: mask, ``at``, ``best``.

    A rule's ports are covered by at most two blocks of each size, whose numbers are plain arithmetic. A cut lies
    in one block of each size. So the rules over a cut are found by equality, and each block keeps its first rule only.
    """
    free = F.col("port_lo").isNull() & F.col("port_hi").isNull()
    low = F.when(free, F.lit(0)).otherwise(F.coalesce(_place(F.col("port_lo")), F.lit(1)))
    high = F.coalesce(_place(F.col("port_hi")), F.lit(_TOP)) + 1  # the first place after
    ranged = rules.withColumns({"low": low.cast("bigint"), "high": high.cast("bigint")}).filter("low < high")
    blocks = []
    for level in range(PORT_LEVELS + 1):
        size = 2**level
        first, after = F.expr(f"(low + {size - 1}) DIV {size}"), F.expr(f"high DIV {size}")
        for number, odd in ((first, first), (after - 1, after)):
            taken = (first < after) & (odd % 2 == 1)
            blocks.append(F.when(taken, F.struct(F.lit(level).alias("level"), number.alias("block"))))
    covered = ranged.select(*mask, "rule", F.explode(F.array(*blocks)).alias("b")).filter(F.col("b").isNotNull())
    firsts = covered.groupBy(*mask, "b.level", "b.block").agg(F.min("rule").alias("rule"))
    cuts = ranged.select(*mask, F.explode(F.array(F.lit(0).cast("bigint"), "low", "high")).alias("at")).distinct()
    inside = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.lit(PORT_LEVELS)),
            lambda level: F.struct(level.alias("level"), F.call_function("shiftright", F.col("at"), level).alias("block")),
        )
    )
    looked_up = cuts.select(*mask, "at", inside.alias("b")).select(*mask, "at", "b.*")
    return looked_up.join(firsts, [*mask, "level", "block"], "left").groupBy(*mask, "at").agg(F.min("rule").alias("best"))


def _first_match_joined(flows: DataFrame, rules: DataFrame) -> DataFrame:
    """The same for long rule tables: each distinct flow is looked up under its eight masks.

    What holds for a mask and a port is found once, from the mask's cuts: the last cut before the port. So no flow
    meets a rule, only the result of its mask and port, and a mask never has more rows than ports and cuts.
    """
    signature = [*FLOW_FIELDS, "port"]
    mask = ["__direction", *[f"__{f}" for f in FLOW_FIELDS[1:]]]
    masks = [
        F.struct(*[(F.lit("*") if star else F.col(f)).alias(f"__{f}") for f, star in zip(FLOW_FIELDS[1:], stars)])
        for stars in product([False, True], repeat=3)
    ]
    distinct = flows.select(*signature).distinct()
    offered = distinct.select(
        *signature,
        F.col("direction").alias("__direction"),
        F.coalesce(_place(F.col("port")), F.lit(0)).alias("__at"),
        F.explode(F.array_distinct(F.array(*masks))).alias("m"),
    ).select(*signature, "__direction", "__at", "m.*")
    named = rules.select(
        *[F.col(f).alias(f"__{f}") for f in FLOW_FIELDS], "port_lo", "port_hi", F.struct("priority", "access").alias("rule")
    )
    intervals = _port_intervals(named, mask)
    asked = offered.select(*mask, "__at").distinct()
    used = named.select(*mask).distinct()
    asked = join_groups(asked, used.toDF(*[f"{m}_used" for m in mask]), [(m, f"{m}_used") for m in mask], "left_semi")
    both = intervals.select(*mask, F.col("at").alias("__at"), F.struct("best").alias("cut")).unionByName(
        asked, allowMissingColumns=True
    )
    # Cuts come before the ports at the same place.
    upwards = Window.partitionBy(*mask).orderBy("__at", F.col("cut").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("held", F.last("cut", ignorenulls=True).over(upwards)).filter("cut IS NULL AND held.best IS NOT NULL")
    answers = found.select(*[F.col(m).alias(f"{m}_key") for m in [*mask, "__at"]], F.col("held.best").alias("__rule"))
    keys = [(m, f"{m}_key") for m in [*mask, "__at"]]
    best = join_groups(offered, answers, keys).groupBy(*signature).agg(F.min("__rule").alias("__best"))
    best = best.select(*[F.col(c).alias(f"__key_{c}") for c in signature], "__best")
    joined = join_groups(flows, best, [(c, f"__key_{c}") for c in signature], "left", nulls=True)
    return joined.select(
        *[flows[c] for c in flows.columns],
        F.coalesce("__best.access", F.lit(NO_MATCH)).alias("access"),
        F.col("__best.priority").alias("matched_priority"),
    )


def collated_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    collation: str = "UNICODE_CI",
    how: str = "inner",
) -> DataFrame:
    """Join on text keys that are equal under a collation; by default case is ignored, accents count."""
    a, b = on
    return left.join(right, F.collate(left[a], collation) == F.collate(right[b], collation), how)
