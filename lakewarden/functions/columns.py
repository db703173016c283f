"""Scalar, string, map and hash expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed values.
WRONG_LENGTH = "incorrectSegmentLength"
MASK = "***"
HOST_PREFIX_LENGTH = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(at: datetime, kind: DataType) -> Column:
    """A naive datetime as a literal of a timestamp type, whatever the time zone of the Python process."""
    return F.lit(at.isoformat(sep=" ")).cast(kind)


def java_quote(text: str) -> str:
    """``text`` as a regular expression that matches exactly itself, in Java and RE2."""
    return re.sub(r"([\\.^$|?*+()\[\]{}\-/])", r"\\\1", text)


def resource_id_parts(
    resource_id: Column | str,
    min_segments: int = 9,
    subscription: str | None = None,
    group: str | None = None,
) -> Column:
    """Struct of subscription, resource_group, account and name of a ``/``-separated id.

    A leading ``/`` makes an empty segment 0. An id with fewer than ``min_segments`` segments is no
    error: its name and account become ``incorrectSegmentLength``, the other two the given defaults.
    """
    parts = F.split(_col(resource_id), "/")
    long_enough = F.size(parts) >= min_segments
    return F.struct(
        F.when(long_enough, F.get(parts, F.lit(2))).otherwise(F.lit(subscription).cast("string")).alias("subscription"),
        F.when(long_enough, F.get(parts, F.lit(4))).otherwise(F.lit(group).cast("string")).alias("resource_group"),
        F.when(long_enough, F.get(parts, F.lit(8))).otherwise(F.lit(WRONG_LENGTH)).alias("account"),
        F.when(long_enough, F.try_element_at(parts, F.lit(-1))).otherwise(F.lit(WRONG_LENGTH)).alias("name"),
    )


def deterministic_id(*cols: Column | str) -> Column:
    """An id in UUID layout that depends on the values alone; each part is hashed with its length, null without one."""
    parts = [_col(c).cast("string") for c in cols]
    text = F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts])
    digest = F.sha2(text, 256)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def fill_template(text: Column | str, values: dict[str, str]) -> Column:
    """Append a value after every ``KEY=``, key by key, ignoring the case of the key."""
    return reduce(
        lambda filled, item: F.regexp_replace(
            filled,
            F.lit("(?i)" + java_quote(item[0] + "=")),
            F.lit(f"{item[0]}={item[1]}".replace("\\", "\\\\").replace("$", "\\$")),
        ),
        values.items(),
        _col(text),
    )


NESTING = 50


def any_of(words: Iterable[str]) -> str:
    """A pattern that matches the longest of the words that start at a place.

    Words share their beginnings, so a place is tried once per next character rather than once per
    word. Words that nest too deeply for that are listed, longest first.
    """
    pattern, depth = _shared(sorted(words))
    if depth <= NESTING:
        return pattern
    return "|".join(java_quote(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def _shared(words: list[str], level: int = 0) -> tuple[str, int]:
    """The pattern of sorted words and how deep its groups nest."""
    start = commonprefix(words)
    rest = [w[len(start) :] for w in words]
    if rest == [""] or level > NESTING:
        return java_quote(start), level
    branches = [_shared(list(same), level + 1) for _, same in groupby(filter(None, rest), key=lambda w: w[0])]
    # Trying to go on comes before stopping here.
    stop = "?" if "" in rest else ""
    return f"{java_quote(start)}(?:{'|'.join(p for p, _ in branches)}){stop}", max(d for _, d in branches)


def mask_expression(text: Column | str, secrets: list[str]) -> Column:
    """Every occurrence of a secret becomes ``***``; where two start together the longest wins."""
    words = {s for s in secrets if s}
    return F.regexp_replace(_col(text), any_of(words), MASK) if words else _col(text)


def canonical_name(prefix: Column | str, environment: Column | str, suffix: str = "") -> Column:
    """Lower-case ``prefix-environment`` with ``suffix`` appended after another dash."""
    base = F.lower(F.concat(_col(prefix), F.lit("-"), _col(environment)))
    return F.concat(base, F.lit(f"-{suffix}")) if suffix else base


def storage_name(name: Column | str) -> Column:
    """A name without its dashes."""
    return F.replace(_col(name), F.lit("-"), F.lit(""))


def host_prefix(name: Column | str) -> Column:
    """The first characters of a name, as many as a host name prefix may have."""
    return F.left(_col(name), F.lit(HOST_PREFIX_LENGTH))


def merge_maps(defaults: Column | str, overrides: Column | str) -> Column:
    """Union of two maps: an override wins, a null override keeps the default.

    A missing (null) map counts as empty.
    """
    a, b = _col(defaults), _col(overrides)
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(y, x)))


def ipv4_to_long(address: Column | str) -> Column:
    """A dotted-quad address as a number, or null when it is not one."""
    parts = F.split(_col(address), r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("int").cast("bigint") for i in range(4)]
    valid = _col(address).rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$")
    for octet in octets:
        valid = valid & (octet <= 255)
    number = reduce(lambda acc, octet: acc * 256 + octet, octets)
    return F.when(valid, number)
