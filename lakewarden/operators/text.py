"""Masking, name collisions and expansion of arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions import mask_expression
from lakewarden.functions.columns import MASK
from lakewarden.plans.sizing import join_groups, local_table, rows_at_most

# Up to so many secrets become one pattern of the plan; more are joined, with equal rows.
SECRET_LIMIT = 1_000


def mask_values(df: DataFrame, col: str, secrets: Sequence[str] | DataFrame, limit: int = SECRET_LIMIT) -> DataFrame:
    """Replace every occurrence of a secret in ``col`` by ``***``, scanning from the left.

    Where several secrets start at one place the longest is taken. The secrets are a list or the
    first column of a table, of any length; empty and null ones are left out. ``limit`` chooses the
    plan, not the rows: one regular expression, or a lookup of the places at which secrets begin.
    """
    if not isinstance(secrets, DataFrame):
        return df.withColumn(col, mask_expression(col, list(secrets)))
    words = secrets.select(F.col(secrets.columns[0]).alias("secret")).filter("secret != ''").distinct()
    rows = rows_at_most(words, limit)
    if rows is not None:
        return df.withColumn(col, mask_expression(col, [r["secret"] for r in rows]))
    return _mask_joined(df, col, words, limit)


TEXT_KEYS = ["__key", "__check"]


def _heads(words: DataFrame, k: int, limit: int) -> tuple[int, list[tuple]]:
    """At most ``limit`` different beginnings of all secrets, of the returned length: ``k`` halved until they are few."""
    while k:
        rows = rows_at_most(words.select(F.left("secret", F.lit(k)).alias("head")).distinct(), limit)
        if rows is not None:
            return k, [tuple(r) for r in rows]
        k //= 2
    return 0, [("",)]


def _mask_joined(df: DataFrame, col: str, words: DataFrame, limit: int) -> DataFrame:
    """The same for long tables of secrets, looked up once per distinct text.

    The first characters of a secret, as many as the shortest secret has, are its anchor. A place of
    a text is looked up by the characters there, once. Only where they are an anchor the lengths of
    the secrets behind it are tried, and what stands there is looked up among the secrets.

    Places where no secret can begin go before anything is shuffled. At most ``limit`` anchors with
    their lengths meet the places by broadcast; of more anchors, at most ``limit`` beginnings do so,
    and only the places that have one are shuffled to the anchors.
    """
    spark = df.sparkSession
    k = words.agg(F.min(F.length("secret"))).first()[0]
    starts = words.select(F.left("secret", F.lit(k)).alias("anchor"), F.length("secret").alias("len")).distinct()
    few = rows_at_most(starts, limit)
    text = F.col("__text")
    texts = df.select(F.col(col).alias("__text")).filter(F.length(col) >= k).distinct()
    # Two hashes stand for a text.
    keyed = texts.select("__text", F.xxhash64(text).alias("__key"), F.xxhash64(F.lit(1), text).alias("__check"))
    # Exploding the one array keeps it from being split again for every place.
    letters = F.explode(F.array(F.split(text, ""))).alias("chars")
    places = F.transform(
        F.sequence(F.lit(1), F.size("chars") - k + 1), lambda p: F.array_join(F.slice("chars", p, F.lit(k)), "")
    )
    grams = keyed.select(*TEXT_KEYS, letters).select(*TEXT_KEYS, "chars", F.posexplode(places).alias("pos", "gram"))
    if few is not None:
        known = F.broadcast(local_table(spark, [tuple(r) for r in few], "anchor string, len int"))
        tried = grams.join(known, F.col("gram") == F.col("anchor"))
    else:
        h, heads = _heads(words, k, limit)
        known = F.broadcast(local_table(spark, heads, "head string"))
        grams = grams.drop("chars").join(known, F.left("gram", F.lit(h)) == F.col("head"), "left_semi")
        anchors = words.groupBy(F.left("secret", F.lit(k)).alias("anchor")).agg(F.collect_set(F.length("secret")).alias("lengths"))
        begun = join_groups(grams, anchors, [("gram", "anchor")]).groupBy(*TEXT_KEYS)
        begun = begun.agg(F.collect_list(F.struct("pos", "lengths")).alias("begun"))
        tried = keyed.join(begun, TEXT_KEYS).select(*TEXT_KEYS, "begun", letters).select(*TEXT_KEYS, "chars", F.inline("begun"))
        tried = tried.select(*TEXT_KEYS, "chars", "pos", F.explode("lengths").alias("len"))
    pieces = tried.select(
        *TEXT_KEYS, "pos", "len", F.array_join(F.slice("chars", F.col("pos") + 1, F.col("len")), "").alias("piece")
    )
    # At the end of a text a piece may be short, and equal a shorter secret that is tried anyway.
    whole = pieces.filter(F.length("piece") == F.col("len"))
    hits = join_groups(whole, words, [("piece", "secret")], "left_semi")
    # Longest first among hits at one place; at most one hit per place and length.
    found = hits.groupBy(*TEXT_KEYS).agg(F.array_sort(F.collect_list(F.struct("pos", (-F.col("len")).alias("back")))).alias("hits"))
    kept = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,stop:int>>").alias("cuts")),
        lambda acc, h: F.when(
            h["pos"] >= acc["end"],
            F.struct(
                (h["pos"] - h["back"]).alias("end"),
                F.array_append(
                    acc["cuts"], F.struct(h["pos"].alias("start"), (h["pos"] - h["back"]).alias("stop"))
                ).alias("cuts"),
            ),
        ).otherwise(acc),
    )["cuts"]
    cuts = found.select(*TEXT_KEYS, kept.alias("__cuts"))
    rows = df.withColumns({"__key": F.xxhash64(col), "__check": F.xxhash64(F.lit(1), F.col(col))})
    joined = join_groups(rows, cuts, [(c, c) for c in TEXT_KEYS], "left").select(*[rows[c] for c in df.columns], "__cuts")
    # Only texts that are cut are split, and once.
    letters = F.explode(F.array(F.when(F.col("__cuts").isNotNull(), F.split(col, ""))))
    split = joined.select("*", letters.alias("__chars"))
    masked = F.when(F.col("__cuts").isNull(), F.col(col)).otherwise(_cut(F.col("__chars"), F.col("__cuts")))
    return split.select(*[masked.alias(c) if c == col else F.col(c) for c in df.columns])


def _cut(chars: Column, cuts: Column) -> Column:
    """The text with each (start, stop) stretch replaced by the mask."""

    def before(cut: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.get(cuts, i - 1)["stop"])
        return F.concat(F.array_join(F.slice(chars, begin + 1, cut["start"] - begin), ""), F.lit(MASK))

    end = F.element_at(cuts, -1)["stop"]
    tail = F.array_join(F.slice(chars, end + 1, F.size(chars)), "")
    return F.concat(F.array_join(F.transform(cuts, before), ""), tail)


def name_collisions(df: DataFrame, name: str) -> DataFrame:
    """Rows that share their name with another row, with ``sharing``, the number of such rows."""
    shared = (
        df.groupBy(F.col(name).alias("__name"))
        .agg(F.count(F.lit(1)).alias("sharing"))
        .filter(F.col("sharing") > 1)
    )
    return join_groups(df, shared, [(name, "__name")]).select(*[df[c] for c in df.columns], "sharing")


def expand_grid(df: DataFrame, array_col: str, with_index: bool = True, element: str = "element") -> DataFrame:
    """One row per element of an array, with its 0-based ``position``; empty arrays give no row."""
    others = [c for c in df.columns if c != array_col]
    if with_index:
        return df.select(*others, F.posexplode(array_col).alias("position", element))
    return df.select(*others, F.explode(array_col).alias(element))


def index_range(count: Column | str) -> Column:
    """The array 0 … count − 1, empty when count is not positive."""
    n = F.col(count) if isinstance(count, str) else count
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
